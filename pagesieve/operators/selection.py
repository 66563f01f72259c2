"""Target classification, source scoring, ranking and selection.

Scores depend only on (target type, budget, source), so they are computed on
a table of at most |types| x |budgets| x |catalogue| rows (75 with the fixed
catalogue), ranked there, and attached to the targets by an equi-join on
(target_type, budget); the planner broadcasts that small side. No window runs over the
target table and no target is scored twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagesieve import constants as K
from pagesieve.operators.policy import apply_policy
from pagesieve.sources.tables import catalogue, host_of


def classify_url(url) -> Column:
    """documentation / blog / forum / news / general; rules in order, first match wins."""
    u = F.lower(F.col(url) if isinstance(url, str) else url)
    expr = None
    for kind, pats in K.URL_TYPE_RULES:
        cond = F.lit(False)
        for p in pats:
            cond = cond | F.contains(u, F.lit(p))
        expr = F.when(cond, F.lit(kind)) if expr is None else expr.when(cond, F.lit(kind))
    return expr.otherwise(F.lit(K.DEFAULT_TARGET_TYPE))


def classify_urls(df: DataFrame, url_col: str = "url") -> DataFrame:
    return df.withColumn("target_type", classify_url(url_col))


def targets_from_urls(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """(target, target_url, target_type): a target per corpus key, named by
    the smallest URL given for it and classified on that whole URL."""
    seeds = urls.groupBy(host_of(url_col).alias("target")).agg(F.min(url_col).alias("target_url"))
    return seeds.withColumn("target_type", classify_url(F.coalesce("target_url", F.lit(""))))


def targets_from_pages(pages: DataFrame) -> DataFrame:
    """The targets that a table of pages was scraped from."""
    return targets_from_urls(pages).select("target", "target_type")


def production_score(budget: Column, target_type: Column) -> Column:
    """Score of a catalogue row for (budget, target type), rounded to 1 place."""
    users = F.col("monthly_users")
    popularity = F.when(users > 0, F.least(F.lit(K.SCORE_POPULARITY_CAP),
                                           K.SCORE_POPULARITY_BASE + F.log10(users) * K.SCORE_POPULARITY_PER_DECADE)
                        ).otherwise(F.lit(0.0))
    cost = (F.when(F.col("cost") == "free", F.lit(K.SCORE_FREE))
            .when(budget == "premium", F.lit(K.SCORE_PAID_PREMIUM)).otherwise(F.lit(0.0)))
    match = F.when(F.array_contains(F.col("best_for"), target_type), F.lit(K.SCORE_TYPE_MATCH)).otherwise(F.lit(0.0))
    fmt = None
    for name, pts in K.SCORE_FORMAT:
        c = F.col("output_format") == name
        fmt = F.when(c, F.lit(pts)) if fmt is None else fmt.when(c, F.lit(pts))
    fmt = fmt.otherwise(F.lit(0.0))
    raw = F.col("success_rate") * K.SCORE_SUCCESS_WEIGHT + popularity + cost + match + fmt
    return F.round(raw, 1)


def legacy_score(budget: Column, runs: Column, users: Column, rating: Column) -> Column:
    """min(runs/1000, 50) + 10*rating + min(users/10, 20); x1.2 premium,
    x0.9 minimal; capped at 100; absent fields count as 0."""
    runs, users, rating = (F.coalesce(c, F.lit(0)) for c in (runs, users, rating))
    s = (F.when(runs > 0, F.least(runs / K.LEGACY_RUNS_DIVISOR, F.lit(K.LEGACY_RUNS_CAP))).otherwise(0.0)
         + F.when(rating > 0, rating * K.LEGACY_RATING_WEIGHT).otherwise(0.0)
         + F.when(users > 0, F.least(users / K.LEGACY_USERS_DIVISOR, F.lit(K.LEGACY_USERS_CAP))).otherwise(0.0))
    s = (F.when(budget == "premium", s * K.LEGACY_PREMIUM_FACTOR)
         .when(budget == "minimal", s * K.LEGACY_MINIMAL_FACTOR).otherwise(s))
    return F.least(s, F.lit(K.LEGACY_SCORE_CAP))


def budget_eligible(budget: Column) -> Column:
    """minimal: free and (very_)fast; optimal: free; anything else: all."""
    free = F.col("cost") == "free"
    return (F.when(budget == "minimal", free & F.col("speed").isin("very_fast", "fast"))
            .when(budget == "optimal", free).otherwise(F.lit(True)))


def scored_catalogue(cat: DataFrame) -> DataFrame:
    """(target_type, budget, catalogue columns..., score, legacy_score); the
    type and budget axes come from exploding fixed arrays (no join)."""
    g = (cat.withColumn("target_type", F.explode(F.array(*[F.lit(t) for t in K.TARGET_TYPES])))
         .withColumn("budget", F.explode(F.array(*[F.lit(b) for b in K.BUDGET_MODES]))))
    return (g.withColumn("score", production_score(F.col("budget"), F.col("target_type")))
            .withColumn("legacy_score", legacy_score(F.col("budget"), F.lit(None).cast("double"),
                                                     F.lit(None).cast("double"), F.col("rating"))))


def rank_sources(scored: DataFrame, top_n: int = K.DEFAULT_TOP_N) -> DataFrame:
    """Top N per (type, budget) by rounded score desc, list position asc."""
    w = Window.partitionBy("target_type", "budget").orderBy(F.desc("score"), F.asc("ord"))
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_n)


def with_budgets(targets: DataFrame, budgets=None) -> DataFrame:
    budgets = budgets or K.BUDGET_MODES
    return targets.withColumn("budget", F.explode(F.array(*[F.lit(b) for b in budgets])))


def score_sources(targets: DataFrame, cat: DataFrame | None = None, budgets=None) -> DataFrame:
    """Every (target, budget, source) with its production and legacy score."""
    cat = cat if cat is not None else catalogue(targets.sparkSession)
    small = scored_catalogue(cat)
    return with_budgets(targets, budgets).join(small, ["target_type", "budget"])


def select_sources(targets: DataFrame, budget: str = K.DEFAULT_BUDGET, top_n: int = K.DEFAULT_TOP_N,
                   cat: DataFrame | None = None) -> DataFrame:
    """Full selection: classify -> catalogue -> policy -> score -> top N.
    Output: target, target_type, budget, rank, ord, source_id, score."""
    cat = cat if cat is not None else catalogue(targets.sparkSession)
    allowed = apply_policy(cat, ("id", "title", "description"))
    ranked = rank_sources(scored_catalogue(allowed).filter(F.col("budget") == budget), top_n)
    return (with_budgets(targets, [budget]).join(ranked, ["target_type", "budget"])
            .select("target", "target_type", "budget", "rank", "ord", F.col("id").alias("source_id"), "score"))


def catalog_by_budget(targets: DataFrame, cat: DataFrame | None = None) -> DataFrame:
    """Sources each target may use under each budget mode."""
    cat = cat if cat is not None else catalogue(targets.sparkSession)
    small = (cat.withColumn("budget", F.explode(F.array(*[F.lit(b) for b in K.BUDGET_MODES])))
             .filter(budget_eligible(F.col("budget"))).select("budget", "ord", F.col("id").alias("source_id")))
    return with_budgets(targets).join(small, "budget")


def catalog_by_target(targets: DataFrame, cat: DataFrame | None = None) -> DataFrame:
    """Sources whose best_for list names the target's type (equi-join on the
    exploded best_for list)."""
    cat = cat if cat is not None else catalogue(targets.sparkSession)
    small = cat.select(F.explode("best_for").alias("target_type"), "ord", F.col("id").alias("source_id"))
    return targets.join(small, "target_type")
