"""Classification, scores, ranking and selection against the golden tables."""

import pytest
from pyspark.sql import functions as F

from pagesieve.operators.selection import (budget_eligible, catalog_by_target, classify_url, rank_sources,
                                           scored_catalogue, select_sources)
from pagesieve.sources.tables import catalogue

URLS = [
    ("https://docs.python.org", "documentation"), ("https://x.org/docs/a", "documentation"),
    ("https://API.x.com", "documentation"), ("https://developer.x.com", "documentation"),
    ("https://blog.x.com/docs/", "documentation"),
    ("https://x.com/blog/1", "blog"), ("https://medium.com/a", "blog"), ("https://n.substack.com", "blog"),
    ("https://reddit.com/r/a", "forum"), ("https://forum.x.com", "forum"), ("https://stackoverflow.com/q/1", "forum"),
    ("https://wordpress.org", "news"), ("https://x.com/story/1", "news"), ("https://x.com/newsletter", "news"),
    ("https://shop.x.com/cart", "general"),
]


def test_classify(spark):
    df = spark.createDataFrame(URLS, "url string, expected string")
    assert df.filter(classify_url("url") != F.col("expected")).count() == 0


GOLDEN = {  # type -> scores by ord (4 listed for minimal/optimal, premium)
    "documentation": ([97.9, 83.6, 74.6, 84.6, 69.0], 79.0, [0, 3, 1]),
    "blog": ([97.9, 83.6, 74.6, 84.6, 69.0], 79.0, [0, 3, 1]),
    "general": ([97.9, 93.6, 84.6, 74.6, 59.0], 69.0, [0, 1, 2]),
    "forum": ([87.9, 83.6, 74.6, 74.6, 59.0], 69.0, [0, 1, 2]),
    "news": ([87.9, 83.6, 74.6, 74.6, 59.0], 69.0, [0, 1, 2]),
}


@pytest.fixture(scope="module")
def scored(spark):
    return scored_catalogue(catalogue(spark)).cache()


@pytest.mark.parametrize("ttype", list(GOLDEN))
def test_scores(scored, ttype):
    base, premium4, _ = GOLDEN[ttype]
    for budget in ("minimal", "optimal", "premium"):
        got = {r.ord: r.score for r in scored.filter((F.col("target_type") == ttype) & (F.col("budget") == budget))
               .collect()}
        want = dict(enumerate(base))
        if budget == "premium":
            want[4] = premium4
        assert got == pytest.approx(want)


@pytest.mark.parametrize("ttype", list(GOLDEN))
def test_top3(scored, ttype):
    top = rank_sources(scored, 3)
    for budget in ("minimal", "optimal", "premium"):
        got = [r.ord for r in top.filter((F.col("target_type") == ttype) & (F.col("budget") == budget))
               .orderBy("rank").collect()]
        assert got == GOLDEN[ttype][2]


def test_legacy_scores(scored):
    got = {(r.budget, r.ord): r.legacy_score for r in scored.filter(F.col("target_type") == "general").collect()}
    opt = [43.6, 49.3, 42.4, 32.6, 39.3]
    for o, v in enumerate(opt):
        assert got[("optimal", o)] == pytest.approx(v)
        assert got[("premium", o)] == pytest.approx(v * 1.2)
        assert got[("minimal", o)] == pytest.approx(v * 0.9)


@pytest.mark.parametrize("budget,ords", [("minimal", {1, 2}), ("optimal", {0, 1, 2, 3}), ("premium", {0, 1, 2, 3, 4}),
                                         ("anything", {0, 1, 2, 3, 4})])
def test_budget_filter(spark, budget, ords):
    cat = catalogue(spark)
    assert {r.ord for r in cat.filter(budget_eligible(F.lit(budget))).collect()} == ords


@pytest.mark.parametrize("ttype,ords", [("documentation", {0, 3, 4}), ("blog", {0, 3, 4}), ("general", {0, 1, 2}),
                                        ("simple_sites", {1, 2}), ("forum", set()), ("news", set())])
def test_type_filter(spark, ttype, ords):
    t = spark.createDataFrame([("t", ttype)], "target string, target_type string")
    assert {r.ord for r in catalog_by_target(t).collect()} == ords


def test_select_sources_table(spark):
    t = spark.createDataFrame([("a", "documentation"), ("b", "news")], "target string, target_type string")
    got = {(r.target, r.rank): r.ord for r in select_sources(t).collect()}
    assert got == {("a", 1): 0, ("a", 2): 3, ("a", 3): 1, ("b", 1): 0, ("b", 2): 1, ("b", 3): 2}


def test_catalogue_union_keeps_order(spark):
    assert [r.ord for r in catalogue(spark).collect()] == [0, 1, 2, 3, 4]


def test_legacy_score_on_store_actors(spark):
    from pagesieve.operators.selection import legacy_score
    rows = [("a", 100000.0, 500.0, 4.5, "optimal", 100.0),   # 50 + 45 + 20 = 115 -> capped
            ("b", 2000.0, 30.0, 0.0, "premium", 6.0),        # (2 + 0 + 3) * 1.2
            ("c", 0.0, 0.0, 3.0, "minimal", 27.0),           # 30 * 0.9
            ("d", None, None, None, "optimal", 0.0)]         # absent fields count as 0
    df = spark.createDataFrame(rows, "id string, runs double, users double, rating double, budget string, want double")
    got = {r.id: r.s for r in df.select("id", legacy_score(F.col("budget"), F.col("runs"), F.col("users"),
                                                             F.col("rating")).alias("s")).collect()}
    assert got == pytest.approx({r[0]: r[5] for r in rows})
