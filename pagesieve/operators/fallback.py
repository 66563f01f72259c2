"""Source fallback: per target, the first source in rank order that neither
failed nor returned zero rows wins; otherwise the last error is reported.

Attempts are aggregated per target (partial aggregation before the shuffle,
so a hot target sends one row per task), and items are joined to the winner
on (target, rank).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL_FAILED = "All scrapers failed"


def attempt_error(status: str = "status", n_items: str = "n_items", error: str = "error",
                  source_id: str = "source_id") -> F.Column:
    """Error an attempt leaves behind: its own error when it failed, a
    no-data message when it returned nothing, null when it succeeded."""
    return (F.when(F.col(status) != "ok", F.coalesce(F.col(error), F.lit(ALL_FAILED)))
            .when(F.col(n_items) == 0, F.concat(F.lit("No data returned from "), F.col(source_id))))


def succeeded() -> Column:
    return (F.col("status") == "ok") & (F.col("n_items") > 0)


def winners(attempts: DataFrame) -> DataFrame:
    """(target, rank, source_id) of the first successful attempt, by one
    aggregate."""
    best = attempts.groupBy("target").agg(F.min(F.when(succeeded(), F.struct("rank", "source_id"))).alias("best"))
    return best.filter(F.col("best").isNotNull()).select("target", "best.rank", "best.source_id")


def first_successful_source(attempts: DataFrame, items: DataFrame) -> DataFrame:
    """Items of the winning attempt of each target (items carry target, rank)."""
    return items.join(winners(attempts), ["target", "rank"])


def source_failures(attempts: DataFrame) -> DataFrame:
    """Targets where every attempt failed or returned nothing: (target, attempts, error)."""
    agg = attempts.groupBy("target").agg(
        F.count_if(succeeded()).alias("_ok"), F.count(F.lit(1)).alias("attempts"),
        F.max_by(attempt_error(), F.col("rank")).alias("error"))
    return (agg.filter(F.col("_ok") == 0)
            .select("target", "attempts", F.coalesce("error", F.lit(ALL_FAILED)).alias("error")))


def target_status(targets: DataFrame, selected: DataFrame, attempts: DataFrame,
                  items: DataFrame, content_col: str = "html") -> DataFrame:
    """ok / no_source / all_failed / no_content for every target, by one
    aggregate over the rows of all four tables."""
    no_rank, no = F.lit(None).cast("int").alias("rank"), F.lit(False)

    def rows(df, rank, known=no, source=no, won=no, content=no):
        return df.select("target", rank, known.alias("known"), source.alias("source"), won.alias("won"),
                         content.alias("content"))

    yes, rank = F.lit(True), F.col("rank").cast("int").alias("rank")
    # a row per (target, rank) of items at most: what an aggregate must remember is bounded by the ranks
    with_content = items.filter(F.length(F.col(content_col)) > 0).select("target", "rank").distinct()
    everything = rows(targets, no_rank, known=yes).unionAll(rows(selected, no_rank, source=yes)).unionAll(
        rows(attempts.filter(succeeded()), rank, won=yes)).unionAll(rows(with_content, rank, content=yes))
    found = everything.groupBy("target").agg(
        F.bool_or("known").alias("known"), F.bool_or("source").alias("source"),
        F.min(F.when(F.col("won"), F.col("rank"))).alias("rank"),
        F.collect_set(F.when(F.col("content"), F.col("rank"))).alias("ranks"))
    status = (F.when(~F.col("source"), F.lit("no_source"))
              .when(F.col("rank").isNull(), F.lit("all_failed"))
              .when(~F.array_contains("ranks", F.col("rank")), F.lit("no_content"))
              .otherwise(F.lit("ok")))
    return found.filter("known").select("target", status.alias("status"))
