"""Compositions of the operators into whole runs.

A run in the original tool is: classify the target, select sources, scrape
with fallback, convert pages to documents, cost them, and emit one nested
record. Here one job does that for a whole table of targets at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesieve import constants as K
from pagesieve.operators import convert as CV
from pagesieve.operators import corpus as CO
from pagesieve.operators import fallback as FB
from pagesieve.operators import selection as SE
from pagesieve.operators.policy import apply_policy
from pagesieve.session import materialize
from pagesieve.sources.tables import catalogue


def target_totals(scraped: DataFrame, documents: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target: type, source, pages, documents and bytes. ``scraped``:
    (target, source_id, a row per page); ``documents``: (target, n_bytes).
    One aggregate over the rows of both."""
    rows = scraped.select("target", "source_id", F.lit(1).alias("page"), F.lit(0).alias("doc"), F.lit(0).cast("long").alias(
        "n_bytes")).unionAll(documents.select("target", F.lit(None).cast("string"), F.lit(0), F.lit(1), "n_bytes"))
    totals = rows.groupBy("target").agg(
        F.max("source_id").alias("scraper_used"), F.sum("page").alias("pages_scraped"),
        F.sum("doc").alias("documents_created"), F.sum("n_bytes").cast("long").alias("total_size_bytes"))
    return totals.join(targets.select("target", "target_type"), "target")


def run_records(targets: DataFrame, attempts: DataFrame, items: DataFrame, as_of,
                corpus_name: str | None = None) -> DataFrame:
    """One nested record per target that has a winning source.

    targets(target, target_type); attempts(target, rank, source_id, status,
    n_items, error); items(target, rank, page_id, url, html, ...).

    The winning items are converted once; each becomes one narrow row (bytes
    of its document, or null), and one aggregate counts pages, documents and
    bytes.
    """
    won = items.join(FB.winners(attempts), ["target", "rank"])
    docs = CV.document_sizes(won, as_of, keep=("target", "source_id"))
    totals = docs.groupBy("target").agg(
        F.max("source_id").alias("scraper_used"), F.count(F.lit(1)).alias("pages_scraped"),
        F.count("n_bytes").alias("documents_created"),
        F.coalesce(F.sum("n_bytes"), F.lit(0)).cast("long").alias("total_size_bytes"))
    return CO.run_record(totals.join(targets.select("target", "target_type"), "target"), as_of, corpus_name)


def flatten_record(records: DataFrame) -> DataFrame:
    """Nested record -> flat columns (nested fields prefixed by their parent)."""
    cols = []
    for f in records.schema["record"].dataType.fields:
        if hasattr(f.dataType, "fields"):
            cols += [F.col(f"record.{f.name}.{g.name}").alias(f"{f.name}_{g.name}") for g in f.dataType.fields]
        else:
            cols.append(F.col(f"record.{f.name}").alias(f.name))
    return records.select(*cols)


def run_corpus_job(pages: DataFrame, attempts: DataFrame, items: DataFrame, as_of, out_path: str,
                   budget: str = K.DEFAULT_BUDGET, top_n: int = K.DEFAULT_TOP_N,
                   corpus_name: str | None = None) -> DataFrame:
    """The whole run for a table of targets, with the empty-result guards.

    Only sources selected under ``budget`` and ``top_n`` count. Raises
    ValueError when the policy leaves no source, RuntimeError when every
    attempt of every target failed or when no document was produced.
    Converts every page once and writes documents (partitioned by corpus
    bucket), the manifest, one metadata record per corpus and the run records
    under ``out_path``, in place of an earlier run's; returns the run records.
    """
    spark = pages.sparkSession
    if apply_policy(catalogue(spark), ("id", "title", "description")).isEmpty():
        raise ValueError("No allowed sources: every catalogue entry is banned by the policy")
    targets = SE.targets_from_pages(pages)
    selected = SE.select_sources(targets, budget, top_n).select("target", "source_id")
    attempts = attempts.join(selected, ["target", "source_id"], "left_semi")
    win = materialize(FB.winners(attempts))
    if win.isEmpty():
        raise RuntimeError("All sources failed for every target")
    won = items.join(win, ["target", "rank"])
    docs = CV.convert_pages(won.drop("rank"), as_of, corpus="target")
    CO.write_corpus(docs, f"{out_path}/documents", mode="overwrite")
    written = spark.read.parquet(f"{out_path}/documents")
    if written.isEmpty():
        raise RuntimeError("No valid documents created from scraped data")
    CO.build_manifest(written, as_of).write.mode("overwrite").parquet(f"{out_path}/manifest")
    CO.corpus_summary(written, as_of, by="corpus", text_col="document").write.mode("overwrite").json(
        f"{out_path}/corpora")
    totals = target_totals(won.select("target", "source_id"),
                           written.select(F.col("corpus").alias("target"), "n_bytes"), targets)
    CO.run_record(totals, as_of, corpus_name).write.mode("overwrite").json(f"{out_path}/runs")
    return spark.read.json(f"{out_path}/runs")
