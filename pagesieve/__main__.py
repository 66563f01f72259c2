"""Command line: run the whole corpus job over a scraped page table.

    python -m pagesieve --pages PATH --out PATH [--format parquet|json]
        [--budget optimal] [--top-n 3] [--max-pages 100] [--corpus-name NAME]
        [--as-of 2024-01-01T00:00:00]

The page table is what the scrape returned (url + html, or any of the
content fields). Every page host is a target; its pages count as the
successful scrape of the target's first-ranked source. Writes documents
(partitioned by corpus), the upload manifest and one run record per target
under ``--out``, and prints the number of run records.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pagesieve import constants as K
from pagesieve.operators.convert import cap_pages
from pagesieve.operators.selection import select_sources, targets_from_pages
from pagesieve.plans.jobs import run_corpus_job
from pagesieve.session import ensure_checkpoint_dir
from pagesieve.sources.tables import host_of, read_items


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="pagesieve", description=__doc__.split("\n")[0])
    ap.add_argument("--pages", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--budget", default=K.DEFAULT_BUDGET)
    ap.add_argument("--top-n", type=int, default=K.DEFAULT_TOP_N)
    ap.add_argument("--max-pages", type=int, default=K.DEFAULT_MAX_PAGES)
    ap.add_argument("--corpus-name", default=None)
    ap.add_argument("--as-of", default=None, help="scrape time (ISO); default: now")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName("pagesieve").getOrCreate()
    ensure_checkpoint_dir(spark)
    pages = read_items(spark, a.pages, a.format)
    # items without an id get one above all given ids, from their position in the scan (stable for a file scan)
    above = pages.agg(F.max("page_id")).first()[0]
    start = 0 if above is None else above + 1
    pages = pages.withColumn("page_id", F.coalesce("page_id", F.lit(start) + F.monotonically_increasing_id()))
    targets = targets_from_pages(pages)
    selected = select_sources(targets, a.budget, a.top_n)
    items = cap_pages(pages.withColumn("target", host_of("url")), a.max_pages).withColumn("rank", F.lit(1))
    counts = items.groupBy("target").agg(F.count(F.lit(1)).alias("n_items"))
    attempts = (selected.filter(F.col("rank") == 1).join(counts, "target", "left")
                .select("target", "rank", "source_id", F.lit("ok").alias("status"),
                        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                        F.lit(None).cast("string").alias("error")))
    runs = run_corpus_job(pages, attempts, items, a.as_of, a.out, a.budget, a.top_n, a.corpus_name)
    print(runs.count())
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
