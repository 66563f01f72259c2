"""Change detection over a stream of crawls, with state per URL.

The state of a URL is the hash of its content and when it was last seen. A page is
``new``, ``changed`` or ``unchanged`` against that state alone: no stored corpus is
read. A URL that is not seen for ``expiry`` of event time is reported as ``gone`` once
the watermark has passed, and its state is dropped, so the state holds the live
URLs only. Contents are hashed before the shuffle; only hashes move.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pagesieve.session import ensure_checkpoint_dir, scratch_path

CRAWL_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("crawled_at", T.TimestampType()),
])
CHANGES = "url string, page_id long, status string, content_sha256 string, crawled_at timestamp"
STATE = "content_sha256 string, page_id long, seen long"
MICROS = 1_000_000


def page_hashes(crawl: DataFrame) -> DataFrame:
    """(url, page_id, content_sha256, crawled_at); a missing URL is named by its
    page, missing content counts as empty."""
    url = F.coalesce("url", F.concat(F.lit("unknown-"), F.col("page_id").cast("string")))
    return crawl.select(url.alias("url"), "page_id", F.sha2(F.coalesce("html", F.lit("")), 256).alias("content_sha256"),
                        "crawled_at")


def page_changes(hashes: DataFrame, expiry: dt.timedelta, delay: str = "0 seconds") -> DataFrame:
    """The changes of a stream of ``page_hashes``. Of several rows of a URL with
    one time the smallest page id counts; older rows than the last seen are
    left out."""
    kept = int(expiry.total_seconds() * MICROS)

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        url = key[0]
        if state.hasTimedOut:
            sha, page, seen = state.get
            state.remove()
            yield pd.DataFrame({"url": [url], "page_id": [page], "status": ["gone"], "content_sha256": [sha],
                                "crawled_at": [pd.Timestamp(seen, unit="us")]})
            return
        first: dict[int, tuple[int, str]] = {}  # the page of each crawl of this batch
        for frame in frames:
            times = frame["crawled_at"].astype("datetime64[us]").astype("int64")
            for at, page, sha in zip(times, frame["page_id"], frame["content_sha256"], strict=True):
                if at not in first or page < first[at][0]:
                    first[at] = (int(page), sha)
        known = state.get if state.exists else None
        rows = []
        for at in sorted(first):
            page, sha = first[at]
            if known and at <= known[2]:
                continue
            status = "new" if known is None else "unchanged" if known[0] == sha else "changed"
            rows.append((url, page, status, sha, pd.Timestamp(at, unit="us")))
            known = (sha, page, at)
        if rows:
            state.update(known)
            # never before the watermark: such a timeout is for the next batch
            state.setTimeoutTimestamp(max(known[2] + kept, state.getCurrentWatermarkMs() * 1000 + 1000) // 1000)
            yield pd.DataFrame(rows, columns=["url", "page_id", "status", "content_sha256", "crawled_at"])

    return (hashes.withWatermark("crawled_at", delay).groupBy("url")
            .applyInPandasWithState(follow, CHANGES, STATE, "append", GroupStateTimeout.EventTimeTimeout))


def follow_crawls(spark: SparkSession, source_dir: str, out_path: str, expiry: dt.timedelta,
                  checkpoint: str | None = None, glob: str = "*.parquet", max_files_per_trigger: int | None = None):
    """Start the stream over crawl files, oldest first, and return its query
    handle; changes are appended to ``out_path``. Run again with the same
    checkpoint, it takes new files only."""
    if checkpoint is None:
        checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pagesieve-stream/{uuid.uuid4().hex}"
    reader = spark.readStream.schema(CRAWL_SCHEMA).option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    changes = page_changes(page_hashes(reader.parquet(source_dir)), expiry)
    return (changes.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", out_path)
            .outputMode("append").trigger(availableNow=True).start())


def run_crawls(spark: SparkSession, crawls: list[DataFrame], expiry: dt.timedelta) -> DataFrame:
    """Follow crawls (``CRAWL_SCHEMA``) one after the other and return all changes."""
    base = scratch_path(spark, "crawls")
    for i, crawl in enumerate(crawls):
        crawl.select(*CRAWL_SCHEMA.names).write.parquet(f"{base}/in/{i:06d}")
        q = follow_crawls(spark, f"{base}/in", f"{base}/out", expiry, f"{base}/checkpoint")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return spark.read.schema(CHANGES).parquet(f"{base}/out")
