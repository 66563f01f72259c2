"""Source fallback over a stream of attempts, with state per target.

The winner of a target leaves as soon as it is certain: its attempt succeeded and
every lower rank has failed, in whatever order the attempts arrived. A target that is
not decided ``wait`` after its last attempt (in event time, once the watermark has
passed) is closed: its best successful attempt wins, although a lower rank never
reported; without one the target has failed. Closed targets leave the state.

State is bounded by the ranks of a target; no attempt is read twice, and the pages
of the attempts are not read at all.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pagesieve.operators.fallback import ALL_FAILED, attempt_error, succeeded
from pagesieve.session import ensure_checkpoint_dir, scratch_path

ATTEMPT_SCHEMA = T.StructType([
    T.StructField("target", T.StringType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("n_items", T.LongType()),
    T.StructField("error", T.StringType()),
    T.StructField("ended_at", T.TimestampType()),
])
OUTCOMES = "target string, outcome string, rank int, source_id string, attempts long, error string"
FIRST_RANK = 1


def certain_winner(known: dict[str, list]) -> int | None:
    """The rank that succeeded while all before it failed, if it is known yet."""
    rank = FIRST_RANK
    while str(rank) in known:
        if known[str(rank)][1]:
            return rank
        rank += 1
    return None


def outcomes(attempts: DataFrame, wait: dt.timedelta, delay: str) -> DataFrame:
    """A row (``OUTCOMES``) per target and run of it: ``won`` with rank and source, or
    ``failed`` with the error of the last rank. Ranks count from 1. A (target, rank)
    has one attempt in a run; of more of them the first to arrive counts (in one
    batch: the smallest source). Rows without target or rank only move the watermark."""
    patience = int(wait.total_seconds() * 1000)

    def row(target: str, outcome: str, rank: int, known: dict[str, list]) -> pd.DataFrame:
        source, won, error = known[str(rank)]
        return pd.DataFrame({"target": [target], "outcome": [outcome], "rank": [rank], "source_id": [source],
                             "attempts": [len(known)], "error": [None if won else error or ALL_FAILED]})

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        target = key[0]
        if state.hasTimedOut:
            known, decided, _ = state.get
            state.remove()
            known = json.loads(known)
            if not decided:
                ranks = sorted(map(int, known))
                won = [r for r in ranks if known[str(r)][1]]
                yield row(target, "won", won[0], known) if won else row(target, "failed", ranks[-1], known)
            return
        held, decided, last = state.get if state.exists else ("{}", False, 0)
        known = json.loads(held)
        arrived = []
        for frame in frames:
            frame = frame[frame["rank"].notna()]
            last = max([last, *(frame["ended_at"].astype("datetime64[ms]").astype("int64"))])
            arrived += zip(frame["rank"].astype("int64"), frame["source_id"], frame["won"], frame["error"], strict=True)
        if target is None or (not arrived and not known):
            return
        for rank, source, won, error in sorted(arrived, key=lambda a: (a[0], a[1] is not None, a[1] or "")):
            known.setdefault(str(rank), [source, bool(won), error])
        if not decided and (rank := certain_winner(known)) is not None:
            decided = True
            yield row(target, "won", rank, known)
        state.update((json.dumps(known), decided, int(last)))
        # never before the watermark: such a timeout is for the next batch
        state.setTimeoutTimestamp(max(int(last) + patience, state.getCurrentWatermarkMs() + 1))

    rows = attempts.select("target", "rank", "source_id", F.coalesce(succeeded(), F.lit(False)).alias("won"),
                           attempt_error().alias("error"), "ended_at")
    return (rows.withWatermark("ended_at", delay).groupBy("target")
            .applyInPandasWithState(follow, OUTCOMES, "known string, decided boolean, last long", "append",
                                    GroupStateTimeout.EventTimeTimeout))


def follow_attempts(spark: SparkSession, source_dir: str, out_path: str, wait: dt.timedelta, delay: str = "1 hour",
                    checkpoint: str | None = None, max_files_per_trigger: int | None = None):
    """Start the stream over files of attempts (``ATTEMPT_SCHEMA``) and return its
    query handle; outcomes are appended to ``out_path``. Run again with the same
    checkpoint, it takes new files only."""
    if checkpoint is None:
        checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pagesieve-stream/{uuid.uuid4().hex}"
    reader = spark.readStream.schema(ATTEMPT_SCHEMA).option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (outcomes(reader.parquet(source_dir), wait, delay).writeStream.format("parquet")
            .option("checkpointLocation", checkpoint).option("path", out_path)
            .outputMode("append").trigger(availableNow=True).start())


def run_attempts(spark: SparkSession, arrivals: list[DataFrame], wait: dt.timedelta, delay: str = "1 hour") -> DataFrame:
    """Follow batches of attempts in the order they arrive and return all outcomes."""
    base = scratch_path(spark, "attempts")
    for i, batch in enumerate(arrivals):
        batch.select(*ATTEMPT_SCHEMA.names).write.parquet(f"{base}/in/{i:06d}")
        q = follow_attempts(spark, f"{base}/in", f"{base}/out", wait, delay, f"{base}/checkpoint")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return spark.read.schema(OUTCOMES).parquet(f"{base}/out")
