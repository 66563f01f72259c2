"""A store of content-defined pieces: an append adds only what an edit touched.

A text is cut, as UTF-8 bytes, behind bytes where a rolling hash of the last ``WINDOW``
bytes falls below a threshold, so a cut depends on the bytes around it alone and an
edit moves only the pieces it touches. A cut closer than ``MIN_BYTES`` to another hash
cut before it does not count; a longer stretch without a cut is cut every ``MAX_BYTES``.

A store keeps a row per different piece and a recipe per text (which pieces, in which
order). Appends write new files beside the old ones; one version file makes them part
of the store in one step, so a lost writer leaves nothing half added.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesieve.operators import versions
from pagesieve.session import materialize

WINDOW = 16
MULTIPLIER = 31
SPREAD = 2_654_435_761  # odd: mixes the low bits of the sum into the high ones
SHARE = 1024            # one byte in SHARE is a cut, on the average
MIN_BYTES = 64
MAX_BYTES = 8192
#: weight of the byte ``j`` places back, modulo 2**32
WEIGHTS = [pow(MULTIPLIER, j, 1 << 32) for j in range(WINDOW)]

PIECES = "seq int, start long, data binary"


def cut_ends(raw: bytes) -> np.ndarray:
    """The ends of the pieces of a text, the last one included."""
    n = len(raw)
    data = np.frombuffer(raw, np.uint8)
    if n > WINDOW:
        total = np.zeros(n - WINDOW + 1, np.uint32)
        for j, weight in enumerate(WEIGHTS):
            total += data[WINDOW - 1 - j:n - j].astype(np.uint32) * np.uint32(weight)
        total *= np.uint32(SPREAD)
        ends = np.flatnonzero(total < np.uint32((1 << 32) // SHARE)) + WINDOW
        ends = ends[np.diff(ends, prepend=-MIN_BYTES) >= MIN_BYTES]
    else:
        ends = np.zeros(0, np.int64)
    borders = np.unique(np.concatenate([[0], ends, [n]]))
    gaps = np.diff(borders)
    forced = [np.arange(borders[i] + MAX_BYTES, borders[i + 1], MAX_BYTES) for i in np.flatnonzero(gaps > MAX_BYTES)]
    return np.unique(np.concatenate([borders[1:], *forced]).astype(np.int64))


def cut_pieces(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, seq, start, data, sha256): the pieces of every text, in place. A null or
    empty text has none; rows that repeat a key are cut each."""
    kind = docs.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):  # pieces of one text at a time
                raw = batch.column(1)[row].as_py()
                if not raw:
                    continue
                ends = cut_ends(raw)
                starts = np.concatenate([[0], ends[:-1]])
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column(0)[row].as_py()] * len(ends), batch.schema.field(0).type),
                    pa.array(np.arange(len(ends)), pa.int32()), pa.array(starts, pa.int64()),
                    pa.array([raw[a:b] for a, b in zip(starts, ends, strict=True)], pa.binary())],
                    names=["key", "seq", "start", "data"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("raw"))
    return (rows.mapInArrow(cut, f"key {kind}, {PIECES}")
            .withColumn("sha256", F.sha2("data", 256)))


class PieceStore:
    """Pieces and recipes under ``root``; every method reads the newest version."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _state(self) -> tuple[int, dict]:
        number, state = versions.current(self.spark, self.root)
        return number, state or {"pieces": [], "recipes": [], "batches": []}

    def _read(self, folders: list[str], schema: str) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def pieces(self) -> DataFrame:
        """(sha256, data): every different piece once."""
        return self._read(self._state()[1]["pieces"], "sha256 string, data binary")

    def recipes(self) -> DataFrame:
        """(batch, key, n_pieces, seq, start, sha256); a text without pieces has one row
        with a null sha256."""
        return self._read(self._state()[1]["recipes"],
                          "batch string, key string, n_pieces int, seq int, start long, sha256 string")

    def append(self, docs: DataFrame, batch: str, key: str = "key", text: str = "text") -> bool:
        """Add a batch of texts under a name. Only pieces the store does not hold are
        written: an anti join by hash reads no piece that is stored. A batch the store has is not
        added again (False): a run that is repeated changes nothing. Keys are strings
        and must be given and different within a batch."""
        number, state = self._state()
        if batch in state["batches"]:
            return False
        rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
        cut = materialize(cut_pieces(rows, "key", "text"))
        known = self._read(state["pieces"], "sha256 string, data binary").select("sha256")
        name = f"data/{uuid.uuid4().hex}"
        # hashes are made different first: a piece of very many texts leaves one row a task
        (cut.select("sha256", "data").dropDuplicates(["sha256"]).join(known, "sha256", "left_anti")
         .write.parquet(f"{self.root}/{name}/pieces"))
        sizes = cut.groupBy("key").agg(F.count(F.lit(1)).cast("int").alias("n_pieces"))
        empty = rows.where(F.coalesce(F.length("text"), F.lit(0)) == 0).select(
            "key", F.lit(0).alias("n_pieces"), F.lit(0).alias("seq"), F.lit(0).cast("long").alias("start"),
            F.lit(None).cast("string").alias("sha256"))
        recipe = cut.join(sizes, "key").select("key", "n_pieces", "seq", "start", "sha256").unionAll(empty)
        (recipe.select(F.lit(batch).alias("batch"), "*").write.parquet(f"{self.root}/{name}/recipes"))
        versions.commit(self.spark, self.root, number, {
            "pieces": [*state["pieces"], f"{name}/pieces"], "recipes": [*state["recipes"], f"{name}/recipes"],
            "batches": [*state["batches"], batch]})
        return True

    def texts(self, batch: str) -> DataFrame:
        """(key, n_pieces, text): the texts of a batch, put together again."""
        recipe = self.recipes().where(F.col("batch") == batch)
        held = recipe.join(self.pieces(), "sha256", "left")
        parts = F.array_sort(F.collect_list(F.struct("seq", F.hex("data").alias("part"))))
        whole = F.unhex(F.array_join(F.transform(parts, lambda p: F.coalesce(p["part"], F.lit(""))), ""))
        return held.groupBy("key").agg(F.max("n_pieces").alias("n_pieces"), whole.cast("string").alias("text"))
