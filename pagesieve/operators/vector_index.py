"""Exact cosine top-k over clustered vectors.

Build: unit vectors are assigned to the nearest of a bounded number of centres
(fitted on a bounded sample, which changes the work only); a cell knows its
radius, the largest distance of a vector from its centre. Large cells are dealt
over parts of about ``PART_ROWS`` vectors.

Search, with the queries as a table:
  1. every query reads its nearest cells until they hold k vectors; its k-th
     score there bounds the k-th score from below
  2. by the triangle inequality no vector of a cell is nearer than
     distance(query, centre) - radius. Cells whose best possible score is below
     the bound are skipped, the others are read
Vectors and queries of a (cell, part) meet in one sorted stream: a task holds the
vectors of one part and takes the queries batch by batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pagesieve.session import materialize

CELLS = 256
SAMPLE_ROWS = 8_192
ROUNDS = 8
PART_ROWS = 16_384


def unit(rows: np.ndarray) -> np.ndarray:
    size = np.sqrt((rows * rows).sum(axis=1))
    return rows / np.where(size, size, 1)[:, None]


def stack(column: pa.Array) -> np.ndarray:
    """A list column as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(float)


def matrix(column: pa.Array) -> np.ndarray:
    """A column of packed doubles as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def packed(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows, "<f8")], pa.binary())


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def fit_centres(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres by k-means on the sample, from rows at even steps of it."""
    cells = min(cells, len(sample))
    centres = sample[np.linspace(0, len(sample) - 1, cells).astype(int)]
    for _ in range(rounds):
        nearest = distances(sample, centres).argmin(axis=1)
        count = np.bincount(nearest, minlength=cells)
        total = np.zeros_like(centres)
        np.add.at(total, nearest, sample)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


class VectorIndex:
    """Vectors in cells. Keys must be integers; null or empty vectors are left out."""

    def __init__(self, vectors: DataFrame, key: str, vec: str, cells: int = CELLS, part_rows: int = PART_ROWS):
        self.key, self.kind = key, vectors.schema[key].dataType
        rows = vectors.select(F.col(key).cast("long").alias("key"),
                              F.transform(F.col(vec), lambda x: x.cast("double")).alias("v")).where(F.size("v") > 0)
        sample = rows.orderBy(F.xxhash64("key"), "key").limit(SAMPLE_ROWS).select("v").collect()
        self.centres = fit_centres(unit(np.array([r[0] for r in sample], float)), cells) if sample else np.zeros((0, 1))
        self.rows = materialize(self._assign(rows))
        own = {r["cell"]: r for r in self.rows.groupBy("cell").agg(
            F.max("dist").alias("radius"), F.count(F.lit(1)).alias("n")).collect()}  # ``cells`` rows at most
        count = range(len(self.centres))
        self.radius = np.array([own[c]["radius"] if c in own else 0.0 for c in count])
        self.count = np.array([own[c]["n"] if c in own else 0 for c in count], np.int64)
        self.parts = np.maximum(1, -(-self.count // part_rows))

    def _assign(self, rows: DataFrame) -> DataFrame:
        centres = self.centres

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                u = unit(stack(batch.column(1)))
                far = distances(u, centres)
                cell = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), packed(u), pa.array(cell, pa.int32()), pa.array(far[np.arange(len(cell)), cell])],
                    names=["key", "u", "cell", "dist"])

        return rows.mapInArrow(run, "key long, u binary, cell int, dist double")

    # -- search -----------------------------------------------------------

    def _queries(self, queries: DataFrame, qkey: str, qvec: str) -> DataFrame:
        return queries.select(F.col(qkey).alias("qid"),
                              F.transform(F.col(qvec), lambda x: x.cast("double")).alias("v")).where(F.size("v") > 0)

    def _first_cells(self, queries: DataFrame, k: int) -> DataFrame:
        """(qid, u, cell): each query's nearest cells that hold k vectors."""
        centres, count, kind = self.centres, self.count, queries.schema["qid"].dataType

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows or not count.sum():
                    continue
                u = unit(stack(batch.column(1)))
                order = distances(u, centres).argsort(axis=1, kind="stable")
                before = count[order].cumsum(axis=1) - count[order]
                row, place = np.nonzero((before < k) & (count[order] > 0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), packed(u[row]), pa.array(order[row, place], pa.int32())],
                    names=["qid", "u", "cell"])

        return queries.mapInArrow(run, f"qid {kind.simpleString()}, u binary, cell int")

    def _other_cells(self, bounded: DataFrame, k: int, decimals: int) -> DataFrame:
        """(qid, u, cell): the cells that may hold a score of ``floor`` or more,
        without those that were read first."""
        centres, count, radius, kind = self.centres, self.count, self.radius, bounded.schema["qid"].dataType

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows or not count.sum():
                    continue
                u = unit(stack(batch.column(1)))
                floor = batch.column(2).fill_null(-2.0).to_numpy(zero_copy_only=False)
                far = distances(u, centres)
                nearest = np.maximum(far - radius - 1e-9, 0)
                best = 1 - nearest * nearest / 2  # of vectors of length one at most
                order = far.argsort(axis=1, kind="stable")
                before = count[order].cumsum(axis=1) - count[order]
                first = np.zeros(far.shape, bool)
                np.put_along_axis(first, order, before < k, axis=1)
                row, cell = np.nonzero((best >= floor[:, None] - 10.0 ** -decimals) & ~first & (count > 0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), packed(u[row]), pa.array(cell, pa.int32())],
                    names=["qid", "u", "cell"])

        return bounded.mapInArrow(run, f"qid {kind.simpleString()}, u binary, cell int")

    def _best(self, asked: DataFrame, k: int, decimals: int) -> DataFrame:
        """(qid, key, score): the best ``k`` of every (query, cell, part)."""
        kind = asked.schema["qid"].dataType
        parts = F.array(*[F.lit(int(p)) for p in self.parts])[F.col("cell")]  # ``cells`` numbers
        own = self.rows.select("cell", F.pmod(F.xxhash64("key"), parts).cast("int").alias("part"), F.lit(0).alias("asks"),
                               "key", F.lit(None).cast(kind).alias("qid"), "u")
        asks = asked.select("cell", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(1).alias("asks"),
                            F.lit(None).cast("long").alias("key"), "qid", "u")
        # parts that nobody asks for stay where they are
        own = own.join(asks.select("cell", "part").distinct(), ["cell", "part"], "left_semi").select(own.columns)
        met = own.unionByName(asks).repartition("cell", "part").sortWithinPartitions("cell", "part", "asks")
        arrow = to_arrow_type(kind)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            here, held_keys, held = None, [], []
            for batch in batches:
                if not batch.num_rows:
                    continue
                cell, part, asks = (batch.column(i).to_numpy() for i in range(3))
                change = np.flatnonzero((cell[1:] != cell[:-1]) | (part[1:] != part[:-1]) | (asks[1:] != asks[:-1])) + 1
                for low, high in zip(np.append(0, change), np.append(change, len(cell)), strict=True):
                    piece = batch.slice(low, high - low)
                    u = matrix(piece.column(5))
                    if here != (cell[low], part[low]):
                        here, held_keys, held = (cell[low], part[low]), [], []
                    if not asks[low]:
                        held_keys.append(piece.column(3).to_numpy())
                        held.append(u)
                        continue
                    if not held:
                        continue
                    keys, v = np.concatenate(held_keys), np.concatenate(held)
                    held_keys, held = [keys], [v]
                    for at in range(0, len(u), 256):
                        scores = np.round(u[at:at + 256] @ v.T, decimals)
                        order = np.lexsort((np.broadcast_to(keys, scores.shape), -scores), axis=1)[:, :k]
                        ids = piece.column(4).slice(at, len(scores)).take(
                            pa.array(np.repeat(np.arange(len(scores)), order.shape[1])))
                        yield pa.RecordBatch.from_arrays(
                            [ids.cast(arrow), pa.array(keys[order].ravel()),
                             pa.array(np.take_along_axis(scores, order, 1).ravel())], names=["qid", "key", "score"])

        return met.mapInArrow(run, f"qid {kind.simpleString()}, key long, score double")

    def search(self, queries: DataFrame, qkey: str, qvec: str, k: int = 5, decimals: int = 6) -> DataFrame:
        """Top ``k`` vectors per query by cosine (rounded, ties by key): qkey,
        rank, the index's key, score. Query keys must be unique; a zero
        vector's scores are zero."""
        asked = materialize(self._queries(queries, qkey, qvec))
        first = materialize(self._best(self._first_cells(asked, k), k, decimals))
        place = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score")))
        floors = first.select("qid", "score", place.alias("n")).where(F.col("n") == k).select(
            F.col("qid").alias("_q"), F.col("score").alias("floor"))
        bounded = asked.join(floors, F.col("qid").eqNullSafe(F.col("_q")), "left").select("qid", "v", "floor")
        rest = self._best(self._other_cells(bounded, k, decimals), k, decimals)
        w = Window.partitionBy("qid").orderBy(F.desc("score"), F.asc("key"))
        top = first.unionByName(rest).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        return top.select(F.col("qid").alias(qkey), "rank", F.col("key").cast(self.kind).alias(self.key), "score")

    def cells_read(self, queries: DataFrame, qkey: str, qvec: str, k: int = 5, decimals: int = 6) -> float:
        """The share of (query, cell) pairs that a search reads."""
        asked = self._queries(queries, qkey, qvec)
        hits = self.search(queries, qkey, qvec, k, decimals).where(F.col("rank") == k).select(
            F.col(qkey).alias("_q"), F.col("score").alias("floor"))
        bounded = asked.join(hits, F.col("qid") == F.col("_q"), "left").select("qid", "v", "floor")
        read = self._first_cells(asked, k).count() + self._other_cells(bounded, k, decimals).count()
        return read / max(1, asked.count() * int((self.count > 0).sum()))
