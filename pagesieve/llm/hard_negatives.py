"""Hard-negative mining with angular triangle filtering.

Vectors become integers, ``floor(256 * x)``; a row's score for an anchor is their
integer inner product. Every row stores its norm and its angles to ``REFERENCES``
reference directions. For an anchor ``a`` and a row ``x`` the triangle inequality of
angles gives, for each direction r,

    |angle(a, r) - angle(x, r)| <= angle(a, x) <= angle(a, r) + angle(x, r)

(and 2 pi less that sum), hence an interval of the cosine; times the norms, and
widened by more than the rounding of the stored angles, it bounds the score. Only
rows whose bounds overlap the window an anchor asks for get an integer score:

1. *Positives.* The window is open above: scores from the worst of the best ones
   found so far. The rows with the highest bounds are scored first.
2. *Negatives.* Each positive asks for the scores between 30 and 90 hundredths of
   its own; from the tenth found so far on, for higher ones only.

Anchors are a stated query set against all rows: they lie in blocks of ``BLOCK`` rows
in the shared folder, and each task takes its rows in chunks of ``CHUNK`` and reads the
blocks one after the other. A chunk passes on the best rows of each anchor (or
positive); the rest of the ranking is a window over those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagesieve.llm import arrowtext as A
from pagesieve.llm.records import file_system
from pagesieve.llm.tables import materialize, scratch_path

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
WINDOW = (30, 90)  # hundredths of the positive's score
ANCHOR_EVERY = 100
REFERENCES = 32
SAMPLE_ROWS = 2_048
BLOCK = 1_024  # anchors in a file
STEP = 128  # anchors looked at together
PIECE = 4_096  # rows looked at together
CHUNK = 65_536  # rows of a task held together
ANGLE_ERROR = 4e-6  # stored angles are 32-bit: each is off by 3e-7 at most
COSINE_ERROR = 2e-6
EXACT = 2.0 ** 53
TOO_LARGE = 2.0 ** 500  # its square is a double
LEAST, MOST = -(1 << 63), (1 << 63) - 1


# ---------------------------------------------------------------------------
# Rows: integer vectors, norms, angles
# ---------------------------------------------------------------------------

def matrix(rows: list[bytes]) -> np.ndarray:
    """Rows of 64-bit numbers as a matrix; shorter rows end in zeros."""
    width = max((len(r) for r in rows), default=0)
    if any(len(r) != width for r in rows):
        rows = [r.ljust(width, b"\0") for r in rows]
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), width // 8)


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x for x in (a, b))


def spread_directions(sample: np.ndarray, count: int = REFERENCES) -> np.ndarray:
    """Unit vectors far from each other: the next is the row of the sample with
    the largest angle to its nearest one so far."""
    norms = np.sqrt((sample * sample).sum(axis=1))
    unit = sample[norms > 0] / norms[norms > 0][:, None]
    if not len(unit):
        return np.zeros((0, sample.shape[1]))
    taken, nearest = [0], unit @ unit[0]
    while len(taken) < min(count, len(unit)):
        taken.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, unit @ unit[taken[-1]])
    return unit[taken]


def angles_to(vectors: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles of rows to the references, 32-bit; a zero vector gets right angles."""
    vectors, references = same_width(vectors, references)
    cosines = (vectors / np.where(norms > 0, norms, 1)[:, None]) @ references.T
    return np.arccos(np.clip(cosines, -1, 1)).astype(np.float32)


def participants(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v): the rows that take part, one of each id."""
    def scaled(x: Column) -> Column:
        return SCALE * x.cast("double")

    def whole(x: Column) -> Column:
        # floor gives a long; what is past 2**53 has no fraction
        return F.when(F.abs(scaled(x)) < EXACT, F.floor(scaled(x)).cast("double")).otherwise(scaled(x))

    usable = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(scaled(x)) < TOO_LARGE))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull())
    one = rows.where(usable).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.struct(F.col(label_col).alias("label"), F.transform(F.col(vec_col), whole).alias("v")).alias("row"))
    return one.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.v")


def with_angles(rows: DataFrame, references: np.ndarray) -> DataFrame:
    """(vec_id, label, v, norm, angles): vectors and angles as bytes."""
    kind = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, PIECE):
                part = batch.slice(low, PIECE)
                raw = [np.asarray(x, "<f8").tobytes() for x in A.column(part, "v").to_pylist()]
                v = matrix(raw)
                norms = np.sqrt((v * v).sum(axis=1))
                angles = angles_to(v, norms, references)
                yield pa.RecordBatch.from_arrays(
                    [A.column(part, "vec_id"), A.column(part, "label"), pa.array(raw, pa.binary()), pa.array(norms),
                     pa.array([x.tobytes() for x in angles], pa.binary())],
                    names=["vec_id", "label", "v", "norm", "angles"])

    return rows.mapInArrow(run, f"vec_id long, label {kind}, v binary, norm double, angles binary")


class Rows:
    """Rows of ``with_angles`` as arrays, ordered by label and nearest reference."""

    def __init__(self, table: pa.Table):
        ids = table["vec_id"].to_numpy()
        labels = table["label"].to_numpy()
        flat = b"".join(table["angles"].to_pylist())
        angles = np.frombuffer(flat, np.float32).reshape(len(ids), -1)
        near = angles.argmin(axis=1) if angles.shape[1] else np.zeros(len(ids), int)
        self.order = np.lexsort((ids, near, labels))
        self.ids, self.labels, self.angles = ids[self.order], labels[self.order], angles[self.order]
        self.v = matrix(table["v"].to_pylist())[self.order]
        self.norms = table["norm"].to_numpy()[self.order]

    def cut(self, low: int, high: int) -> Rows:
        out = object.__new__(Rows)
        for name in ("ids", "labels", "angles", "v", "norms"):
            setattr(out, name, getattr(self, name)[low:high])
        return out

    def take(self, rows: np.ndarray) -> np.ndarray:
        return self.v[rows]


# ---------------------------------------------------------------------------
# Bounds and scores
# ---------------------------------------------------------------------------

def score_bounds(anchors: Rows, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of all scores, safe against rounding."""
    least = np.zeros((len(anchors.ids), len(rows.ids)), np.float32)
    most = np.full(least.shape, np.pi, np.float32)
    for k in range(anchors.angles.shape[1]):
        a, x = anchors.angles[:, k, None], rows.angles[None, :, k]
        np.maximum(least, np.abs(a - x), out=least)
        both = a + x
        np.minimum(most, np.minimum(both, np.float32(2 * np.pi) - both), out=most)
    sizes = anchors.norms[:, None] * rows.norms[None, :]
    slack = sizes * COSINE_ERROR + 1
    upper = sizes * np.cos(np.maximum(least - np.float32(ANGLE_ERROR), 0)) + slack
    lower = sizes * np.cos(np.minimum(most + np.float32(ANGLE_ERROR), np.float32(np.pi))) - slack
    return np.minimum(lower, MOST), np.maximum(upper, LEAST + 1)


def scores(a: np.ndarray, x: np.ndarray, largest: float) -> np.ndarray:
    """Inner products of integer rows, exact; beyond 64 bits the largest (or
    smallest) long. Below 2**53 doubles add without rounding."""
    a, x = same_width(a, x)
    if largest < EXACT:
        return (a @ x.T).astype(np.int64)
    exact = np.array([[int(v) for v in r] for r in a.tolist()], object).reshape(a.shape)
    other = np.array([[int(v) for v in r] for r in x.tolist()], object).reshape(x.shape)
    product = exact @ other.T if a.shape[1] else np.zeros((len(a), len(x)), object)
    return np.clip(product, LEAST + 1, MOST).astype(np.int64)


def best(found: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the first ``k`` columns of each row by score, ties by id;
    LEAST is no score."""
    n = found.shape[1]
    wanted = found > LEAST
    if n > k:
        wanted &= found >= np.partition(found, n - k, axis=1)[:, n - k, None]
    row, column = np.nonzero(wanted)
    return ranked(row, found[row, column], ids[column], k, column)


def ranked(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int, of: np.ndarray) -> tuple[np.ndarray, ...]:
    """(group, of) of the first ``k`` of each group by score, ties by id."""
    order = np.lexsort((ids, -score, group))
    group = group[order]
    first = np.searchsorted(group, group)
    keep = np.arange(len(group)) - first < k
    return group[keep], of[order][keep]


class Best:
    """The best rows of each of ``n`` lists so far."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.group = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.floor = np.full(n, LEAST)  # the k-th best

    def add(self, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """Add (list, id, score) of rows."""
        group, ids, score = (np.concatenate(x) for x in zip((self.group, self.ids, self.score), *found, strict=True))
        _, kept = ranked(group, score, ids, self.k, np.arange(len(group)))
        self.group, self.ids, self.score = group[kept], ids[kept], score[kept]
        full = np.flatnonzero(np.bincount(self.group, minlength=self.n) == self.k)
        self.floor[full] = self.score[np.searchsorted(self.group, full, side="right") - 1]


def pieces(rows: Rows, size: int) -> Iterator[Rows]:
    """Pieces of rows of one label; rows are in label order."""
    borders = np.flatnonzero(rows.labels[1:] != rows.labels[:-1]) + 1
    if not len(rows.ids):
        return
    for low, high in zip(np.append(0, borders), np.append(borders, len(rows.ids)), strict=True):
        for at in range(low, high, size):
            yield rows.cut(at, min(at + size, high))


def overlapping(anchors: Rows, rows: Rows, low: np.ndarray, high: np.ndarray | None,
                usable: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchors, rows, scores) of what is left of a step and a piece: the scores
    of pairs whose bounds overlap the anchor's window [low, high] and that are
    ``usable``, LEAST for others."""
    lower, upper = score_bounds(anchors, rows)
    wanted = usable & (upper >= low[:, None])
    if high is not None:
        wanted &= lower <= high[:, None]
    a, x = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
    if not len(a):
        return a, x, np.zeros((0, 0), np.int64)
    largest = float(anchors.norms[a].max() * rows.norms[x].max())
    return a, x, np.where(wanted[np.ix_(a, x)], scores(anchors.take(a), rows.take(x), largest), LEAST)


def first_floor(anchors: Rows, piece: Rows, usable: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score among the rows with the highest bounds, or -inf."""
    _, upper = score_bounds(anchors, piece)
    first = np.argpartition(-np.where(usable, upper, -np.inf), min(2 * k, len(piece.ids)) - 1, axis=1)[:, :2 * k]
    floor = np.full(len(anchors.ids), -np.inf)
    for i in range(len(floor)):
        columns = first[i][usable[i, first[i]]]
        if len(columns) >= k:
            largest = float(anchors.norms[i] * piece.norms[columns].max())
            floor[i] = float(np.sort(scores(anchors.v[i:i + 1], piece.v[columns], largest)[0])[-k])
    return floor


def positives_of(anchors: Rows, rows: Rows, k: int = POSITIVES) -> Iterator[tuple[np.ndarray, Best]]:
    """(anchors, their best rows) of the anchors' own labels, other than the
    anchors; anchors are in label order."""
    for step in pieces(anchors, STEP):
        found = Best(len(step.ids), k)
        for piece in pieces(rows, PIECE):
            if piece.labels[0] != step.labels[0]:
                continue
            usable = step.ids[:, None] != piece.ids[None, :]
            floor = found.floor.astype(float)
            if (found.floor == LEAST).any():
                floor = np.maximum(floor, first_floor(step, piece, usable, k))
            a, x, s = overlapping(step, piece, floor, None, usable)
            if len(a):
                row, column = best(s, piece.ids[x], k)
                found.add([(a[row], piece.ids[x[column]], s[row, column])])
        yield step.ids, found


def window_of(score: int, window: tuple[int, int] = WINDOW) -> tuple[int, int] | None:
    """The scores s with window[0] * score <= 100 * s <= window[1] * score."""
    low, high = -(-window[0] * score // 100), window[1] * score // 100
    return (low, high) if low <= high else None


def negatives_of(anchors: Rows, asked: list[list[tuple[int, int]]], rows: Rows, k: int = NEGATIVES,
                 window: tuple[int, int] = WINDOW) -> Iterator[tuple[list[tuple[int, int, int]], Best]]:
    """(lists, their best rows): a list is (anchor id, positive id, score) and
    takes rows of other labels; ``asked`` has (positive id, score) per anchor."""
    at = 0
    for step in pieces(anchors, STEP):
        lists, limits, owner, place = [], [], [], []
        for i, own in enumerate(asked[at:at + len(step.ids)]):
            for j, (positive, score) in enumerate(own):
                if limit := window_of(score, window):
                    lists.append((int(step.ids[i]), positive, score))
                    limits.append(limit)
                    owner.append(i)
                    place.append(j)
        at += len(step.ids)
        found = Best(len(lists), k)
        owner, place, limit = np.array(owner, np.int64), np.array(place, np.int64), np.array(limits).reshape(-1, 2)
        for piece in pieces(rows, PIECE) if lists else ():
            if piece.labels[0] == step.labels[0]:
                continue
            least, most = np.full(len(step.ids), np.inf), np.full(len(step.ids), -np.inf)
            np.minimum.at(least, owner, np.maximum(limit[:, 0], found.floor).astype(float))
            np.maximum.at(most, owner, limit[:, 1].astype(float))
            a, x, s = overlapping(step, piece, least, most, np.ones((len(step.ids), len(piece.ids)), bool))
            if not len(a):
                continue
            line = np.full(len(step.ids), -1)
            line[a] = np.arange(len(a))
            new = []
            for j in range(place.max() + 1):
                here = np.flatnonzero((place == j) & (line[owner] >= 0))
                part = s[line[owner[here]]]
                part = np.where((part >= limit[here, :1]) & (part <= limit[here, 1:]), part, LEAST)
                row, column = best(part, piece.ids[x], k)
                new.append((here[row], piece.ids[x[column]], part[row, column]))
            found.add(new)
        yield lists, found


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------

def write_blocks(anchors: DataFrame, block: int = BLOCK) -> list[str]:
    """Write anchors as files of ``block`` rows at most in the shared folder."""
    spark = anchors.sparkSession
    folder = scratch_path(spark, "anchors")
    count = anchors.count()
    if not count:
        return []
    anchors.repartitionByRange(-(-count // block), "label", "vec_id").write.option(
        "maxRecordsPerFile", block).parquet(folder)
    return sorted(spark.read.parquet(folder).inputFiles())


def load(path: str) -> pa.Table:
    system, root = file_system(path)
    with system.open_input_file(root) as source:
        return pq.read_table(source)


def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        for low in range(0, batch.num_rows, size):
            held.append(batch.slice(low, size))
            count += held[-1].num_rows
            if count >= size:
                yield pa.Table.from_batches(held)
                held, count = [], 0
    if count:
        yield pa.Table.from_batches(held)


def dealt(rows: DataFrame, total: int, chunk: int) -> DataFrame:
    """Rows over as many tasks as there are chunks, and over all cores."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(2 * cores, -(-total // chunk)), "vec_id")


def find_positives(rows: DataFrame, paths: list[str], total: int, k: int = POSITIVES, chunk: int = CHUNK) -> DataFrame:
    """(anchor_id, positive_id, positive_score) of the first ``k`` rows of each
    anchor's label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, chunk):
            own = Rows(table)
            for path in paths:
                anchors = Rows(load(path))
                for ids, found in positives_of(anchors, own, k):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[found.group]), pa.array(found.ids), pa.array(found.score)],
                        names=["anchor_id", "positive_id", "positive_score"])

    seen = dealt(rows, total, chunk).mapInArrow(run, "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return seen.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def find_negatives(rows: DataFrame, paths: list[str], total: int, k: int = NEGATIVES, chunk: int = CHUNK,
                   window: tuple[int, int] = WINDOW) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, scores) of the first ``k``
    rows of other labels in each positive's window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, chunk):
            own = Rows(table)
            for path in paths:
                block = load(path)
                anchors = Rows(block)
                positives = block["positives"].to_pylist()
                asked = [[(p["positive_id"], p["positive_score"]) for p in positives[i]] for i in anchors.order]
                for lists, found in negatives_of(anchors, asked, own, k, window):
                    named = np.array(lists, np.int64).reshape(-1, 3)[found.group]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(named[:, 0]), pa.array(named[:, 1]), pa.array(found.ids),
                         pa.array(named[:, 2]), pa.array(found.score)],
                        names=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    seen = dealt(rows, total, chunk).mapInArrow(run, "anchor_id long, positive_id long, negative_id long, "
                                                     "positive_score long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return seen.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mine_hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                        label_col: str = "label", every: int = ANCHOR_EVERY, positives: int = POSITIVES,
                        negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW, chunk: int = CHUNK,
                        block: int = BLOCK) -> DataFrame:
    """Return anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score: for each anchor (id divisible by ``every``) and each of its first
    ``positives`` other rows of the same label, the first ``negatives`` rows of other
    labels whose score is between the ``window``'s hundredths of the positive's.

    Higher scores come first, ties by smaller id. Rows with a null id, label
    or vector, or a component that is null, not finite or too large to be
    multiplied by 256 take no part. Rows that repeat an id count as one: the
    smallest label, then the smallest vector. Vectors of different lengths
    end in zeros; an empty or zero vector scores zero. Scores beyond 64 bits
    count as the largest or smallest long. A positive with a negative score has
    an empty window. An empty table gives no row. The reference directions
    come from the ``SAMPLE_ROWS`` rows whose ids have the smallest hashes and
    change the work only.
    """
    rows = participants(vectors, id_col, vec_col, label_col)
    return mine(rows, every, positives, negatives, window, chunk, block)


def mine(rows: DataFrame, every: int, positives: int, negatives: int, window: tuple[int, int], chunk: int,
         block: int) -> DataFrame:
    """``mine_hard_negatives`` over participants (vec_id, label, v)."""
    rows = materialize(rows)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("v").collect()
    references = spread_directions(matrix([np.asarray(r[0], "<f8").tobytes() for r in sample]))
    rows = materialize(with_angles(rows, references))
    total = rows.count()
    anchors = rows.where(F.col("vec_id") % every == 0)
    found = find_positives(rows, write_blocks(anchors, block), total, positives, chunk)
    per_anchor = found.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))  # ``positives`` at most
    asked = write_blocks(materialize(anchors.join(per_anchor, "vec_id")), block)
    return find_negatives(rows, asked, total, negatives, chunk, window)
