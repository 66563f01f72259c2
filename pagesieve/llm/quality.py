"""Quality classifier: random Fourier features over document statistics, ridge
regression by partition-summed normal equations, isotonic calibration.

1. ``document_statistics`` turns each whole text into ``STATISTICS`` numbers
   (vector operations on the bytes; A-Z, digits, marks, words, lines).
2. Random Fourier features (cosines of random projections) make inner products
   that approximate a Gaussian kernel over the standardised statistics.
3. Each partition sums its part of the normal equations; the sums of all
   partitions meet row by row of the matrix, and the driver solves a system of
   ``features`` unknowns, whatever the number of documents.
4. Ridge scores of the calibration rows (a fold the ridge fit has not seen) are
   counted in ``SCORE_BINS`` bins; pool-adjacent-violators over the bins gives
   the monotone map from score to probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesieve.llm import arrowtext as A
from pagesieve.llm.tables import id_text, materialize

FEATURES = 256
BANDWIDTH = 3.0
RIDGE = 1e-3
SCORE_BINS = 2000
SEED = 5

_GROUPS = {  # byte groups counted as shares of the text
    "blank": b" ", "newline": b"\n", "period": b".", "comma": b",", "bang": b"!", "bar": b"|",
    "symbol": b"#$%&*@^~<>=+{}[]\\/_`", "digit": b"0123456789", "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)), "control": bytes([*range(9), *range(11, 32), 127]),
}
_OTHER = len(_GROUPS)
_HIGH = _OTHER + 1
_GROUP_OF = np.full(256, _OTHER, np.int64)
for _k, _bytes in enumerate(_GROUPS.values()):
    _GROUP_OF[list(_bytes)] = _k
_GROUP_OF[128:] = _HIGH
N_GROUPS = _HIGH + 1

STATISTICS = (*(f"share_{g}" for g in _GROUPS), "share_other", "share_high", "log_bytes", "log_words", "log_lines",
              "word_length", "word_length_spread", "distinct_words", "repeated_neighbour", "distinct_pairs",
              "marked_words", "upper_words", "words_per_line", "words_per_period", "first_word_again")


def slice_statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS per document of a slice."""
    n = len(offsets) - 1
    length = np.diff(offsets).astype(float)
    row = np.repeat(np.arange(n), np.diff(offsets))
    groups = np.bincount(row * N_GROUPS + _GROUP_OF[data], minlength=n * N_GROUPS).reshape(n, N_GROUPS).astype(float)
    doc, starts, ends = A.word_spans(data, offsets, A.ASCII_SPACE)
    words = np.bincount(doc, minlength=n).astype(float)
    some = np.maximum(words, 1)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=values, minlength=n) / some

    size = (ends - starts).astype(float)
    mean_size = mean(size)
    spread = np.sqrt(np.maximum(mean(size * size) - mean_size**2, 0))
    if len(starts):
        hashes = A.span_hashes(A.ASCII_LOWER[data], starts, ends)
        same_doc = np.concatenate([[False], doc[1:] == doc[:-1]])
        again = same_doc & np.concatenate([[False], hashes[1:] == hashes[:-1]])
        before = np.concatenate([np.zeros(1, np.uint64), hashes[:-1]])
        pairs = A.mix64(before * np.uint64(3) + hashes)
        first = np.searchsorted(doc, np.arange(n))
        at_first = hashes[np.minimum(first, len(hashes) - 1)][doc] == hashes
        last_byte, first_byte = _GROUP_OF[data[ends - 1]], _GROUP_OF[data[starts]]
        second_byte = _GROUP_OF[data[np.minimum(starts + 1, ends - 1)]]
        letters = (list(_GROUPS).index("upper"), list(_GROUPS).index("lower"), _HIGH)
        plain = (list(_GROUPS).index("period"), list(_GROUPS).index("comma"))
        marked = ~np.isin(last_byte, letters + plain)
        upper = (first_byte == letters[0]) & (second_byte == letters[0])
        distinct = distinct_share(doc, hashes, n, some)
        distinct_pairs = distinct_share(doc[same_doc], pairs[same_doc], n, np.maximum(words - 1, 1))
    else:
        again = marked = upper = at_first = np.zeros(0)
        distinct = distinct_pairs = np.zeros(n)
    lines = groups[:, list(_GROUPS).index("newline")] + 1
    periods = groups[:, list(_GROUPS).index("period")] + 1
    return np.column_stack([
        groups / np.maximum(length, 1)[:, None], np.log1p(length), np.log1p(words), np.log(lines), mean_size, spread,
        distinct, mean(again.astype(float)), distinct_pairs, mean(marked.astype(float)), mean(upper.astype(float)),
        np.log1p(words / lines), np.log1p(words / periods),
        np.bincount(doc, weights=at_first.astype(float), minlength=n) / some])


def distinct_share(doc: np.ndarray, hashes: np.ndarray, n: int, of: np.ndarray) -> np.ndarray:
    # 40 bits of the hash under the document number: one sort for the slice
    key = np.sort(doc.astype(np.uint64) << np.uint64(40) | hashes >> np.uint64(24))
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    return np.bincount((key >> np.uint64(40)).astype(np.int64), weights=new, minlength=n) / of


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, stats (array of STATISTICS); null and empty texts get the
    statistics of an empty text. A row per input row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in A.slices(A.column(batch, "text")):
                stats = slice_statistics(data, offsets).astype(np.float32)
                values = pa.FixedSizeListArray.from_arrays(pa.array(stats.ravel()), stats.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [A.column(batch, "doc_id").slice(a, b - a), values.cast(pa.list_(pa.float32()))],
                    names=["doc_id", "stats"])

    base = id_text(docs, id_col, text_col)
    return base.mapInArrow(count, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, stats array<float>")


def matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    values = A.column(batch, name)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1).astype(float)


@dataclass
class Model:
    """A fitted classifier; ``score`` works on rows of statistics."""

    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # random projections, one column per feature
    phase: np.ndarray
    ridge: np.ndarray
    steps: np.ndarray  # ridge scores
    values: np.ndarray  # calibrated probabilities at the steps

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.center) / self.scale, -8, 8)
        z = np.cos(x @ self.weights + self.phase) * np.sqrt(2 / len(self.phase))
        return np.column_stack([np.ones(len(z)), z])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.ridge

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.steps):
            return np.clip(self.raw(stats), 0, 1)
        return np.clip(np.interp(self.raw(stats), self.steps, self.values), 0, 1)


def normal_equations(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y of rows (stats, label), summed over partitions."""
    d = len(model.phase) + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d + 1))
        seen = False
        for batch in batches:
            if batch.num_rows:
                seen = True
                z = model.features(matrix(batch, "stats"))
                y = A.column(batch, "label").to_numpy(zero_copy_only=False).astype(float)
                total += z.T @ np.column_stack([z, y])
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(range(d)), pa.array(list(total), pa.list_(pa.float64()))],
                                             names=["i", "part"])

    def add(table: pa.Table) -> pa.Table:
        parts = matrix(table.combine_chunks().to_batches()[0], "part")
        return pa.table({"i": [table["i"][0].as_py()], "part": pa.array([parts.sum(axis=0)], pa.list_(pa.float64()))})

    schema = "i long, part array<double>"
    sums = rows.select("stats", "label").mapInArrow(partial, schema).groupBy("i").applyInArrow(add, schema)
    total = np.zeros((d, d + 1))
    for r in sums.collect():  # one row per unknown
        total[r["i"]] = r["part"]
    return total[:, :d], total[:, d]


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``values`` (pool adjacent violators)."""
    blocks: list[list[float]] = []  # mean, weight, length
    for v, w in zip(values, weights, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.zeros(0)


def fit(rows: DataFrame, features: int = FEATURES, bandwidth: float = BANDWIDTH, ridge: float = RIDGE,
        bins: int = SCORE_BINS, seed: int = SEED) -> Model:
    """Fit on rows (stats, label 0/1, calibrate boolean): rows with
    ``calibrate`` only calibrate. Without rows, every score is 1/2."""
    d = len(STATISTICS)
    at = [F.col("stats")[i].cast("double") for i in range(d)]
    sums = rows.agg(F.count(F.lit(1)), *(F.avg(x) for x in at), *(F.stddev_pop(x) for x in at)).first()
    rng = np.random.default_rng(seed)
    weights = rng.normal(0, 1 / bandwidth, (d, features)) / np.sqrt(d / 8)
    model = Model(np.zeros(d), np.ones(d), weights, rng.uniform(0, 2 * np.pi, features),
                  np.concatenate([[0.5], np.zeros(features)]), np.zeros(0), np.zeros(0))
    if not sums[0]:
        return model
    model.center = np.array(sums[1:d + 1], float)
    model.scale = np.maximum(np.array(sums[d + 1:], float), 1e-6)
    ztz, zty = normal_equations(rows.where(~F.col("calibrate")), model)
    n = max(ztz[0, 0], 1.0)
    penalty = np.eye(len(ztz)) * ridge * n / features
    penalty[0, 0] = 1e-9
    model.ridge = np.linalg.solve(ztz + penalty, zty)

    def bin_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.raw(matrix(batch, "stats")), -1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(((raw + 1) / 3 * bins).astype(np.int64)), pa.array(raw),
                                              A.column(batch, "label")], names=["bin", "raw", "label"])

    scored = rows.where("calibrate").select("stats", F.col("label").cast("double")).mapInArrow(
        bin_scores, "bin long, raw double, label double")
    counted = scored.groupBy("bin").agg(F.avg("raw"), F.avg("label"), F.count(F.lit(1)))
    counted = sorted(tuple(r) for r in counted.collect())  # a row per bin
    if counted:
        _, steps, means, counts = (np.array(x, float) for x in zip(*counted, strict=True))
        # one pseudo-row at each end keeps the ends off 0 and 1 for little data
        model.steps = steps
        model.values = isotonic((means * counts + 0.5) / (counts + 1), counts + 1) if len(counted) < 5 else isotonic(
            means, counts)
    return model


def predict(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id, score."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [A.column(batch, "doc_id"), pa.array(model.score(matrix(batch, "stats")))],
                    names=["doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.select("doc_id", "stats").mapInArrow(score, f"doc_id {kind}, score double")


def fold(doc_id: Column, folds: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds))


def training_rows(stats: DataFrame, labels: DataFrame, label_id_col: str, label_col: str, folds: int,
                  held_out: int, calibration: int) -> DataFrame:
    """Labelled statistics that may be learned from: stats, label, calibrate."""
    own = labels.select(F.col(label_id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & (fold(F.col("doc_id"), folds) != held_out))
    return stats.join(own, "doc_id").select(
        "stats", F.col("label").cast("double"), (fold(F.col("doc_id"), folds) == calibration).alias("calibrate"))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_id_col: str = "doc_id", label_col: str = "quality", folds: int = 5,
                    held_out: int = 0, calibration: int = 1) -> DataFrame:
    """Return doc_id, held_out, score (0 to 1); a row per input row.

    Documents whose crc32(id) mod ``folds`` is ``held_out`` are never learned
    from; those with ``calibration`` calibrate; the others fit the ridge. Null
    labels and ids are not learned from; a document labelled more than once
    counts once per label. Null ids are never held out. All labelled rows are
    used; the model's size does not depend on them.
    """
    stats = materialize(document_statistics(docs, id_col, text_col))
    rows = materialize(training_rows(stats, labels, label_id_col, label_col, folds, held_out, calibration))
    scored = predict(stats, fit(rows))
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"),
                         "score")


def keep_good_documents(docs: DataFrame, labels: DataFrame, least: float, id_col: str = "doc_id",
                        text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "quality",
                        folds: int = 5, held_out: int = 0, calibration: int = 1) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score ``least`` or
    more. The rows are scored where they lie: no shuffle of the texts."""
    labelled = labels.select(F.col(label_id_col).alias("doc_id")).distinct()
    stats = document_statistics(docs, id_col, text_col).join(labelled, "doc_id", "left_semi")
    model = fit(materialize(training_rows(stats, labels, label_id_col, label_col, folds, held_out, calibration)))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in A.slices(A.column(batch, text_col).cast(pa.string())):
                good = model.score(slice_statistics(data, offsets).astype(np.float32).astype(float)) >= least
                yield batch.slice(a, b - a).filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
