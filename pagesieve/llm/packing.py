"""Pattern packing by non-negative least squares.

Documents become token ids plus an end id; those longer than a sequence are cut
into pieces. Only the histogram of piece lengths (at most ``limit`` numbers,
however many documents) comes to the driver, where the plan is made:

1. Lengths are grouped into ``bins`` bins. All patterns of up to ``depth``
   pieces that fill a sequence exactly in bins are enumerated, and non-negative
   least squares fits their repeat counts to the histogram.
2. The counts are rounded and taken as far as pieces are left.
3. What remains is packed best-fit, longest first, into the room left in
   sequences or into new ones; equal sequences are handled together, so the
   work depends on the distinct lengths only.

The plan says for each length which ranks (the k-th piece of that length) go to
which sequence and place. Pieces get their rank by a window over (length, hash
bucket) plus the counts of the buckets before it, so no length, however
frequent, lands in one task, and look their place up in the plan: its rows are
bounded by the limit (lengths), not by the data.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagesieve.llm import arrowtext as A
from pagesieve.llm import bpe
from pagesieve.llm.tables import id_text, materialize

LIMIT = 4096
END_ID = 1
BINS = 128
DEPTH = 3
ROWS_PER_BUCKET = 50_000
ROWS_PER_STEP = 512


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000, tol: float = 1e-9) -> np.ndarray:
    """argmin |a x - b| with x >= 0 by active sets (Lawson and Hanson)."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, bool)
    ata, atb = a.T @ a, a.T @ b
    for _ in range(rounds):
        slope = atb - ata @ x
        slope[free] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= tol * max(1.0, float(np.abs(atb).max())):
            break
        free[best] = True
        while True:
            on = np.flatnonzero(free)
            z = np.linalg.lstsq(ata[np.ix_(on, on)], atb[on], rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[on] = z
                break
            bad = z <= 0
            old = x[on]
            step = np.min(old[bad] / np.maximum(old[bad] - z[bad], 1e-300))
            x[on] = old + step * (z - old)
            free[on[x[on] <= 1e-12 * max(1.0, x.max())]] = False
            x[~free] = 0
            if not free.any():
                break
    return x


def patterns(bins: int, depth: int) -> list[tuple[int, ...]]:
    """Non-increasing tuples of up to ``depth`` bin numbers that sum to ``bins``."""
    out = []

    def extend(left: int, most: int, chosen: tuple[int, ...]) -> None:
        if left == 0:
            out.append(chosen)
        elif len(chosen) < depth:
            for k in range(min(left, most), 0, -1):
                if k * (depth - len(chosen)) < left:
                    break
                extend(left - k, k, (*chosen, k))

    extend(bins, bins, ())
    return out


def fit_patterns(by_bin: np.ndarray, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with rounded repeat counts, most repeated first."""
    bins = len(by_bin) - 1
    all_patterns = patterns(bins, depth)
    a = np.zeros((bins, len(all_patterns)))
    for k, pattern in enumerate(all_patterns):
        for b in pattern:
            a[b - 1, k] += 1
    scale = max(1.0, float(by_bin.max()))
    x = nnls(a, by_bin[1:] / scale) * scale
    rounded = np.rint(x).astype(np.int64)
    return [(all_patterns[k], int(rounded[k])) for k in np.argsort(-rounded, kind="stable") if rounded[k] > 0]


def plan_packing(histogram: dict[int, int], limit: int = LIMIT, bins: int = BINS,
                 depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, number of such sequences) covering the
    histogram of lengths in 1..limit exactly."""
    left = np.zeros(limit + 1, np.int64)
    for length, count in histogram.items():
        left[length] = count
    bins = min(bins, limit)
    width = -(-limit // bins)
    bin_of = -(-np.arange(limit + 1) // width)
    by_bin = np.bincount(bin_of, weights=left, minlength=bins + 1)
    by_bin[0] = 0
    longest = {b: b * width if b < bins else limit for b in range(1, bins + 1)}

    def take(b: int, most: int) -> tuple[int, int]:
        """A length of bin ``b`` with pieces left, the longest, and how many."""
        low = (b - 1) * width
        part = np.flatnonzero(left[low + 1:min(longest[b], limit) + 1])
        if not len(part):
            return 0, 0
        length = low + 1 + int(part[-1])
        return length, min(most, int(left[length]))

    open_groups: dict[int, list[list]] = defaultdict(list)  # by room left: [lengths, count]

    def put(lengths: tuple[int, ...], count: int) -> None:
        if count:
            open_groups[limit - sum(lengths)].append([lengths, count])

    for pattern, times in fit_patterns(by_bin, depth):
        need = defaultdict(int)
        while times > 0:
            chosen, most = [], times
            need.clear()
            for b in pattern:
                length, _ = take(b, most)
                # pieces of one length used twice in a pattern need twice as many
                if length and left[length] <= need[length]:
                    length = 0
                chosen.append(length)
                need[length] += 1
            if 0 in chosen:
                break
            count = min(most, *(int(left[x]) // k for x, k in need.items()))
            if count == 0:
                break
            for x, k in need.items():
                left[x] -= count * k
            put(tuple(chosen), count)
            times -= count

    for length in range(limit, 0, -1):
        while left[length]:
            count = int(left[length])
            room = min((r for r, groups in open_groups.items() if r >= length and groups), default=None)
            if room is None:
                each = min(limit // length, count)
                put((length,) * each, count // each)
                left[length] -= count // each * each
                continue
            lengths, have = open_groups[room].pop()
            used = min(have, count)
            if used < have:
                open_groups[room].append([lengths, have - used])
            put((*lengths, length), used)
            left[length] -= used
    return [(lengths, count) for groups in open_groups.values() for lengths, count in groups]


def place_table(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Ranks to places: row k holds ranks from ``rank[k]`` on of pieces of
    ``length[k]``; they go to sequences from ``sequence[k]`` on, at
    ``offset[k]``. Sorted by length and rank."""
    rows, used, base = [], defaultdict(int), 0
    for lengths, count in plan:
        offset = 0
        for length in lengths:
            rows.append((length, used[length], base, offset))
            used[length] += count
            offset += length
        base += count
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {k: table[:, i] for i, k in enumerate(("length", "rank", "sequence", "offset"))}


def token_pieces(docs: DataFrame, tokenizer: str, limit: int = LIMIT, end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Cut every document (ids and the end id; null texts: the end id alone)
    into pieces of ``limit`` ids; only the last may be shorter. Returns
    doc_id, piece, start, length, ids_crc32 and with_ids the ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS_PER_STEP):
                part = batch.slice(low, ROWS_PER_STEP)
                encoded = encoder.encode(A.column(part, "text"))
                rows, numbers, crcs, lengths, ids = [], [], [], [], []
                for row, own in enumerate(encoded):
                    own = own.astype("<u4").tobytes() + end
                    for piece, at in enumerate(range(0, len(own), 4 * limit)):
                        body = own[at:at + 4 * limit]
                        rows.append(row)
                        numbers.append(piece)
                        lengths.append(len(body) // 4)
                        crcs.append(zlib.crc32(body))
                        if with_ids:
                            ids.append(np.frombuffer(body, "<u4").astype(np.int32))
                number = np.array(numbers, np.int32)
                columns = {"doc_id": A.column(part, "doc_id").take(pa.array(rows, pa.int64())),
                           "piece": pa.array(number), "start": pa.array(number.astype(np.int64) * limit),
                           "length": pa.array(lengths, pa.int64()), "ids_crc32": pa.array(crcs, pa.int64())}
                if with_ids:
                    columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    base = id_text(docs, id_col, text_col)
    kind = base.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return base.mapInArrow(cut, schema)


def pack_pieces(pieces: DataFrame, limit: int = LIMIT, bins: int = BINS, depth: int = DEPTH,
                rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Give every piece (doc_id, piece, start, length, ids_crc32, ...) its
    sequence_id and offset. Sequences are gapless from 0 and hold at most
    ``limit`` ids; pieces are never cut, dropped or reordered inside."""
    pieces = materialize(pieces)
    total = pieces.count()
    if total == 0:
        return pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    buckets = total // rows_per_bucket + 1
    keyed = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    counts = keyed.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("_n")).collect()}  # limit rows at most
    table = place_table(plan_packing(histogram, limit, bins, depth))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = keyed.withColumn("_row", F.row_number().over(inside) - 1).join(first, ["length", "_bucket"])
    names = pieces.columns
    ranked = ranked.select(*names, (F.col("_first") + F.col("_row")).alias("_rank"))
    keys = table["length"] << 40 | table["rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = A.column(batch, "_rank").to_numpy(zero_copy_only=False)
            length = A.column(batch, "length").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length << 40 | rank, side="right") - 1
            sequence = table["sequence"][at] + rank - table["rank"][at]
            yield pa.RecordBatch.from_arrays(
                [A.column(batch, n) for n in names] + [pa.array(sequence), pa.array(table["offset"][at])],
                names=[*names, "sequence_id", "offset"])

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, schema)


def packed_sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, from packed pieces
    that carry their ids. A sequence holds at most ``limit`` ids."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_parts"))
    return parts.select("sequence_id", F.flatten("_parts.ids").alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str, limit: int = LIMIT, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``token_pieces`` and ``pack_pieces``: a row per piece with doc_id, piece,
    start, length, ids_crc32, sequence_id, offset (and ids)."""
    return pack_pieces(token_pieces(docs, tokenizer, limit, end_id, id_col, text_col, with_ids), limit)
