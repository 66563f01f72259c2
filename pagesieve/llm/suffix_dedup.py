"""Exact substring dedup by column-wise construction over many documents.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier (in
a document of smaller id, or earlier in the same one) is removed. All strings
are judged on the input.

The column-wise construction inserts one symbol per document each round and
keeps the sorted order of all suffixes (the collection's Burrows-Wheeler order)
and their common prefixes up to date. It is run on the parts of the corpus where
repeats can be, aligned so that equal strings start in the same column:

1. *Anchors.* Each string of LENGTH bytes is represented by the smallest hash
   among its ``GRAM``-byte grams (the leftmost one). Neighbouring strings with
   the same anchor form a stretch: its context, the bytes its strings cover, is
   at most 2 * LENGTH - GRAM long. Equal strings have equal anchors at equal
   places, so only stretches with equal anchors need comparing.
2. *Equal contexts.* Of stretches with equal anchor and context (128 bits of
   hash) all but the first are covered altogether: copied text ends here. Firsts and
   contexts of an anchor are found by aggregates that combine before the shuffle, and
   joins that adaptive execution splits, so an anchor in very many documents gathers
   nowhere. Anchors with one context have no other repeats.
3. *Columns.* What is left are first contexts of anchors that have several, such
   as those around an edit or the border of a shared passage. They are aligned
   at the anchor; from the last column to the first, one symbol per context is
   inserted, which sorts the suffixes by a stable partition of the order so far,
   and common prefixes follow from range minima. Where a common prefix reaches
   LENGTH, the strings are equal and the earliest one stays. The symbols are read
   from a sequential file, column after column, once backwards; besides them,
   memory holds the group's contexts, the order and the common prefixes.
4. *Spans* of all repeats are merged per document and cut out.

Anchors whose contexts are too many for one group (``HOT_GROUP``) are resolved
string by string with an aggregate that combines before the shuffle.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesieve.llm import arrowtext as A
from pagesieve.llm.tables import id_text, materialize

LENGTH = 100
GRAM = 32
HOT_GROUP = 50_000
GROUP_ROWS = 20_000
_PLACE_BITS = 24
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)
PIECE = 1 << 22  # positions looked at together


def sliding(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    size, out = 1, values
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[:len(out) - (width - size)], out[width - size:]) if size < width else out


def stretches(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH,
              gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Stretches of a slice: document index, anchor hash, context hash, first
    string's start in the document, number of strings, anchor's distance from
    the first start."""
    width = length - gram + 1
    empty = tuple(np.zeros(0, k) for k in (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int64))
    if len(data) < length:
        return empty
    up, down = A.POWERS.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(A.BYTE_CODE[data] * up[:-1], out=total[1:])
    grams = A.mix64((total[gram:] - total[:-gram]) * down[:len(data) - gram + 1])
    found = []
    for low in range(0, len(data) - length + 1, PIECE):
        high = min(low + PIECE, len(data) - length + 1)  # strings starting in [low, high)
        own = grams[low:high + width - 1]
        keyed = (own & ~_PLACE) | np.arange(len(own), dtype=np.uint64)  # equal hashes: the leftmost
        found.append((sliding(keyed, width) & _PLACE).astype(np.int64) + low)
    anchor = np.concatenate(found)
    start = np.arange(len(anchor))
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(anchor)]
    inside = np.flatnonzero(start + length <= offsets[doc + 1])
    if not len(inside):
        return empty
    anchor, doc = anchor[inside], doc[inside]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]))
    first, anchor, doc = inside[new], anchor[new], doc[new]
    count = np.diff(np.append(new, len(inside)))
    ends = first + count - 1 + length
    left = anchor - first
    context = A.mix64((total[ends] - total[first]) * down[first] + (left * 256 + count).astype(np.uint64))
    return doc, grams[anchor], context, first - offsets[doc], count, left


def pack_place(first: np.ndarray, count: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Start, number of strings and anchor distance (both below 2 * LENGTH) in
    one number that sorts by start."""
    return first << 16 | count << 8 | left


def all_stretches(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in A.slices(A.column(batch, "text")):
                doc, anchor, context, first, count, left = stretches(data, offsets, length, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)),
                     A.column(batch, "doc_id").slice(low, high - low).take(pa.array(doc)),
                     pa.array(pack_place(first, count, left))], names=["anchor", "context", "doc_id", "place"])

    return docs.mapInArrow(run, "anchor long, context long, doc_id long, place long")


def equal_strings(symbols: np.ndarray, begin: np.ndarray, end: np.ndarray, group: np.ndarray, rank: np.ndarray,
                  length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of every string of ``length`` symbols that equals one of a
    row of the same group and smaller ``rank`` in the same column.

    ``symbols`` is (rows, columns); row i has symbols in columns
    [begin[i], end[i]). Rows are sorted by ``group``. The rows' suffixes are
    sorted column by column from the last one on."""
    rows, columns = symbols.shape
    order = np.arange(rows)
    common = np.zeros(rows + 1, np.int16)  # common prefix of each suffix with the one before it
    _, group = np.unique(group, return_inverse=True)
    group = group.astype(np.uint16) if group.max(initial=0) < 1 << 16 else group
    found_rows, found_columns = [], []
    with tempfile.TemporaryFile() as file:
        file.write(np.ascontiguousarray(symbols.T).data)
        for column in range(columns - 1, -1, -1):
            file.seek(column * rows)
            inside = (begin[order] <= column) & (column < end[order])
            # rows without a symbol here sort behind all others
            inserted = np.where(inside, np.frombuffer(file.read(rows), np.uint8)[order], np.uint16(256))
            by_symbol = np.argsort(inserted, kind="stable")
            move = by_symbol[np.argsort(group[order[by_symbol]], kind="stable")]
            new_order = order[move]
            symbol, own = inserted[move], group[new_order]
            same = np.flatnonzero((symbol[1:] == symbol[:-1]) & (own[1:] == own[:-1]) & (symbol[1:] < 256)) + 1
            new_common = np.zeros(rows + 1, np.int16)
            if len(same):
                borders = np.column_stack([move[same - 1] + 1, move[same] + 1]).ravel()
                new_common[same] = np.minimum(np.minimum.reduceat(common, borders)[::2] + 1, length)
            order, common = new_order, new_common
            equal = np.flatnonzero(common >= length)
            if len(equal):
                run = np.cumsum(common[:rows] < length) - 1
                ranks = rank[order]
                starts = np.flatnonzero(common[:rows] < length)
                least = np.minimum.reduceat(ranks, starts)
                member = np.zeros(rows, bool)
                member[equal] = member[equal - 1] = True
                later = np.flatnonzero(member & (ranks > least[run]))
                found_rows.append(order[later])
                found_columns.append(np.full(len(later), column))
    if not found_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_rows), np.concatenate(found_columns)


def aligned(contexts: list[bytes], left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts as rows of a matrix with their anchors in one column."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    begin = int(left.max()) - left
    end = begin + sizes
    width = int(end.max())
    matrix = np.zeros(len(contexts) * width, np.uint8)
    at = np.repeat(np.arange(len(contexts)) * width + begin - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    matrix[at + np.arange(int(sizes.sum()))] = np.frombuffer(b"".join(contexts), np.uint8)
    return matrix.reshape(len(contexts), width), begin, end


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans as maximal spans in order."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]]) if len(starts) else np.zeros(0, bool)
    last = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1) if len(starts) else np.zeros(0, np.int64)
    return starts[new], reach[last]


def context_rows(docs: DataFrame, open_rows: DataFrame, length: int) -> DataFrame:
    """(anchor, doc_id, place, bytes) of the stretches to be compared."""
    places = open_rows.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "place")).alias("places"))
    joined = docs.join(places, "doc_id").select("doc_id", "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                out = {k: [] for k in ("anchor", "doc_id", "place", "bytes")}
                for row in batch.slice(low, 256).to_pylist():
                    raw = row["text"].encode()
                    for p in row["places"]:
                        first, count = p["place"] >> 16, p["place"] >> 8 & 255
                        out["anchor"].append(p["anchor"])
                        out["doc_id"].append(row["doc_id"])
                        out["place"].append(p["place"])
                        out["bytes"].append(raw[first:first + count - 1 + length])
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(out[k], pa.int64()) for k in ("anchor", "doc_id", "place")),
                     pa.array(out["bytes"], pa.binary())], names=list(out))

    return joined.mapInArrow(run, "anchor long, doc_id long, place long, bytes binary")


def compare_columns(rows: DataFrame, length: int, group_rows: int) -> DataFrame:
    """Spans (doc_id, start, end) of the repeated strings among context rows."""
    dealt = rows.repartition("anchor").sortWithinPartitions("anchor")

    def spans(table: pa.Table) -> pa.RecordBatch:
        anchor, doc, place = (table[k].to_numpy() for k in ("anchor", "doc_id", "place"))
        symbols, begin, end = aligned(table["bytes"].to_pylist(), place & 255)
        origin = (place >> 16) - begin  # where column 0 is in the document
        # rows of a repeated document are at one place: equal ranks
        _, rank = np.unique(np.stack([doc, origin]), axis=1, return_inverse=True)
        row, column = equal_strings(symbols, begin, end, anchor, rank, length)
        order = np.lexsort((column, row))
        row, start = row[order], origin[row[order]] + column[order]
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)]) if len(row) else \
            np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.append(first[1:] - 1, len(row) - 1) if len(row) else first
        return pa.RecordBatch.from_arrays([pa.array(doc[row[first]]), pa.array(start[first]),
                                           pa.array(start[last] + length)], names=["doc_id", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for low in range(0, batch.num_rows, group_rows):
                held.append(batch.slice(low, group_rows))
                size += held[-1].num_rows
                if size < group_rows:
                    continue
                table = pa.Table.from_batches(held)
                # the last anchor may go on
                cut = int(np.searchsorted(table["anchor"].to_numpy(), table["anchor"][-1].as_py()))
                if cut:
                    yield spans(table.slice(0, cut))
                held, size = table.slice(cut).to_batches(), table.num_rows - cut
        if size:
            yield spans(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "doc_id long, start long, end long")


def compare_strings(rows: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many contexts: a row per string, the
    earliest of equal strings by an aggregate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                place = A.column(part, "place").to_numpy()
                raw = A.column(part, "bytes").to_pylist()
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
                count = place >> 8 & 255
                row = np.repeat(np.arange(len(raw)), count)
                shift = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                at = bounds[row] + shift
                data = np.frombuffer(b"".join(raw), np.uint8)
                # 128 bits: the string's hash, and with other bytes' codes (by a fixed permutation) again
                a = A.span_hashes(data, at, at + length)
                b = A.span_hashes(data ^ np.uint8(0x5A), at, at + length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                     A.column(part, "doc_id").take(pa.array(row)), pa.array((place >> 16)[row] + shift)],
                    names=["a", "b", "doc_id", "start"])

    strings = rows.mapInArrow(run, "a long, b long, doc_id long, start long")
    strings = materialize(strings)
    first = strings.groupBy("a", "b").agg(F.min(F.struct("doc_id", "start")).alias("first"),
                                          F.count(F.lit(1)).alias("n")).where("n > 1").select("a", "b", "first")
    return strings.join(first, ["a", "b"]).where(F.struct("doc_id", "start") != F.col("first")).select(
        "doc_id", "start", (F.col("start") + length).alias("end"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS,
                   hot_group: int = HOT_GROUP) -> DataFrame:
    """(doc_id, start, end): byte spans of documents (doc_id, text) whose strings
    of ``length`` bytes start earlier too. Spans may overlap."""
    found = all_stretches(docs, length, gram)
    # written: a join with an aggregate on its own keys would not be split
    shared = materialize(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"))
    seen = materialize(found.join(shared, "anchor", "left_semi"))
    firsts = materialize(seen.groupBy("anchor", "context").agg(
        F.min(F.struct("doc_id", "place")).alias("first"), F.count(F.lit(1)).alias("n")))
    several = materialize(firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"))
    start = F.shiftright("place", 16)
    # a row that repeats the first one's document is at its place, no copy
    copies = seen.join(firsts.where("n > 1").drop("n"), ["anchor", "context"]).where(
        F.struct("doc_id", "place") != F.col("first")).select(
        "doc_id", start.alias("start"),
        (start + F.shiftright("place", 8).bitwiseAND(F.lit(255)) - 1 + length).alias("end"))
    rest = firsts.join(several, "anchor", "left_semi").select("anchor", "first.doc_id", "first.place")
    hot = rest.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_group).select("anchor")
    hot = materialize(hot)
    contexts = context_rows(docs, rest, length)
    if hot.isEmpty():
        return copies.unionByName(compare_columns(contexts, length, group_rows))
    contexts = materialize(contexts)
    return copies.unionByName(compare_columns(contexts.join(hot, "anchor", "left_anti"), length, group_rows)).unionByName(
        compare_strings(contexts.join(hot, "anchor", "left_semi"), length))


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                     gram: int = GRAM, group_rows: int = GROUP_ROWS, hot_group: int = HOT_GROUP) -> DataFrame:
    """Return doc_id, n_bytes, spans (maximal removed byte runs), n_removed,
    kept (the remaining bytes; a cut may fall inside a character); a row per
    input row.

    Null and empty texts, and those shorter than ``length`` bytes, stay as they
    are. Rows with a null id stay whole and count for no other row. Rows that
    repeat an id and its text are at one place: none is earlier than the
    other. Ids must be integers and belong to one text.
    """
    if not gram <= length < 128:
        raise ValueError("strings of 127 bytes at most, and not shorter than a gram")
    base = id_text(docs, id_col, text_col).select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    spans = repeated_spans(base.where("doc_id is not null"), length, gram, group_rows, hot_group)
    # bounded by the length of one document
    per_doc = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = base.join(per_doc, "doc_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in A.slices(A.column(batch, "text")):
                part = A.column(batch, "spans").slice(low, high - low)
                raw = data.tobytes()
                out = {k: [] for k in ("n_bytes", "spans", "n_removed", "kept")}
                for k in range(high - low):
                    own = raw[offsets[k]:offsets[k + 1]]
                    pairs = part[k].values if part[k].is_valid else None
                    if pairs is None or not len(pairs):
                        starts = ends = np.zeros(0, np.int64)
                    else:
                        starts, ends = merge_spans(pairs.field("start").to_numpy(), pairs.field("end").to_numpy())
                    kept, at = [], 0
                    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                        kept.append(own[at:a])
                        at = b
                    kept.append(own[at:])
                    out["n_bytes"].append(len(own))
                    out["spans"].append([{"start": a, "end": b} for a, b in zip(starts.tolist(), ends.tolist(),
                                                                              strict=True)])
                    out["n_removed"].append(int((ends - starts).sum()))
                    out["kept"].append(b"".join(kept))
                yield pa.RecordBatch.from_arrays(
                    [A.column(batch, "doc_id").slice(low, high - low), pa.array(out["n_bytes"], pa.int64()),
                     pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     pa.array(out["n_removed"], pa.int64()), pa.array(out["kept"], pa.binary())],
                    names=["doc_id", "n_bytes", "spans", "n_removed", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, "
                                  "n_removed long, kept binary")
