"""Fill-in-middle transformation by displacement scatter.

A text is cut in front of two of its lines into prefix, middle and suffix, which
are written in another order with a marker in front of each. All texts of an
Arrow slice are moved together:

1. *Cuts.* Newlines are found by a scan; line ``k`` of a text ends after its
   k-th newline, so the two cuts of every text are looked up by position.
2. *Displacements.* Each part moves as a whole. An array of differences holds, at
   the first byte of a part, by how much its shift differs from that of the byte
   before; the cumulative sum is every byte's shift.
3. *Scatter.* Bytes are written to their place plus their shift, the markers to
   the gaps between the parts.

``restore_text`` finds the markers in an output, derives the same displacements and
gathers the text back. No text that is transformed holds a marker, and a
marker's first character ends no other, so the three found are the three written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesieve.llm import arrowtext as A
from pagesieve.llm.tables import id_text, small_batches

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3  # bytes of a marker
SEED = 7
FIM_PERCENT = 100
SPM_PERCENT = 50
PLAIN, PSM, SPM = "plain", "psm", "spm"
PIECE = 1 << 20  # bytes moved together
SCHEMA = "doc_id {id}, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: object, seed: int = SEED) -> list[int]:
    """The four numbers that decide a document's cuts, whether it is
    transformed and its form. A null id is written as an empty string."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]


def marker_places(data: np.ndarray) -> np.ndarray:
    """Where a marker starts."""
    if len(data) < MARK:
        return np.zeros(0, np.int64)
    open_ = np.flatnonzero((data[:-2] == ord("<")) & (data[2:] == ord(">")))
    return open_[np.isin(data[open_ + 1], np.frombuffer(b"PSM", np.uint8))]


def spread_shifts(points: np.ndarray, shifts: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(low, high, shift of each byte in [low, high)) of ``size`` bytes, when
    from points[k] on the shift is shifts[k]; points ascend, of equal ones the
    last holds."""
    jumps = np.diff(shifts, prepend=0)
    carry = 0
    for low in range(0, size, PIECE):
        high = min(low + PIECE, size)
        a, b = np.searchsorted(points, [low, high])
        change = np.zeros(high - low, np.int64)
        np.add.at(change, points[a:b] - low, jumps[a:b])
        change[0] += carry
        shift = np.cumsum(change)
        carry = int(shift[-1])
        yield low, high, shift


def characters(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Code points in byte spans that begin and end between characters."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    return np.searchsorted(lead, ends) - np.searchsorted(lead, starts)


def cut_places(data: np.ndarray, offsets: np.ndarray, ids: list, seed: int,
               percents: tuple[int, int]) -> tuple[np.ndarray, ...]:
    """(lines, form codes, first cut, second cut) of the documents of a slice;
    forms are 0 plain, 1 psm, 2 spm, cuts are byte positions of the slice."""
    start, end = offsets[:-1], offsets[1:]
    newline = np.flatnonzero(data == ord("\n"))
    first = np.searchsorted(newline, start)
    count = np.searchsorted(newline, end) - first
    size = end - start
    closed = np.zeros(len(start), bool)
    some = np.flatnonzero(size)
    closed[some] = data[end[some] - 1] == ord("\n")
    lines = count + ((size > 0) & ~closed)
    marks = marker_places(data)
    inside = np.searchsorted(marks, np.maximum(end - MARK + 1, start)) > np.searchsorted(marks, start)
    drawn = np.array([draws(i, seed) for i in ids], np.int64).reshape(-1, 4)
    cuts = np.sort(drawn[:, :2] % (lines + 1)[:, None], axis=1)

    def place(units: np.ndarray) -> np.ndarray:
        """Byte position after so many lines."""
        at = end.copy()
        at[units == 0] = start[units == 0]
        after = np.flatnonzero((units > 0) & (units <= count))
        at[after] = newline[first[after] + units[after] - 1] + 1
        return at

    form = np.where(drawn[:, 3] % 100 < percents[1], 2, 1)
    form[(size == 0) | inside | (drawn[:, 2] % 100 >= percents[0])] = 0
    return lines, form, place(cuts[:, 0]), place(cuts[:, 1])


def scatter(data: np.ndarray, offsets: np.ndarray, form: np.ndarray, one: np.ndarray,
            two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the outputs."""
    start, end = offsets[:-1], offsets[1:]
    out_offsets = np.concatenate([[0], np.cumsum(np.diff(offsets) + np.where(form > 0, 3 * MARK, 0))])
    base = out_offsets[:-1]
    prefix, suffix = one - start, end - two
    # output places of the three parts; a plain text is one part
    at_prefix = base + np.where(form == 1, MARK, np.where(form == 2, 2 * MARK + suffix, 0))
    at_middle = np.where(form > 0, base + 3 * MARK + prefix + suffix, base + prefix)
    at_suffix = base + np.where(form == 1, 2 * MARK + prefix, np.where(form == 2, MARK, two - start))
    points = np.column_stack([start, one, two]).ravel()
    shifts = (np.column_stack([at_prefix, at_middle, at_suffix]) - np.column_stack([start, one, two])).ravel()
    out = np.empty(int(out_offsets[-1]), np.uint8)
    for low, high, shift in spread_shifts(points, shifts, len(data)):
        out[np.arange(low, high) + shift] = data[low:high]
    moved = np.flatnonzero(form)
    for marker, places in ((PREFIX, at_prefix), (SUFFIX, at_suffix), (MIDDLE, at_middle)):
        for k in range(MARK):
            out[places[moved] - MARK + k] = marker[k]
    return out, out_offsets


def gather(data: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts that gave the outputs ``data``."""
    start, end = offsets[:-1], offsets[1:]
    sizes = np.diff(offsets) - np.where(form > 0, 3 * MARK, 0)
    text_offsets = np.concatenate([[0], np.cumsum(sizes)])
    base = text_offsets[:-1]
    marks = marker_places(data)
    first = np.searchsorted(marks, start)
    moved = np.flatnonzero(form)
    if len(moved) and not np.array_equal(
            np.searchsorted(marks, np.maximum(end - MARK + 1, start))[moved] - first[moved], np.full(len(moved), 3)):
        raise ValueError("an output without its three markers")
    source = np.tile(start, (3, 1))  # where each part of the text stands in the output
    point = np.tile(base, (3, 1))  # where it belongs
    one, two, three = (marks[first[moved] + k] for k in range(3))
    psm = form[moved] == 1
    # the markers stand in the order P S M, or S P M
    prefix = np.where(psm, one, two) + MARK
    suffix = np.where(psm, two, one) + MARK
    prefix_size = np.where(psm, two, three) - prefix
    middle_size = end[moved] - three - MARK
    source[:, moved] = prefix, three + MARK, suffix
    point[1, moved] += prefix_size
    point[2, moved] += prefix_size + middle_size
    out = np.empty(int(text_offsets[-1]), np.uint8)
    for low, high, shift in spread_shifts(point.T.ravel(), (source - point).T.ravel(), len(out)):
        out[low:high] = data[np.arange(low, high) + shift]
    return out, text_offsets


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)]).cast(pa.string())


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
                   fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """Return doc_id, n (lines), form (plain, psm or spm), prefix_chars,
    middle_chars (code points; null if plain), output; a row per input row.

    Lines are ``[^\\n]*\\n|[^\\n]+``. The cuts, and whether and how a document
    is transformed, follow from the seed and the id alone. Null and empty texts
    and those that hold a marker are plain. Rows with a null id draw as one with
    an empty id; rows that repeat an id draw alike.
    """
    small_batches(docs.sparkSession)
    base = id_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in A.slices(A.column(batch, "text")):
                ids = A.column(batch, "doc_id").slice(low, high - low)
                lines, form, one, two = cut_places(data, offsets, ids.to_pylist(), seed, (fim_percent, spm_percent))
                out, out_offsets = scatter(data, offsets, form, one, two)
                plain = form == 0
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(lines, pa.int64()), pa.array([PLAIN, PSM, SPM]).take(pa.array(form)),
                     pa.array(characters(data, offsets[:-1], one), pa.int64(), mask=plain),
                     pa.array(characters(data, one, two), pa.int64(), mask=plain), strings(out, out_offsets)],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return base.mapInArrow(run, SCHEMA.format(id=base.schema["doc_id"].dataType.simpleString()))


def restore_text(outputs: DataFrame) -> DataFrame:
    """``outputs`` with a column ``restored``: the exact text, from ``output``
    and ``form`` alone. A null output gives an empty text; a transformed output
    without its three markers is an error."""
    names = outputs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in A.slices(A.column(batch, "output")):
                part = batch.slice(low, high - low)
                kinds = A.column(part, "form").to_pylist()
                form = np.array([(PLAIN, PSM, SPM).index(k) for k in kinds])
                restored = strings(*gather(data, offsets, form))
                yield pa.RecordBatch.from_arrays([*part.columns, restored], names=[*names, "restored"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema.fields)
    return outputs.mapInArrow(run, f"{fields}, restored string")
