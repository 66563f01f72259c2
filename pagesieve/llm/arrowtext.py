"""Text columns of Arrow batches as byte arrays, and hashes of words in them.

Every helper works on one slice of a batch at a time (SLICE_BYTES of text, or one
text), so a task's memory does not grow with its partition. A null text counts as empty.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18

ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
_MULT = 0x9E3779B97F4A7C15
_ODD = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Bit mixer on uint64 arrays: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(_ODD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(_MULT)
    return x ^ (x >> np.uint64(32))


BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT))


class Powers:
    """Powers of an odd base modulo 2**64 and their inverses, grown on demand."""

    def __init__(self, base: int = 0xA0761D6478BD642F):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def _grow(self, table: np.ndarray, base: int, n: int) -> np.ndarray:
        while len(table) < n:
            step = np.uint64(pow(base, len(table), 1 << 64))
            table = np.concatenate([table, table * step])
        return table

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        self.up = self._grow(self.up, self.base, n)
        self.down = self._grow(self.down, self.inverse, n)
        return self.up[:n], self.down[:n]


POWERS = Powers()


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end) of ``data``."""
    up, down = POWERS.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * up[:-1], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def release_memory() -> None:
    """Give freed memory back to the system: workers live on between tasks and
    stages, and what their allocators keep is missing elsewhere."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive row ranges of a
    string column, each of about ``max_bytes`` (one row at least)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind, count=len(column) + 1,
                            offset=column.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + max_bytes, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end
    release_memory()


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document index, start, end) of the maximal runs of non-separator
    bytes; a run never crosses a document border."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~separator[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    borders = offsets[1:-1]
    before[borders[borders < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    last = borders[(borders > 0) & (borders <= len(data))] - 1
    after[last] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return np.searchsorted(offsets, starts, side="right") - 1, starts, ends


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
