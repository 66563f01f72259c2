"""Token ids of whole texts by the tokenizers library.

A text is cut in front of every blank or newline that follows a character
other than white space, between a letter and an ASCII mark other than the
apostrophe, and between a lone newline and a letter. The tokenizers in use
split there anyway (their patterns put letters, marks and white space in
different tokens, but for a blank before a word), so the ids of the parts, each
encoded by the library, joined are the ids of the text. Equal parts (by a
64-bit hash and the length) are encoded once per worker and looked up from then
on, in arrays: a part costs about 40 bytes, and the table is emptied at
``max_parts`` parts, which bounds a worker's memory.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

from pagesieve.llm import arrowtext as A

SLICE_BYTES = 1 << 20
MAX_PARTS = 600_000

#: the UTF-8 forms of white space outside ASCII, by number of bytes
_WIDE_SPACE = [chr(x).encode() for x in range(128, 0x3001) if chr(x).isspace()]
_WIDE_SPACE_2 = np.array([int.from_bytes(x) for x in _WIDE_SPACE if len(x) == 2], np.uint32)
_WIDE_SPACE_3 = np.array([int.from_bytes(x) for x in _WIDE_SPACE if len(x) == 3], np.uint32)
_NARROW_SPACE = np.array([x < 128 and chr(x).isspace() for x in range(256)])
_CUT = np.zeros(256, bool)
_CUT[[10, 32]] = True
_LETTER = np.array([x < 128 and chr(x).isalpha() for x in range(256)])
_MARK = np.array([33 <= x < 127 and not chr(x).isalnum() and x != 39 for x in range(256)])


def space_ends(data: np.ndarray) -> np.ndarray:
    """Whether each byte is the last of a white space character."""
    ends = _NARROW_SPACE[data]
    lead = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    lead = lead[lead + 2 < len(data) + (data[lead] == 0xC2)]
    if len(lead):
        two = lead[data[lead] == 0xC2]
        two = two[np.isin(data[two].astype(np.uint32) << 8 | data[two + 1], _WIDE_SPACE_2)]
        ends[two + 1] = True
        three = lead[data[lead] != 0xC2]
        code = data[three].astype(np.uint32) << 16 | data[three + 1].astype(np.uint32) << 8 | data[three + 2]
        ends[three[np.isin(code, _WIDE_SPACE_3)] + 2] = True
    return ends


def part_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the parts of a slice's texts begin."""
    begins = np.zeros(len(data), bool)
    begins[1:] = _CUT[data[1:]] & ~space_ends(data)[:-1]
    letter = _LETTER[data]
    after = letter.copy()  # the last byte of a letter: ASCII, or Latin-1 but for its two signs
    after[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    begins[1:] |= after[:-1] & _MARK[data[1:]]
    begins[1:] |= letter[1:] & (data[:-1] == 10) & begins[:-1]
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(begins)


class HashTable:
    """Open addressing from 64-bit keys to 0, 1, 2, ... in order of arrival."""

    def __init__(self, bits: int = 16):
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.full(1 << bits, -1, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for unknown ones."""
        mask = np.uint64(len(self.slots) - 1)
        at = (keys & mask).astype(np.int64)
        out = self.slots[at]
        if not len(self.keys):
            return out
        wrong = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & int(mask)
            out[wrong] = self.slots[at[wrong]]
            wrong = wrong[(out[wrong] >= 0) & (self.keys[out[wrong]] != keys[wrong])]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Add distinct keys that it does not hold."""
        first = len(self.keys)
        self.keys = np.concatenate([self.keys, keys])
        if len(self.keys) * 3 > len(self.slots):
            self.slots = np.full(1 << (4 * len(self.keys)).bit_length(), -1, np.int32)
            first = 0
        mask = len(self.slots) - 1
        left = np.arange(first, len(self.keys), dtype=np.int32)
        at = (self.keys[left] & np.uint64(mask)).astype(np.int64)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]  # of several at one slot the last wins
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & mask


class Encoder:
    def __init__(self, path: str, max_parts: int = MAX_PARTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.max_parts = max_parts
        self._clear()

    def _clear(self) -> None:
        self.table = HashTable()
        self.starts = np.zeros(1, np.int64)  # of each part's ids in the pool, and the end
        self.pool = np.zeros(1 << 16, np.uint32)

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.fromiter((i for x in found for i in x), np.uint32)
        end = int(self.starts[-1])
        if end + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[:end], np.zeros(len(self.pool) + len(ids), np.uint32)])
        self.pool[end:end + len(ids)] = ids
        self.starts = np.concatenate([self.starts, end + np.cumsum([len(x) for x in found])])
        self.table.add(keys)

    def encode_slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids (uint32) of a slice's texts, and where each text's begin."""
        starts = part_starts(data, offsets)
        n = len(offsets) - 1
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        keys = A.span_hashes(data, starts, np.append(starts[1:], len(data)))
        numbers = self.table.find(keys)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            if len(self.table.keys) + len(new) > self.max_parts:
                self._clear()
                new = np.arange(len(keys))
            fresh, at = np.unique(keys[new], return_index=True)
            at = new[at]
            ends = np.append(starts[1:], len(data))
            raw = data.tobytes()
            self._learn(fresh, [raw[starts[i]:ends[i]].decode() for i in at.tolist()])
            numbers = self.table.find(keys) if len(new) == len(keys) else numbers
            numbers[new] = self.table.find(keys[new])
        first, sizes = self.starts[numbers], self.starts[numbers + 1] - self.starts[numbers]
        bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        ids = self.pool[np.repeat(first - bounds[:-1], sizes) + np.arange(bounds[-1])]
        return ids, bounds[np.searchsorted(starts, offsets)]

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a string column (null: none), as uint32."""
        out: list[np.ndarray] = []
        for _, _, data, offsets in A.slices(column, SLICE_BYTES):
            ids, bounds = self.encode_slice(data, offsets)
            out.extend(ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
        return out


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder per tokenizer file and Python worker."""
    return Encoder(path)


def tokenizer_path(name: str) -> str:
    """Where the environment keeps the public tokenizer file ``name``."""
    import public_tokenizers

    return public_tokenizers.path(name)
