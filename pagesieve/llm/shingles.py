"""Word shingles of whole texts as sorted distinct 64-bit hashes."""

from __future__ import annotations

import numpy as np

from pagesieve.llm import arrowtext as A

SIZE = 5
_PLACES = [np.uint64(pow(0xC2B2AE3D27D4EB4F, k, 1 << 64)) for k in range(64)]


def slice_shingles(data: np.ndarray, offsets: np.ndarray, size: int = SIZE) -> list[np.ndarray]:
    """The shingle set of each document of a slice: words are maximal runs of
    non-blank bytes with A-Z lower-cased; a document of fewer than ``size``
    words, but not none, has its whole word sequence as its one shingle."""
    data = A.ASCII_LOWER[data]
    doc, starts, ends = A.word_spans(data, offsets, A.ASCII_SPACE)
    n = len(offsets) - 1
    if len(doc) == 0:
        return [np.zeros(0, np.uint64)] * n
    words = A.span_hashes(data, starts, ends)
    first = np.searchsorted(doc, np.arange(n + 1))
    count = np.diff(first)
    total = np.zeros(len(words), np.uint64)
    for k in range(size):
        # past the end of a document nothing is added
        shifted = np.zeros(len(words), np.uint64)
        if k < len(words):
            same = doc[k:] == doc[:len(doc) - k]
            shifted[:len(words) - k] = np.where(same, words[k:] * _PLACES[k], 0)
        total += shifted
    hashes = A.mix64(total + np.minimum(count, size).astype(np.uint64)[doc])
    out = []
    for d in range(n):
        a, c = int(first[d]), int(count[d])
        own = np.sort(hashes[a:a + (c - size + 1 if c >= size else min(c, 1))])
        if len(own) > 1:
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        out.append(own)
    return out


def text_shingles(texts: list[str | None], size: int = SIZE) -> list[np.ndarray]:
    import pyarrow as pa

    out: list[np.ndarray] = []
    for _, _, data, offsets in A.slices(pa.array(texts, pa.string())):
        out.extend(slice_shingles(data, offsets, size))
    return out


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two shingle sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def similar(a: np.ndarray, b: np.ndarray, parts: int = 75, whole: int = 100) -> bool:
    """whole * |intersection| >= parts * |union|, in integers."""
    if not len(a) or not len(b):
        return False
    both = overlap(a, b)
    return whole * both >= parts * (len(a) + len(b) - both)
