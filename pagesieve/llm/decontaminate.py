"""Benchmark decontamination with a generalised suffix automaton of the items.

The automaton of all test items (sequences of words) is built once per block
of items; training texts stream through it word by word. At each word it holds
the longest match ending there; when that match is at least a window long, the
window's words are hit, and the state's suffix ancestor of window length names
the items that hold the window.

Items are taken in blocks of at most ``block_words`` words, so one automaton is
bounded however many items there are. The blocks are files in the shared
folder; a task holds one at a time and scans about ``GROUP_BYTES`` of text with
each. Most words of a text occur in no item: those reset the match, so only
runs of item words that are long enough for a window walk the automaton (found
with vector operations on word hashes).
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesieve.llm import arrowtext as A
from pagesieve.llm.records import file_system
from pagesieve.llm.tables import id_text, scratch_path

WINDOW = 13
BLOCK_WORDS = 1 << 18
GROUP_BYTES = 8 << 20

NOT_WORD = np.zeros(256, bool)
NOT_WORD[:0x80] = True
NOT_WORD[0x30:0x3A] = False
NOT_WORD[0x61:0x7B] = False


class SuffixAutomaton:
    """Generalised suffix automaton over integer words.

    ``link`` is the suffix link, ``size`` the longest string of the state,
    ``step`` its transitions. ``windows`` maps a state to the items holding
    the window that is its string of window length."""

    def __init__(self, items: list[tuple[int, list[int]]], window: int = WINDOW):
        self.window = window
        self.step, self.link, self.size = [{}], [-1], [0]
        for _, words in items:
            state = 0
            for word in words:
                state = self._extend(state, word)
        # the items whose windows end in each state; complete items shorter
        # than a window count as one window of their own length
        self.windows: dict[int, set[int]] = {}
        self.whole: dict[int, dict[int, set[int]]] = {}
        for item, words in items:
            state = 0
            for at, word in enumerate(words):
                state = self.step[state][word]
                if at + 1 >= window:
                    self.windows.setdefault(self.window_state(state), set()).add(item)
            if 0 < len(words) < window:
                self.whole.setdefault(state, {}).setdefault(len(words), set()).add(item)
        self.short = sorted({n for at in self.whole.values() for n in at})
        self._ends()

    def _extend(self, last: int, word: int) -> int:
        step, link, size = self.step, self.link, self.size
        if word in step[last]:
            target = step[last][word]
            if size[target] == size[last] + 1:
                return target
            return self._clone(last, word, target)
        new = len(step)
        step.append({})
        link.append(0)
        size.append(size[last] + 1)
        state = last
        while state != -1 and word not in step[state]:
            step[state][word] = new
            state = link[state]
        if state != -1:
            target = step[state][word]
            link[new] = target if size[target] == size[state] + 1 else self._clone(state, word, target)
        return new

    def _clone(self, state: int, word: int, target: int) -> int:
        step, link, size = self.step, self.link, self.size
        copy = len(step)
        step.append(dict(step[target]))
        link.append(link[target])
        size.append(size[state] + 1)
        link[target] = copy
        while state != -1 and step[state].get(word) == target:
            step[state][word] = copy
            state = link[state]
        return copy

    def window_state(self, state: int) -> int:
        while self.size[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _ends(self) -> None:
        """For each state: the short items that are suffixes of its string."""
        self.suffixes: list[tuple[tuple[int, frozenset[int]], ...]] = [()] * len(self.step)
        for state in sorted(range(1, len(self.step)), key=self.size.__getitem__):
            own = tuple((n, frozenset(found)) for n, found in sorted(self.whole.get(state, {}).items()))
            self.suffixes[state] = self.suffixes[self.link[state]] + own

    def scan(self, words: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit spans [start, end) of word positions, and the items found."""
        state, length, spans, found = 0, 0, [], set()
        step, link, size, window = self.step, self.link, self.size, self.window
        for at, word in enumerate(words, 1):
            while state and word not in step[state]:
                state = link[state]
                length = size[state]
            if word not in step[state]:
                continue
            state, length = step[state][word], length + 1
            if length >= window:
                spans.append((at - window, at))
                top = state
                while size[link[top]] >= window:
                    top = link[top]
                found |= self.windows.get(top, set())
            for n, items in self.suffixes[state]:
                if n <= length:
                    spans.append((at - n, at))
                    found |= items
        return spans, found


class Block:
    """A block of items: their automaton and vocabulary."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.names = [name for name, _ in items]
        self.numbers: dict[bytes, int] = {}
        coded = [(k, [self.numbers.setdefault(w, len(self.numbers)) for w in words])
                 for k, (_, words) in enumerate(items)]
        self.automaton = SuffixAutomaton(coded, window)
        joined = b"".join(self.numbers)
        ends = np.cumsum([len(w) for w in self.numbers]).astype(np.int64)
        starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]])
        self.hashes = np.sort(A.span_hashes(np.frombuffer(joined, np.uint8), starts, ends))
        # a small table by the low bits tells almost all other words apart
        self.bits = max(16, len(self.hashes).bit_length() + 4)
        self.sieve = np.zeros(1 << self.bits, bool)
        self.sieve[(self.hashes & np.uint64((1 << self.bits) - 1)).astype(np.int64)] = True
        self.shortest = min(min(len(words), window) for _, words in items)

    def known(self, hashes: np.ndarray) -> np.ndarray:
        out = self.sieve[(hashes & np.uint64((1 << self.bits) - 1)).astype(np.int64)]
        maybe = np.flatnonzero(out)
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        out[maybe] = self.hashes[at] == hashes[maybe]
        return out


def item_words(text: str | None) -> list[bytes]:
    data = np.frombuffer((text or "").encode(), np.uint8)
    data = A.ASCII_LOWER[data]
    _, starts, ends = A.word_spans(data, np.array([0, len(data)]), NOT_WORD)
    raw = data.tobytes()
    return [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


def blocks_of(items: Iterator[tuple[str, str | None]], window: int, block_words: int) -> Iterator[list]:
    """Items (id, words) with words, cut into blocks of ``block_words`` words;
    an item longer than that is cut into overlapping pieces, which keep every
    window."""
    block, size = [], 0
    for name, text in items:
        words = item_words(text)
        for at in range(0, max(1, len(words) - window + 1), max(1, block_words - window + 1)):
            piece = words[at:at + block_words]
            if not piece:
                continue
            if size + len(piece) > block_words and block:
                yield block
                block, size = [], 0
            block.append((name, piece))
            size += len(piece)
    if block:
        yield block


def scan_slice(data: np.ndarray, offsets: np.ndarray, row: int, block: Block, spans: dict[int, list],
               found: dict[int, set]) -> None:
    """Add the hit spans in words and the item ids of documents ``row``
    onwards, as far as they are in the block."""
    data = A.ASCII_LOWER[data]
    doc, starts, ends = A.word_spans(data, offsets, NOT_WORD)
    if len(starts) == 0:
        return
    first = np.searchsorted(doc, np.arange(len(offsets)))
    known = block.known(A.span_hashes(data, starts, ends))
    raw = data.tobytes()
    change = np.flatnonzero(np.diff(np.concatenate([[0], known.view(np.int8), [0]])))
    for a, b in cut_runs(change[::2], change[1::2], doc, block.shortest):
        words = [block.numbers.get(raw[starts[i]:ends[i]], -1) for i in range(a, b)]
        hits, items = block.automaton.scan(words)
        if hits:
            d = int(doc[a])
            spans.setdefault(row + d, []).extend((a - int(first[d]) + s, a - int(first[d]) + e) for s, e in hits)
            found.setdefault(row + d, set()).update(block.names[k] for k in items)


def places(data: np.ndarray, offsets: np.ndarray, row: int, spans: dict[int, list],
           found: dict[int, set]) -> Iterator[tuple[int, list, list, list]]:
    """(number of words, hit spans in words, the same in bytes, item ids) of
    each document."""
    doc, starts, ends = A.word_spans(A.ASCII_LOWER[data], offsets, NOT_WORD)
    n = len(offsets) - 1
    first = np.searchsorted(doc, np.arange(n + 1))
    for d in range(n):
        hit = merged(spans.get(row + d, []))
        place = [(int(starts[first[d] + s] - offsets[d]), int(ends[first[d] + e - 1] - offsets[d])) for s, e in hit]
        yield int(first[d + 1] - first[d]), hit, place, sorted(found.get(row + d, ()))


def cut_runs(starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, shortest: int) -> Iterator[tuple[int, int]]:
    """Runs of known words of one document, at least ``shortest`` long."""
    long_enough = ends - starts >= shortest
    for a, b in zip(starts[long_enough].tolist(), ends[long_enough].tolist(), strict=True):
        while a < b:
            end = min(b, int(np.searchsorted(doc, doc[a], side="right")))
            if end - a >= shortest:
                yield a, end
            a = end


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


SPANS = "array<struct<start:long,end:long>>"


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                       block_words: int = BLOCK_WORDS) -> DataFrame:
    """Return doc_id, n_words, spans (hit word ranges, merged), byte_spans (the
    same in bytes of the text), n_hit, items (sorted ids of the items with
    occurring windows); a row per input row.

    Words are the maximal runs of ASCII digits, letters (A-Z lower-cased) and
    non-ASCII characters. A window is ``window`` consecutive words of an item,
    or the whole of a shorter item that has words. Null or empty texts have no
    words; items without words have no windows; items that repeat an id count
    as one id. Null ids of items are left out.

    The items pass the driver as a stream, a block at a time, into files of the
    shared folder.
    """
    rows = items.select(F.col(item_id_col).cast("string"), F.col(item_text_col).cast("string")).where(
        F.col(item_id_col).isNotNull()).orderBy(F.col(item_id_col).cast("string"))
    folder = scratch_path(docs.sparkSession, "items")
    paths = []
    for number, block in enumerate(blocks_of(((r[0], r[1]) for r in rows.toLocalIterator()), window, block_words)):
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/{number}") as sink:
            sink.write(zlib.compress(pickle.dumps(block)))
        paths.append(f"{folder}/{number}")

    def load(path: str) -> Block:
        system, root = file_system(path)
        with system.open_input_file(root) as source:
            return Block(pickle.loads(zlib.decompress(source.read())), window)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = None, None  # one block at a time

        def scanned(group: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal held, block
            spans, found = [{} for _ in group], [{} for _ in group]
            for path in paths:
                if held != path:
                    block = None
                    held, block = path, load(path)
                for k, batch in enumerate(group):
                    for a, _, data, offsets in A.slices(A.column(batch, "text")):
                        scan_slice(data, offsets, a, block, spans[k], found[k])
            for k, batch in enumerate(group):
                ids = A.column(batch, "doc_id")
                for a, b, data, offsets in A.slices(A.column(batch, "text")):
                    out = list(places(data, offsets, a, spans[k], found[k]))
                    yield pa.RecordBatch.from_arrays([
                        ids.slice(a, b - a), pa.array([x[0] for x in out], pa.int64()),
                        *(pa.array([[{"start": s, "end": e} for s, e in x[j]] for x in out], span_list) for j in (1, 2)),
                        pa.array([sum(e - s for s, e in x[1]) for x in out], pa.int64()),
                        pa.array([x[3] for x in out], pa.list_(pa.string()))],
                        names=["doc_id", "n_words", "spans", "byte_spans", "n_hit", "items"])

        span_list = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        group, size = [], 0
        for batch in batches:
            group.append(batch)
            size += A.column(batch, "text").nbytes
            if len(paths) < 2 or size >= GROUP_BYTES:  # a single block stays
                yield from scanned(group)
                group, size = [], 0
        yield from scanned(group)

    base = id_text(docs, id_col, text_col)
    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(
        scan, f"doc_id {kind}, n_words long, spans {SPANS}, byte_spans {SPANS}, n_hit long, items array<string>")


def is_contaminated(n_hit: Column, n_words: Column, parts: int = 20) -> Column:
    """Some word is hit, and at least one word in ``parts`` (exact integers)."""
    return (n_hit > 0) & (F.lit(parts) * n_hit >= n_words)


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      parts: int = 20, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose documents are not
    contaminated (``is_contaminated``). Rows that repeat an id stay or go
    together; rows with a null id stay."""
    found = find_contamination(docs, items, id_col, text_col, **options)
    bad = found.where(is_contaminated(F.col("n_hit"), F.col("n_words"), parts)).select(
        F.col("doc_id").alias(id_col)).distinct()
    return docs.join(bad, id_col, "left_anti")


def cut_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """doc_id, text: every text without the bytes of its hit spans, for use
    where the rest of a contaminated document is wanted."""
    found = find_contamination(docs, items, id_col, text_col, **options).where("n_hit > 0")
    base = id_text(docs, id_col, text_col)
    joined = base.join(found.select("doc_id", "byte_spans").dropDuplicates(["doc_id"]), "doc_id", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(A.column(batch, "text").to_pylist(), A.column(batch, "byte_spans").to_pylist(),
                                   strict=True):
                if spans:
                    raw, at, kept = text.encode(), 0, []
                    for span in spans:
                        kept.append(raw[at:span["start"]])
                        at = span["end"]
                    text = b"".join([*kept, raw[at:]]).decode()
                texts.append(text)
            yield pa.RecordBatch.from_arrays([A.column(batch, "doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    return joined.mapInArrow(cut, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, text string")
