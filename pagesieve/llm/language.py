"""Language identification by prediction by partial matching.

Each language has a context tree over the folded bytes of its texts: the counts of every symbol
after every context of 0 to ``ORDER`` symbols. With n symbols seen after a
context, q of them distinct, a symbol seen c times has probability c / (n + q),
and the escape to the next shorter context q / (n + q); below the empty context
all symbols are equally likely. A text's code length under a language is the
sum over its symbols; the statistics are frozen, so it does not depend on what
was scored before. The shortest code names the language.

Symbols: A-Z and a-z by letter, bytes of non-ASCII characters by their low five
bits, everything else one symbol. All contexts of the highest order with their
symbols fit a dense index, so scoring is a table look-up per byte.

Counting covers the whole texts of all rows that may be learned from. All
strings of ORDER + 1 symbols that occur come to the driver with their counts,
at most SYMBOLS^(ORDER + 1) per language, however long the texts, and
``LANGUAGES_PER_BLOCK`` languages at a time. Their tables are files in the
shared folder, and a task scores a batch of rows under one block after another.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesieve.llm import arrowtext as A
from pagesieve.llm.records import file_system
from pagesieve.llm.tables import id_text, materialize, scratch_path

ORDER = 3
LANGUAGES_PER_BLOCK = 16
COUNT_BYTES = 16 << 20
UNKNOWN = "und"

SYMBOL = np.zeros(256, np.uint8)
SYMBOL[65:91] = SYMBOL[97:123] = np.arange(1, 27)
SYMBOL[128:] = 27 + (np.arange(128, 256) & 31)
SYMBOLS = 59


def gram_codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte, the number of the ORDER symbols before it and its own;
    before a text stand separators."""
    symbols = SYMBOL[data]
    starts = offsets[:-1][np.diff(offsets) > 0]
    code, weight, shifted = symbols.astype(np.int32), 1, symbols
    for _ in range(ORDER):
        shifted = np.concatenate([np.zeros(1, np.uint8), shifted[:-1]])
        shifted[starts] = 0
        weight *= SYMBOLS
        code += shifted * np.int32(weight)
    return code


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) of rows (text, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = A.column(batch, "lang")
            for lang in pc.unique(langs).to_pylist():
                own = batch.filter(pc.equal(langs, lang))
                for _, _, data, offsets in A.slices(A.column(own, "text"), COUNT_BYTES):
                    counts = np.bincount(gram_codes(data, offsets))
                    grams = np.flatnonzero(counts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts[grams])],
                        names=["lang", "gram", "n"])

    return docs.select("text", "lang").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))


class Trees:
    """Frozen code lengths in bits of all languages.

    ``row_of`` maps a gram known in any language to its row of ``known``; other
    grams cost the escape from their longest context plus ``shorter``."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        top = SYMBOLS ** (ORDER + 1)
        grams = np.unique(np.concatenate([counts[x][0] for x in self.langs])) if counts else np.zeros(0, np.int64)
        self.row_of = np.full(top, -1, np.int32)
        self.row_of[grams] = np.arange(len(grams), dtype=np.int32)
        self.known = np.zeros((len(grams), len(self.langs)), np.float32)
        self.escape = np.zeros((top // SYMBOLS, len(self.langs)), np.float32)
        self.shorter = np.zeros((top // SYMBOLS, len(self.langs)), np.float32)
        for k, lang in enumerate(self.langs):
            own, n = counts[lang]
            dense = np.zeros(top, np.float64)
            dense[own] = n
            cost = np.full(1, np.log2(SYMBOLS))
            for order in range(ORDER + 1):
                # counts of (context of this order, symbol): summed over what stands before
                size = SYMBOLS ** (order + 1)
                table = dense.reshape(-1, size).sum(axis=0).reshape(-1, SYMBOLS)
                total, kinds = table.sum(axis=1), (table > 0).sum(axis=1)
                with np.errstate(divide="ignore"):
                    leave = np.where(kinds > 0, np.log2(total + kinds) - np.log2(np.maximum(kinds, 1)), 0.0)
                    stay = np.log2(np.maximum(total + kinds, 1))[:, None] - np.log2(table)
                # the next shorter context is this one without its first symbol
                below = np.broadcast_to(cost, (SYMBOLS,)).reshape(1, -1) if order == 0 else np.tile(
                    cost.reshape(-1, SYMBOLS), (SYMBOLS, 1))
                if order == ORDER:
                    self.escape[:, k] = leave
                    self.shorter[:, k] = cost
                    at, symbol = grams // SYMBOLS, grams % SYMBOLS
                    seen = table[at, symbol] > 0
                    self.known[:, k] = np.where(seen, stay[at, symbol], leave[at] + below[at, symbol])
                else:
                    cost = np.where(table > 0, stay, leave[:, None] + below).ravel()

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each document under each language."""
        n = len(offsets) - 1
        out = np.zeros((n, len(self.langs)))
        full = np.flatnonzero(np.diff(offsets) > 0)
        if len(full) == 0 or not self.langs:
            return out
        codes = gram_codes(data, offsets)
        rows = self.row_of[codes]
        bits = self.known[rows] if len(self.known) else np.zeros((len(codes), len(self.langs)), np.float32)
        new = np.flatnonzero(rows < 0)
        bits[new] = self.escape[codes[new] // SYMBOLS] + self.shorter[codes[new] % SYMBOLS**ORDER]
        out[full] = np.add.reduceat(bits, offsets[:-1][full], axis=0, dtype=np.float64)
        return out


def fit(rows: DataFrame, languages_per_block: int = LANGUAGES_PER_BLOCK) -> Iterator[Trees]:
    """Learn from rows (text, lang): any number of languages, in blocks, in
    ascending order."""
    grams = materialize(count_grams(rows))
    langs = (r[0] for r in grams.select("lang").distinct().orderBy("lang").toLocalIterator())
    while block := list(islice(langs, languages_per_block)):
        table = grams.where(F.col("lang").isin(block)).toArrow()
        counts = {}
        for lang in block:
            own = table.filter(pc.equal(table["lang"], lang))
            counts[lang] = own["gram"].to_numpy(), own["n"].to_numpy()
        yield Trees(counts)


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def identify(docs: DataFrame, blocks: Iterable[Trees], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score: the language with the shortest code and its
    share of the probability that the languages give the text. ``und`` and 0
    for null texts, texts without a letter, or when nothing was learned."""
    folder = scratch_path(docs.sparkSession, "languages")
    paths = []
    for number, trees in enumerate(blocks):
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/{number}") as sink:
            pickle.dump(trees, sink)
        paths.append(f"{folder}/{number}")

    def load(path: str) -> Trees:
        system, root = file_system(path)
        with system.open_input_file(root) as source:
            return pickle.load(source)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, trees = None, None  # one block at a time
        for batch in batches:
            texts = A.column(batch, "text")
            n = batch.num_rows
            names = np.full(n, UNKNOWN, dtype=object)
            low, weight, lettered = np.full(n, np.inf), np.zeros(n), np.zeros(n, bool)
            for a, b, data, offsets in A.slices(texts):
                ascii_letters = np.zeros(len(data) + 1, np.int64)
                np.cumsum((SYMBOL[data] > 0) & (data < 128), out=ascii_letters[1:])
                lettered[a:b] = np.diff(ascii_letters[offsets]) > 0
                for k in range(a, b):
                    lettered[k] = lettered[k] or has_letter(texts[k].as_py())
            for path in paths:
                if held != path:
                    trees = None
                    held, trees = path, load(path)
                langs = np.array(trees.langs, dtype=object)
                for a, b, data, offsets in A.slices(texts):
                    bits = trees.code_lengths(data, offsets)
                    own = bits.min(axis=1)
                    total = np.exp2(-np.minimum(bits - own[:, None], 1000)).sum(axis=1)
                    least = np.minimum(own, low[a:b])
                    names[a:b] = np.where(own < low[a:b], langs[bits.argmin(axis=1)], names[a:b])
                    weight[a:b] = weight[a:b] * np.exp2(-np.minimum(low[a:b] - least, 1000)) + total * np.exp2(
                        -np.minimum(own - least, 1000))
                    low[a:b] = least
            lettered &= weight > 0
            share = np.divide(1.0, weight, out=np.zeros(n), where=lettered)
            yield pa.RecordBatch.from_arrays(
                [A.column(batch, "doc_id"), pa.array(np.where(lettered, names, UNKNOWN), pa.string()),
                 pa.array(share)], names=["doc_id", "lang_pred", "score"])

    base = id_text(docs, id_col, text_col)
    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(score, f"doc_id {kind}, lang_pred string, score double")


def held_out(doc_id: Column, folds: int = 4, out: int = 2) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == out, F.lit(False))


def identify_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang", languages_per_block: int = LANGUAGES_PER_BLOCK) -> DataFrame:
    """Learn from the rows that are not held out and carry a language, predict
    for every row: doc_id, held_out, lang_pred, score. Rows with a null id are
    never held out; repeated rows count as often as they stand."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
    blocks = fit(rows.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()),
                 languages_per_block)
    found = identify(docs, blocks, id_col, text_col)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
