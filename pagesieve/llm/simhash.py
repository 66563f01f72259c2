"""SimHash near-duplicate detection with pivot distance tables.

1. *Fingerprints.* A document's words give shingles of three words, repeats
   included; a fingerprint bit is 1 if it is set in more than half of the
   shingles' XXH64 values. Documents with equal fingerprints are one class from
   here on, by an aggregate that combines before the shuffle, so a group of
   copies of any size is one row.
2. *Blocks.* The 64 bits are cut into five fields. Two fingerprints that differ in
   three bits at most agree on two fields at least, so each class goes to ten
   blocks, one per pair of fields, and every pair that links shares one. A block
   of more than ``PART`` rows is dealt over pairs of its parts.
3. *Pivot distance table.* In a block the Hamming distances of every fingerprint
   to ``PIVOTS`` reference fingerprints are computed once. By the triangle
   inequality two rows that link differ by three at most in each coordinate: rows
   are sorted by the first one, only rows within three of it are paired, and a
   pair whose largest coordinate difference exceeds three is discarded.
4. *Verification.* Pairs that are left are compared bit by bit. Rows of a block that
   are connected already are not compared again, so a block of n rows gives fewer
   than n links, not a row per pair.
5. *Components* of the links, by star contraction, and each one's smallest id.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesieve.llm import arrowtext as A
from pagesieve.llm.components import connected_components
from pagesieve.llm.tables import id_text, materialize, small_batches

SHINGLE = 3
SEED = 42
BITS = 64
RADIUS = 3
FIELDS = (13, 13, 13, 13, 12)  # any two of five agree where three bits differ at most
PIVOTS = 32
PART = 16_384
HASHES_AT_ONCE = 1 << 16


# ---------------------------------------------------------------------------
# Fingerprints
# ---------------------------------------------------------------------------

def joined_words(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, document, start, end) of the words of a slice, lower-cased and
    with exactly one blank between the words of a document."""
    data = A.ASCII_LOWER[data]
    doc, starts, ends = A.word_spans(data, offsets, A.ASCII_SPACE)
    if not len(doc):
        return b"", doc, starts, ends
    sizes, follows = ends - starts, doc[1:] == doc[:-1]
    blank = A.ASCII_SPACE[data]
    kept = ~blank
    kept[ends[:-1][follows]] = True  # the first blank behind a word, if another word follows
    new_starts = np.cumsum(sizes) - sizes + np.concatenate([[0], np.cumsum(follows)])
    return np.where(blank, np.uint8(32), data)[kept].tobytes(), doc, new_starts, new_starts + sizes


def bit_counts(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """How often each bit is set in the runs of ``hashes`` that begin at
    ``firsts``: (runs, 64), the highest bit first."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.add.reduceat(bits, firsts, axis=0, dtype=np.int64)


def slice_fingerprints(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The fingerprint (uint64) of each document of a slice."""
    joined, doc, starts, ends = joined_words(data, offsets)
    n = len(offsets) - 1
    if not len(doc):
        return np.zeros(n, np.uint64)
    words = np.bincount(doc, minlength=n)
    first = np.concatenate([[0], np.cumsum(words)])
    # a shingle begins at every word that has size - 1 words behind it, or at the first of a short text
    begins = np.arange(len(doc))
    short = words < size
    begins = begins[(begins + size <= first[doc + 1]) | (short[doc] & (begins == first[doc]))]
    owner = doc[begins]
    low = starts[begins]
    high = ends[np.where(short[owner], first[owner + 1], begins + size) - 1]
    counts = np.zeros((n, BITS), np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(begins), HASHES_AT_ONCE):
        until = min(at + HASHES_AT_ONCE, len(begins))
        hashes = np.array([digest(joined[a:b], seed) for a, b in
                           zip(low[at:until].tolist(), high[at:until].tolist(), strict=True)], np.uint64)
        own = owner[at:until]
        firsts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        counts[own[firsts]] += bit_counts(hashes, firsts)
    total = np.bincount(owner, minlength=n)
    return np.packbits(2 * counts > total[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of documents (doc_id, text); fp holds the 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in A.slices(A.column(batch, "text")):
                found = slice_fingerprints(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [A.column(batch, "doc_id").slice(low, high - low), pa.array(found.view(np.int64))],
                    names=["doc_id", "fp"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


# ---------------------------------------------------------------------------
# Links between fingerprints
# ---------------------------------------------------------------------------

@functools.cache
def pivots(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints, by a rule: mixed numbers."""
    return A.mix64(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def distance_table(fps: np.ndarray) -> np.ndarray:
    """(pivots, rows): Hamming distances to the reference fingerprints."""
    return np.bitwise_count(fps[None, :] ^ pivots()[:, None]).astype(np.int8)


def block_keys(fp: Column) -> Column:
    """The keys of a fingerprint's ten blocks: two fields' bits under the
    number of the pair."""
    ends = np.cumsum(FIELDS)
    fields = [F.shiftrightunsigned(fp, int(BITS - e)).bitwiseAND(F.lit((1 << w) - 1))
              for e, w in zip(ends, FIELDS, strict=True)]
    return F.array(*[F.lit(k << 26).bitwiseOR(F.shiftleft(fields[a], 13)).bitwiseOR(fields[b])
                     for k, (a, b) in enumerate(combinations(range(len(FIELDS)), 2))])


def blocks(classes: DataFrame, part: int = PART) -> DataFrame:
    """(key, lo, hi, own, fp): the classes in their blocks. The rows of a block of more
    than ``part`` rows are dealt by a hash over parts; a row then stands in
    every pair (lo, hi) of parts with its own one."""
    keyed = classes.select("fp", F.explode(block_keys(F.col("fp"))).alias("key"))
    large = materialize(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > part))
    parts = F.coalesce(F.ceil(F.col("rows") / part).cast("int"), F.lit(1))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = keyed.join(large, "key", "left").select("key", "fp", parts.alias("parts")).withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    return dealt.select("key", "fp", "own", other.alias("other")).select(
        "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "fp")


def root_of(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def block_links(group: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, row) that connect all rows of the same group whose
    fingerprints differ in ``radius`` bits at most, fewer than a group has rows.
    Rows are sorted by group."""
    table = distance_table(fps)
    order = np.lexsort((table[0], group))
    group, fps, table = group[order], fps[order], table[:, order]
    n = len(fps)
    comp = np.arange(n)
    parent = list(range(n))
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.zeros(0, np.int64)
    block = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]])) if n else comp
    links: list[tuple[int, int]] = []
    active, step, united = np.arange(n), 0, False
    while len(active):
        step += 1
        active = active[active + step < n]
        near = (group[active] == group[active + step]) & (table[0, active + step] - table[0, active] <= radius)
        active = active[near]  # rows are sorted: what is too far stays too far
        pair = active[comp[active] != comp[active + step]]
        for k in range(1, len(table)):
            if not len(pair):
                break
            pair = pair[np.abs(table[k, pair] - table[k, pair + step]) <= radius]
        pair = pair[np.bitwise_count(fps[pair] ^ fps[pair + step]) <= radius]
        for a, b in zip(pair.tolist(), (pair + step).tolist(), strict=True):
            x, y = root_of(parent, a), root_of(parent, b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((a, b))
                united = True
        if united and step & (step - 1) == 0:  # after 1, 2, 4, ... steps: what is one component needs no more
            comp = np.array(parent)
            while (comp[comp] != comp).any():
                comp = comp[comp]
            whole = np.minimum.reduceat(comp, starts) == np.maximum.reduceat(comp, starts)
            active = active[~whole[block[active]]]
            united = False
    found = np.array(links, np.int64).reshape(-1, 2)
    return order[found[:, 0]], order[found[:, 1]]


def links(classes: DataFrame, part: int = PART, rows_at_once: int = 1 << 18) -> DataFrame:
    """(u, v): fingerprints that connect what is linked."""
    dealt = blocks(classes, part).repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")

    def found(table: pa.Table) -> pa.RecordBatch:
        new = np.zeros(table.num_rows, bool)
        for name in ("key", "lo", "hi"):
            column = table[name].to_numpy()
            new[1:] |= column[1:] != column[:-1]
        fps = table["fp"].to_numpy().view(np.uint64)
        a, b = block_links(np.cumsum(new), fps)
        return pa.RecordBatch.from_arrays([pa.array(fps[a].view(np.int64)), pa.array(fps[b].view(np.int64))],
                                          names=["u", "v"])

    def last_block(table: pa.Table) -> int:
        """Where the last row's block begins."""
        at = 0
        for name in ("key", "lo", "hi"):
            column = table[name].to_numpy()
            other = np.flatnonzero(column != column[-1])
            at = max(at, int(other[-1]) + 1 if len(other) else 0)
        return at

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= rows_at_once:
                table = pa.Table.from_batches(held)
                cut = last_block(table)  # the last block may go on
                if cut:
                    yield found(table.slice(0, cut))
                held, size = table.slice(cut).to_batches(), table.num_rows - cut
        if size:
            yield found(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part: int = PART) -> DataFrame:
    """Return doc_id, fingerprint (16 lowercase hex digits), component_id (the
    smallest doc_id reachable by links, its own included); a row per input row.

    Words are the maximal runs of bytes that are no ASCII blanks, A-Z
    lower-cased. A text of fewer than three words has its word sequence as its
    one shingle; a null, empty or blank text has fingerprint zero and links as
    any other. Rows that repeat an id are rows of their own. Rows with a null id
    link and connect as any other, and are never a component's id: a component
    of such rows alone has a null one.
    """
    small_batches(docs.sparkSession)
    marked = materialize(fingerprints(id_text(docs, id_col, text_col)))
    classes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = connected_components(materialize(links(classes, part)))
    own = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    least = own.groupBy("component").agg(F.min("least").alias("component_id"))
    named = own.select("fp", "component").join(least, "component").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
