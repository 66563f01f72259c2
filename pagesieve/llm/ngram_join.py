"""Exact n-gram Jaccard join with count vectors in an R-tree.

Tokens (hashes of word shingles) are dealt into ``GROUPS`` groups; a document is
the point of its group counts. The coordinate minima of two points sum to an
upper bound of their overlap, and so do the minima of a point and the upper
corner of a box: an R-tree over the points finds all partners that can still
reach the threshold, and only those are verified on the sets themselves.

The steps:

1. ``document_points``: set size, 128-bit set signature and count vector of
   every document. Documents of equal sets are one class from here on, with its
   smallest id as representative, so copies cost nothing further.
2. Routing to blocks: two sets that reach the threshold share one of the first
   n - ceil(t n) + 1 tokens of each in any common order. Ordered with the
   frequent tokens last (those of ``FREQUENT_IN`` documents of a sample, one in
   ``SAMPLE_SHARE``, about ``SAMPLE_DOCS`` at most; the order changes the work,
   never the result), blocks stay small.
3. Leaders: in each block every point is compared with a leader. The bound by
   coordinate minima removes most pairs, the rest are verified, links give
   components.
4. Blocks with points of several components (and more than two points) are cut
   into parts of at most ``PART`` points, and each pair of parts is searched
   with an R-tree for pairs of different components that pass the bound; these
   are verified too. Every linked pair shares a block, so after this step each
   linked pair was verified or is connected already: the components are exact.

Frequent tokens' blocks are salted in step 3 and dealt out in parts in step 4,
so no block, however large, has to fit one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagesieve.llm import arrowtext as A
from pagesieve.llm import shingles as S
from pagesieve.llm.components import connected_components
from pagesieve.llm.tables import id_text, materialize

GROUPS = 256
FINE_GROUPS = 1 << 12
SAMPLE_SHARE = 8
SAMPLE_DOCS = 200_000
FREQUENT_IN = 3
FREQUENT_TOKENS = 1 << 20
LEADERS = 8
SALTS = 8
PART = 1024
LEAF = 16
NODE_BUCKETS = 1 << 18
TOKENS_KEPT = 32
THRESHOLD = (75, 100)


def count_vector(tokens: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Tokens per group, as uint32."""
    return np.bincount((tokens % np.uint64(groups)).astype(np.int64), minlength=groups).astype(np.uint32)


def signature(tokens: np.ndarray) -> tuple[int, int]:
    return (int(A.mix64(tokens).sum(dtype=np.uint64).astype(np.int64)),
            int(A.mix64(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))


def document_points(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a, b (signature), counts (uint32 vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in A.slices(A.column(batch, "text")):
                sets = S.slice_shingles(data, offsets)
                signs = [signature(x) for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [A.column(batch, "doc_id").slice(low, high - low), pa.array([len(x) for x in sets], pa.int64()),
                     pa.array([x[0] for x in signs], pa.int64()), pa.array([x[1] for x in signs], pa.int64()),
                     pa.array([count_vector(x).tobytes() for x in sets], pa.binary())],
                    names=["doc_id", "n_shingles", "a", "b", "counts"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, a long, b long, counts binary")


def frequent_tokens(docs: DataFrame, total: int, sample_docs: int = SAMPLE_DOCS,
                    frequent_in: int = FREQUENT_IN, most: int = FREQUENT_TOKENS) -> np.ndarray:
    """Tokens of at least ``frequent_in`` documents of a sample: one document
    in ``SAMPLE_SHARE``, about ``sample_docs`` at most; the ``most`` frequent
    of them. Only an order depends on it."""
    scale = 1 << 20
    share = min(scale // SAMPLE_SHARE, sample_docs * scale // max(total, 1) + 1)
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in A.slices(A.column(batch, "text")):
                sets = S.slice_shingles(data, offsets)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], names=["token"])

    counted = sample.select("text").mapInArrow(run, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    found = counted.where(F.col("n") >= frequent_in).orderBy(F.desc("n"), "token").limit(most)
    found = found.select("token").toArrow()["token"].to_numpy()
    return np.sort(found.view(np.uint64))


def prefix_length(n: int, threshold: tuple[int, int]) -> int:
    parts, whole = threshold
    return n - -(-parts * n // whole) + 1


def split_frequent(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(tokens), bool)
    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    return frequent[at] == tokens


def route(docs: DataFrame, frequent: np.ndarray, threshold: tuple[int, int]) -> DataFrame:
    """(token, salt, node): a row per prefix token of each representative."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for batch in batches:
            for low, high, data, offsets in A.slices(A.column(batch, "text")):
                sets = S.slice_shingles(data, offsets)
                ids = A.column(batch, "doc_id").slice(low, high - low).to_numpy(zero_copy_only=False)
                out, salts, sizes = [], [], []
                for node, tokens in zip(ids, sets, strict=True):
                    length = prefix_length(len(tokens), threshold) if len(tokens) else 0
                    often = split_frequent(tokens, frequent)
                    rare = tokens[~often][:length]
                    more = tokens[often][:length - len(rare)]
                    out += [rare, more]
                    salts.append(np.concatenate([np.full(len(rare), -1), np.full(len(more), int(node) % SALTS)]))
                    sizes.append(length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out).view(np.int64)), pa.array(np.concatenate(salts).astype(np.int32)),
                     pa.array(np.repeat(ids, sizes))], names=["token", "salt", "node"])

    return docs.mapInArrow(run, "token long, salt int, node long")


def least_overlap(total: np.ndarray | int, threshold: tuple[int, int]) -> np.ndarray | int:
    """The overlap two sets of ``total`` tokens together need."""
    parts, whole = threshold
    return -(-parts * total // (whole + parts))


def overlap_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum(a, b).sum(axis=-1, dtype=np.int64)


def bounded(pairs: DataFrame, points: DataFrame, threshold: tuple[int, int], kind: type = np.uint32) -> DataFrame:
    """Pairs (u, v) whose summed coordinate minima reach the threshold."""
    one = points.select(F.col("doc_id").alias("u"), F.col("counts").alias("cu"))
    two = points.select(F.col("doc_id").alias("v"), F.col("counts").alias("cv"))
    both = pairs.join(one, "u").join(two, "v").select("u", "v", "cu", "cv")

    def reaches(a: bytes, b: bytes) -> bool:
        x, y = np.frombuffer(a, kind), np.frombuffer(b, kind)
        total = int(x.sum(dtype=np.int64) + y.sum(dtype=np.int64))
        # the finer point in the coarser one's groups
        x, y = (v.reshape(-1, min(len(x), len(y))).sum(axis=0, dtype=np.int64) for v in (x, y))
        return int(overlap_bound(x, y)) >= least_overlap(total, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                cu, cv = A.column(part, "cu").to_pylist(), A.column(part, "cv").to_pylist()
                keep = pa.array([reaches(a, b) for a, b in zip(cu, cv, strict=True)], pa.bool_())
                yield part.select(["u", "v"]).filter(keep)

    return both.mapInArrow(run, "u long, v long")


def vectors(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), GROUPS)


def fine_points(docs: DataFrame) -> DataFrame:
    """doc_id, counts (uint16; no text has so many tokens that a group of the
    largest point overflows): points with at least as many groups as tokens, up
    to ``FINE_GROUPS``; a power of two, so finer points fold into coarser ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in A.slices(A.column(batch, "text")):
                sets = S.slice_shingles(data, offsets)
                groups = [min(max(GROUPS, 1 << len(x).bit_length()), FINE_GROUPS) for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [A.column(batch, "doc_id").slice(low, high - low),
                     pa.array([count_vector(x, g).astype(np.uint16).tobytes() for x, g in zip(sets, groups, strict=True)],
                              pa.binary())],
                    names=["doc_id", "counts"])

    return docs.mapInArrow(run, "doc_id long, counts binary")


def verify(pairs: DataFrame, docs: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs (u, v) whose shingle sets reach the threshold, exactly. The
    bound over finer points goes first: it spares most of the long texts."""
    nodes = materialize(pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct())
    # most documents are in no pair: those whose id's hash is none of a node's stay out of the shuffle of texts
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(NODE_BUCKETS))
    held = nodes.select(bucket.alias("bucket")).distinct()  # NODE_BUCKETS rows at most
    near = docs.withColumn("bucket", bucket).join(F.broadcast(held), "bucket", "left_semi").select("doc_id", "text")
    texts = materialize(near.join(nodes, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    pairs = bounded(pairs, fine_points(texts), threshold, np.uint16)
    rows = pairs.join(texts.select(F.col("doc_id").alias("u"), F.col("text").alias("tu")), "u").join(
        texts.select(F.col("doc_id").alias("v"), F.col("text").alias("tv")), "v").select("u", "v", "tu", "tv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                a = S.text_shingles(A.column(part, "tu").to_pylist())
                b = S.text_shingles(A.column(part, "tv").to_pylist())
                keep = pa.array([S.similar(x, y, *threshold) for x, y in zip(a, b, strict=True)], pa.bool_())
                yield part.select(["u", "v"]).filter(keep)

    return rows.mapInArrow(run, "u long, v long")


class CountTree:
    """R-tree over count vectors, bulk loaded by halving along the coordinate
    of largest spread, after large components are set apart. A node keeps the
    upper corner of its box, the smallest total of its points, and their
    component if it is one."""

    def __init__(self, points: np.ndarray, totals: np.ndarray, comps: np.ndarray | None = None, leaf: int = LEAF):
        self.points, self.totals = points, totals
        self.comps = np.arange(len(points)) if comps is None else comps
        self.root = self._load(np.arange(len(points)), leaf)

    def _load(self, rows: np.ndarray, leaf: int) -> tuple:
        own, comps = self.points[rows], self.comps[rows]
        names, counts = np.unique(comps, return_counts=True)
        node = own.max(axis=0), int(self.totals[rows].min()), int(names[0]) if len(names) == 1 else None
        if len(rows) <= leaf:
            return *node, rows, None
        if len(names) > 1 and counts.max() >= leaf:
            inside = comps == names[counts.argmax()]
            halves = rows[inside], rows[~inside]
        else:
            spread = np.argmax(node[0].astype(np.int64) - own.min(axis=0))
            order = rows[np.argsort(own[:, spread], kind="stable")]
            halves = order[:len(order) // 2], order[len(order) // 2:]
        return *node, None, tuple(self._load(half, leaf) for half in halves)

    def search(self, point: np.ndarray, total: int, threshold: tuple[int, int]) -> np.ndarray:
        """Rows whose summed coordinate minima with ``point`` suffice."""
        one = CountTree(point[None], np.array([total]), np.array([-1]))
        return np.sort(np.array([j for _, j in one.join(self, threshold)], np.int64))

    def join(self, other: CountTree, threshold: tuple[int, int]) -> Iterator[tuple[int, int]]:
        """Pairs (own row, other's row) of different components whose summed
        coordinate minima suffice: both trees are descended together, as long as
        the minima of the upper corners do."""
        stack = [(self.root, other.root)]
        while stack:
            a, b = stack.pop()
            if (a[2] is not None and a[2] == b[2]) or overlap_bound(a[0], b[0]) < least_overlap(a[1] + b[1], threshold):
                continue
            if a[4] is None and b[4] is None:
                bound = overlap_bound(self.points[a[3]][:, None], other.points[b[3]][None])
                total = self.totals[a[3]][:, None] + other.totals[b[3]][None]
                fits = (bound >= least_overlap(total, threshold)) & (
                    self.comps[a[3]][:, None] != other.comps[b[3]][None])
                i, j = np.nonzero(np.triu(fits) if a is b else fits)
                yield from zip(a[3][i].tolist(), b[3][j].tolist(), strict=True)
            elif b[4] is None or (a[4] is not None and a is not b):
                stack.extend((child, b) for child in a[4])
            elif a is b:
                # a tree with itself: every pair of nodes once
                stack.extend((a[4][x], a[4][y]) for x, y in ((0, 0), (0, 1), (1, 1)))
            else:
                stack.extend((a, child) for child in b[4])


def is_home(token: int, a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the block of ``token`` reports a pair that shares several
    blocks: it is the smallest token that both points' lists have. The lists
    hold the smallest tokens only; without a common one every block reports."""
    common = np.intersect1d(a, b, assume_unique=True)
    return not len(common) or common[0] == token


def search_parts(part: np.ndarray, comps: np.ndarray, points: np.ndarray,
                 threshold: tuple[int, int]) -> list[tuple[int, int]]:
    """Pairs (rows) of different components that pass the bound: within the
    part if there is one, else across the two parts (each part finds its own
    pairs)."""
    totals = points.sum(axis=1, dtype=np.int64)
    sides = [np.flatnonzero(part == s) for s in np.unique(part)]
    trees = [CountTree(points[rows], totals[rows], comps[rows]) for rows in sides]
    return [(int(sides[0][i]), int(sides[-1][j])) for i, j in trees[0].join(trees[-1], threshold)]


def search_small(starts: np.ndarray, ends: np.ndarray, nodes: np.ndarray, comps: np.ndarray, points: np.ndarray,
                 threshold: tuple[int, int]) -> list[tuple[int, int]]:
    """The same for many blocks of a few points each: a tree of one leaf
    compares all its points, here the leaves of all blocks together."""
    sizes = ends - starts
    first = np.repeat(np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(
        starts, sizes), np.repeat(sizes, sizes))
    row = np.arange(len(first)) - np.repeat(np.cumsum(sizes**2) - sizes**2, sizes**2)
    second = np.repeat(starts, sizes**2) + row % np.repeat(sizes, sizes**2)
    open_ = (nodes[first] < nodes[second]) & (comps[first] != comps[second])
    first, second = first[open_], second[open_]
    totals = points.sum(axis=1, dtype=np.int64)
    found = []
    for low in range(0, len(first), 4096):
        i, j = first[low:low + 4096], second[low:low + 4096]
        fits = overlap_bound(points[i], points[j]) >= least_overlap(totals[i] + totals[j], threshold)
        found.extend(zip(i[fits].tolist(), j[fits].tolist(), strict=True))
    return found


def open_pairs(blocks: DataFrame, points: DataFrame, comps: DataFrame, threshold: tuple[int, int],
               part_size: int = PART) -> DataFrame:
    """Pairs (u, v) of one block, of different components, that pass the bound.
    ``blocks``: (token, node, salted); a block of two points was compared
    before unless it was salted."""
    marked = blocks.join(comps, "node", "left").select(
        "token", "node", "salted", F.coalesce("component", "node").alias("comp"))
    marked = materialize(marked)
    mixed = marked.groupBy("token").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("rows"),
        F.max("salted").alias("salted"), F.bit_xor(F.xxhash64("node")).alias("x"),
        F.sum(F.xxhash64("node", F.lit(1)).cast("decimal(38,0)")).alias("y"))
    mixed = mixed.where("(rows > 2 or salted) and lo != hi")
    # blocks of the same points (by two hashes of them) are one
    mixed = mixed.groupBy("rows", "x", "y").agg(F.min("token").alias("token"))
    mixed = mixed.select("token", F.ceil(F.col("rows") / part_size).cast("int").alias("parts"))
    rows = materialize(marked.join(mixed, "token"))
    # a list per point, bounded by its tokens: lets a pair be reported by one of the blocks it shares
    lists = rows.groupBy("node").agg(F.slice(F.sort_array(F.collect_list("token")), 1, TOKENS_KEPT).alias("tokens"))
    lists = lists.join(points.select(F.col("doc_id").alias("node"), "counts"), "node").dropDuplicates(["node"])
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    # a block of several parts: a copy of each point for every pair of parts it is in
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("token", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part",
                       "node", "comp")
    rows = rows.join(lists, "node")
    rows = rows.repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs_of(table: pa.Table) -> pa.RecordBatch:
            key = np.column_stack([table[k].to_numpy() for k in ("token", "lo", "hi")])
            new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1), [True]]))
            nodes, part, own = (table[k].to_numpy() for k in ("node", "part", "comp"))
            points = vectors(table["counts"].combine_chunks())
            lists = table["tokens"].combine_chunks()
            starts, ends = new[:-1], new[1:]
            small = (key[starts, 1] == key[starts, 2]) & (ends - starts <= 2 * LEAF)
            hits = search_small(starts[small], ends[small], nodes, own, points, threshold)
            for a, b in zip(starts[~small].tolist(), ends[~small].tolist(), strict=True):
                across = key[a, 1] != key[a, 2]
                if (across and len(np.unique(part[a:b])) < 2) or len(np.unique(own[a:b])) < 2:
                    continue
                hits += [(a + i, a + j) for i, j in search_parts(part[a:b], own[a:b], points[a:b], threshold)]
            token_list = {i: lists[i].values.to_numpy() for pair in hits for i in pair}
            found = {(int(min(nodes[i], nodes[j])), int(max(nodes[i], nodes[j]))) for i, j in hits
                     if is_home(key[i, 0], token_list[i], token_list[j])}
            u, v = zip(*sorted(found), strict=True) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        held: pa.Table | None = None  # rows of the last, maybe unfinished, pair of parts
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            keys = [held[k].to_numpy() for k in ("token", "lo", "hi")]
            unfinished = np.logical_and.reduce([k == k[-1] for k in keys]) if held.num_rows else np.zeros(0, bool)
            cut = held.num_rows - int(unfinished.sum())
            if cut:
                yield pairs_of(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield pairs_of(held)

    return rows.select("token", "lo", "hi", "part", "node", "comp", "counts", "tokens").mapInArrow(
        run, "u long, v long").distinct()


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Return doc_id, n_shingles, component_id; a row per input row.

    Two documents link when the Jaccard similarity of their sets of distinct
    five-word shingles reaches ``threshold`` (parts of a whole, exactly); a
    document of fewer words has its word sequence as its one shingle. The
    component is the smallest id reachable by links. Documents without words
    (null, empty, blank) link with nothing and are their own component; so are
    rows with a null id (component null) unless their set equals another's.
    Repeated rows are equal sets. Ids must be integers and belong to one text.
    """
    base = id_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    points = materialize(document_points(base))
    total = points.count()
    classes = materialize(points.where("n_shingles > 0").groupBy("n_shingles", "a", "b").agg(
        F.min("doc_id").alias("rep")))
    reps = classes.where("rep is not null").select(F.col("rep").alias("doc_id"))
    own = points.select("doc_id", "counts")
    texts = base.join(reps, "doc_id", "left_semi")

    frequent = frequent_tokens(base, total)
    window = Window.partitionBy("token", "salt")
    lead = F.struct(F.xxhash64("node", F.pmod("token", F.lit(LEADERS))), "node")
    blocks = route(texts, frequent, threshold).withColumn("lead", F.min(lead).over(window)).withColumn(
        "rows", F.count(F.lit(1)).over(window))
    blocks = blocks.where("rows > 1 or salt >= 0").select(
        "token", "node", (F.col("salt") >= 0).alias("salted"), F.col("lead.node").alias("leader"))
    blocks = materialize(blocks)

    stars = blocks.where(F.col("node") != F.col("leader")).select(F.least("node", "leader").alias("u"), F.greatest("node", "leader").alias("v")).distinct()
    links = materialize(verify(materialize(bounded(stars, own, threshold)), base, threshold))
    comps = connected_components(links)
    rest = materialize(open_pairs(blocks.select("token", "node", "salted").distinct(), own, comps, threshold))
    comps = connected_components(links.unionByName(verify(rest, base, threshold)))

    named = classes.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select(
        "n_shingles", "a", "b", F.coalesce("component", "rep").alias("component"))
    return points.select("doc_id", "n_shingles", "a", "b").join(named, ["n_shingles", "a", "b"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are the smallest id
    of their component. Rows that repeat an id stay or go together; rows with a
    null id stay."""
    found = similar_components(docs, id_col, text_col, threshold)
    copies = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(copies, id_col, "left_anti")
