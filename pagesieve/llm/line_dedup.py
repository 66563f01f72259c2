"""Line dedup over levelled sorted runs of line hashes (DataFrame functions only).

The documents come in batches, largest ids first. A *run* is a table of
(line hash, number of documents, largest document id), one row per line hash,
written sorted by hash in the shared checkpoint folder. Each batch makes its
own run and merge-anti-joins it with the runs so far: what is left are the
lines that no earlier batch had, and as ids descend, the batch's largest id
holding such a line is the one that keeps it in the whole corpus. Then the run
is added; ``fan_in`` runs of one level are merged into one run of the next, so
a line hash is rewritten once per level only, as in a log-structured store.
After the last batch the runs together tell in how many documents a line
stands.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z
lower-cased. Only keys of at least ``min_chars`` code points take part. Keys
are compared by two 64-bit hashes (128 bits).

Runs are bucketed by line hash, so the anti joins move no row. All other steps are
equi-joins and aggregates that combine before the shuffle: a line found in a
third of all documents moves one row per map task, and the join that marks lines
is split by adaptive execution. A document's lines are marked by their places
and cut out by slices between them, so its cost grows with its lines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesieve.functions.text import let
from pagesieve.llm.tables import bucketed, materialize

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FAN_IN = 2

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def line_hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))


def text_lines(text: Column) -> Column:
    """The lines of a text; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def placed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text_hash, place, a, b): the hashes of each document's eligible
    lines, with their places from 0."""
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))  # once, not for every line
    lines = hashed.select("doc_id", "text_hash", F.posexplode(text_lines(F.col("text"))).alias("place", "line"))
    keyed = lines.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
    return keyed.select("doc_id", "text_hash", "place", line_hash(F.col("key")).alias("h")).select(
        "doc_id", "text_hash", "place", "h.a", "h.b")


def document_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, a, b): the distinct hashes of each document's eligible lines."""
    return placed_lines(docs, min_chars).select("doc_id", "a", "b").distinct()


def without_places(lines: Column, places: Column) -> Column:
    """An array without its elements at some places (ascending, from 0): the
    slices between them."""
    starts = F.concat(F.array(F.lit(0)), F.transform(places, lambda p: p + 1))
    ends = F.concat(places, F.array(F.size(lines)))
    return let(ends, lambda e: F.flatten(F.transform(starts, lambda s, i: F.slice(
        lines, s + 1, F.get(e, i) - s))))


def make_run(lines: DataFrame) -> DataFrame:
    """One batch's run: a row per line hash."""
    return lines.groupBy("a", "b").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("keeper"))


def merge_runs(runs: list[DataFrame]) -> DataFrame:
    """Merge runs (compaction): bucketed ones by a merge join without exchange."""
    def merge(left: DataFrame, right: DataFrame) -> DataFrame:
        l, r = left.alias("l"), right.alias("r")
        both = l.join(r.hint("merge"), ["a", "b"], "full_outer")
        docs = F.coalesce("l.docs", F.lit(0)) + F.coalesce("r.docs", F.lit(0))
        return both.select("a", "b", docs.alias("docs"), F.greatest("l.keeper", "r.keeper").alias("keeper"))

    return reduce(merge, runs)


def store_run(run: DataFrame) -> DataFrame:
    """Write a run bucketed and sorted by hash. Its aggregate deals by the same
    hash, so a task writes whole buckets."""
    return bucketed(run, ["a", "b"])


class Levels:
    """Levelled runs: ``fan_in`` runs of one level become one of the next."""

    def __init__(self, fan_in: int = FAN_IN):
        self.fan_in, self.levels = fan_in, []

    def add(self, run: DataFrame) -> None:
        """Add a stored run (``store_run``)."""
        level = 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fan_in:
                return
            run = store_run(merge_runs(self.levels[level]))
            self.levels[level] = []
            level += 1

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]


def append_batch(levels: Levels, lines: DataFrame) -> DataFrame:
    """Add a batch of document lines (``document_lines``) whose documents the
    runs don't hold yet. Returns (a, b, keeper): the line hashes that no
    earlier batch had, with the batch's largest document id holding each."""
    run = store_run(make_run(lines))
    fresh = run.select("a", "b", "keeper")
    for old in levels.runs():
        fresh = fresh.join(old.select("a", "b").hint("merge"), ["a", "b"], "left_anti")
    fresh = materialize(fresh)
    levels.add(run)
    return fresh


def descending_batches(lines: DataFrame, batches: int) -> list[Column]:
    """Row conditions that cut the lines into ``batches`` parts of about equal
    size by descending id; together they hold every row once."""
    shares = [i / batches for i in range(batches - 1, 0, -1)]
    cuts = lines.agg(F.percentile_approx("doc_id", shares)).first()[0] if shares else []
    cuts = sorted(set(cuts or []), reverse=True)
    doc = F.col("doc_id")
    if not cuts:
        return [F.lit(True)]
    between = [(doc <= high) & (doc > low) for high, low in zip(cuts, cuts[1:], strict=False)]
    return [doc > cuts[0], *between, doc <= cuts[-1]]


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS, batches: int = BATCHES, fan_in: int = FAN_IN,
                carry: list[str] | None = None) -> DataFrame:
    """Return doc_id, text (the input), n_lines, n_dropped, kept_text, and
    ``carry``: a struct of the input columns named in it.

    A key of at least ``min_chars`` code points found in at least ``min_docs``
    documents loses all its lines except in the largest document id holding
    it. Null and empty texts are one empty line, which is never dropped.
    Rows that repeat an id count as one document and get the same keeper;
    rows with a null id keep all their lines and count for no other row.
    Ids must be integers.
    """
    carried = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("string")
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       carried.alias("carry"))
    named = base.where(F.col("doc_id").isNotNull())
    lines = materialize(document_lines(named, min_chars))
    levels, keepers = Levels(fan_in), []
    for part in descending_batches(lines, batches):
        keepers.append(append_batch(levels, lines.where(part)))
    common = merge_runs(levels.runs()).where(F.col("docs") >= min_docs).select("a", "b")
    common = materialize(common.join(reduce(DataFrame.unionByName, keepers).select("a", "b", "keeper"), ["a", "b"]))
    marked = placed_lines(named, min_chars).join(common, ["a", "b"]).where(F.col("doc_id") != F.col("keeper"))
    # bounded by the lines of one document; rows that repeat a document and its text mark the same places
    drops = marked.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.array_sort(F.array_distinct(F.collect_list("place"))).alias("_drops"))
    joined = base.join(drops, (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left")
    lines_of = text_lines(F.col("text"))
    kept = F.when(F.col("_drops").isNull(), lines_of).otherwise(let(
        lines_of, lambda own: without_places(own, F.col("_drops"))))
    counted = joined.select("doc_id", "text", "carry", F.size(lines_of).cast("long").alias("n_lines"),
                            kept.alias("_kept"))
    return counted.select("doc_id", "text", "n_lines", (F.col("n_lines") - F.size("_kept")).alias("n_dropped"),
                          F.array_join("_kept", "\n").alias("kept_text"), *(["carry"] if carry else []))
