"""Source policy with a table of patterns of any length.

``policy`` folds a short fixed list into an expression. For a table, the distinct
patterns are dealt into blocks of bounded size; each block is built into an
automaton by a task of its own and written to the shared folder. A scan takes
the rows in groups of bounded size, loads one block after the other and walks
every text once per block, whatever the number of patterns in it. A row leaves with
all its hits; there is never a row per (text, pattern).
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve.operators.policy import policy_text
from pagesieve.session import scratch_path

BLOCK_CHARS = 4_000_000  # characters of patterns in an automaton
GROUP_BYTES = 16 << 20  # rows held while the blocks pass
HITS = "_hits"


def build_automata(patterns: DataFrame, pattern: str = "pattern", block_chars: int = BLOCK_CHARS) -> list[str]:
    """Write the automata of a pattern table and return their files. Null and
    empty patterns are left out, equal ones count once."""
    spark = patterns.sparkSession
    folder = scratch_path(spark, "automata")
    own = patterns.select(F.col(pattern).cast("string").alias("p")).where("p <> ''").distinct()
    total = own.agg(F.sum(F.length("p"))).first()[0] or 0
    blocks = -(-total // block_chars)
    if not blocks:
        return []

    def build(block: pa.Table) -> pa.Table:
        automaton = ahocorasick.Automaton()
        for p in block["p"].to_pylist():
            automaton.add_word(p, p)
        automaton.make_automaton()
        path = f"{folder}/{uuid.uuid4().hex}"
        system, root = fs.FileSystem.from_uri(path)
        system.create_dir(root.rpartition("/")[0], recursive=True)
        with system.open_output_stream(root) as sink:
            sink.write(pickle.dumps(automaton))
        return pa.table({"path": [path]})

    dealt = own.withColumn("block", F.pmod(F.xxhash64("p"), F.lit(blocks)))
    # a block's group is bounded by its share of the characters
    return sorted(r[0] for r in dealt.groupBy("block").applyInArrow(build, "path string").collect())


def find_patterns(df: DataFrame, cols, automata: list[str], group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``df`` with ``_hits``: the sorted patterns that occur in the lower-case
    text of its columns ``cols`` (absent columns and nulls count as empty)."""
    present = [c for c in cols if c in df.columns]
    names = df.columns
    rows = df.withColumn("_text", policy_text(present))
    schema = T.StructType([*df.schema.fields, T.StructField(HITS, T.ArrayType(T.StringType()))])

    def load(path: str):
        system, root = fs.FileSystem.from_uri(path)
        with system.open_input_file(root) as source:
            return pickle.loads(source.read())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, automaton = None, None  # one block at a time

        def scanned(group: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal held, automaton
            texts = [b.column(len(names)).to_pylist() for b in group]
            hits = [[set() for _ in own] for own in texts]
            for path in automata:
                if held != path:
                    automaton = None
                    held, automaton = path, load(path)
                for own, found in zip(texts, hits, strict=True):
                    for text, into in zip(own, found, strict=True):
                        into.update(p for _, p in automaton.iter(text))
            for batch, found in zip(group, hits, strict=True):
                column = pa.array([sorted(x) for x in found], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], column], names=[*names, HITS])

        group, size = [], 0
        for batch in batches:
            group.append(batch)
            size += batch.nbytes
            if size >= group_bytes:
                yield from scanned(group)
                group, size = [], 0
        if group:
            yield from scanned(group)

    return rows.mapInArrow(scan, schema)


def apply_table(df: DataFrame, cols, patterns: DataFrame, pattern: str = "pattern") -> DataFrame:
    """The rows whose policy text holds no pattern of the table."""
    return find_patterns(df, cols, build_automata(patterns, pattern)).where(F.size(HITS) == 0).drop(HITS)


def audit_table(df: DataFrame, cols, patterns: DataFrame, pattern: str = "pattern") -> DataFrame:
    """The banned rows with ``patterns``, the sorted array of all that hit them."""
    found = find_patterns(df, cols, build_automata(patterns, pattern))
    return found.where(F.size(HITS) > 0).withColumnRenamed(HITS, "patterns")
