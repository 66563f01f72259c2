"""A stored search index that is kept up to date: append, replace, drop, search.

Storage is a folder of *segments*. A segment is written once and never changed:
  postings (term, part, keys..., tf, doc_len): a table bucketed by (term, part),
    in whose buckets equal (term, part) lie together; ``part`` is a hash of the
    document, so a frequent term lies in several buckets
  docs (keys..., doc_len, tags...): a row per document
Documents are dropped by a *delete list*: (keys..., upto) hides the rows of that
document in segments up to number ``upto``; a later segment may hold it again,
so an append of a known document replaces it. ``fan_in`` segments of a level are
merged into one of the next, without the rows that the delete list hides. What
belongs to the index is named by one version file (``versions``), with the number
and total length of the live documents.

A search writes the question's terms as a table bucketed like the segments, so
the joins of terms need no exchange on either side; only postings of those terms
move on, and the delete list is applied to them.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesieve import constants as K
from pagesieve.operators import versions
from pagesieve.operators.retrieval import (
    count_terms,
    question_terms,
    rank_documents,
    terms,
    weighted_postings,
)
from pagesieve.session import materialize, scratch_path

PARTS = 8
FAN_IN = 4
#: rows of a delete list that are sent to all tasks; a longer one is joined by a shuffle
HIDDEN_SENT = 1 << 20


class IndexStore:
    """A stored index under ``root``, new or existing. ``keys`` name a document;
    ``tags`` are further columns kept per document (such as its corpus).
    ``buckets`` and ``parts`` are fixed when an index is made."""

    def __init__(self, spark: SparkSession, root: str, keys, tags=(), buckets: int | None = None,
                 parts: int = PARTS, fan_in: int = FAN_IN):
        self.spark, self.root, self.keys, self.tags, self.fan_in = spark, root.rstrip("/"), list(keys), list(tags), fan_in
        self.number, state = versions.current(spark, self.root)
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.state = state or {"buckets": buckets, "parts": parts, "segments": [], "deletes": [], "last": 0,
                               "n_docs": 0, "total_len": 0}
        self.tables: dict[str, str] = {}  # path -> name in this session's catalogue

    # -- storage ----------------------------------------------------------

    def _commit(self, **changes) -> None:
        state = {**self.state, **changes}
        self.number = versions.commit(self.spark, self.root, self.number, state)
        self.state = state

    def _part(self, keys: list[str]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.state["parts"])).cast("int")

    def _write_bucketed(self, df: DataFrame, path: str) -> str:
        name = f"pagesieve_{uuid.uuid4().hex}"
        n = self.state["buckets"]
        # in the order of one number, which takes no comparisons of terms: sortBy would work out the bucket of both rows
        # in each. Counting the rows keeps the order from being left out as that of a table without one
        rows = df.repartition(n, "term", "part").sortWithinPartitions(F.xxhash64("term", "part")).observe(
            name, F.count(F.lit(1)).alias("rows"))
        rows.write.option("path", path).bucketBy(n, "term", "part").format("parquet").saveAsTable(name)
        self.tables[path] = name
        return name

    def _postings(self, segment: dict) -> DataFrame:
        path = f"{self.root}/{segment['id']}/postings"
        if path not in self.tables:  # of another session: the files are there, the catalogue entry is not
            name = f"pagesieve_{uuid.uuid4().hex}"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                                for f in self.spark.read.parquet(path).schema.fields)
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (term, part) "
                           f"INTO {self.state['buckets']} BUCKETS LOCATION '{path}'")
            self.tables[path] = name
        return self.spark.table(self.tables[path])

    def _docs(self, segment: dict) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{segment['id']}/docs").withColumn("seq", F.lit(segment["seq"]))

    def close(self) -> None:
        """Take the tables out of the session's catalogue; the files stay."""
        for name in self.tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables.clear()

    def _hidden(self) -> DataFrame | None:
        """(_keys..., _upto): the delete list, the last entry of a document."""
        if not self.state["deletes"]:
            return None
        rows = self.spark.read.parquet(*[f"{self.root}/{d}" for d in self.state["deletes"]])
        hidden = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in self.keys]).agg(F.max("upto").alias("_upto"))
        return F.broadcast(hidden) if rows.count() <= HIDDEN_SENT else hidden

    def _live(self, rows: DataFrame) -> DataFrame:
        """Rows (keys..., seq, ...) that the delete list does not hide."""
        hidden = self._hidden()
        if hidden is None:
            return rows
        same = F.col("seq") <= F.col("_upto")
        for k in self.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        return rows.join(hidden, same, "left_anti")

    def documents(self) -> DataFrame:
        """(keys..., doc_len, tags...) of the live documents."""
        if not self.state["segments"]:
            raise ValueError(f"the index at {self.root} is empty")
        rows = reduce(DataFrame.unionByName, [self._docs(s) for s in self.state["segments"]])
        return self._live(rows).drop("seq")

    # -- changes ----------------------------------------------------------

    def append(self, docs: DataFrame, text_col: str = "text") -> None:
        """Add documents, one row each; known ones are replaced."""
        cols = [*self.keys, *self.tags]
        tokens = docs.select(*cols, terms(text_col).alias("_t"))
        seq = self.state["last"] + 1
        folder = f"segment-{seq:06d}-{uuid.uuid4().hex}"
        own = tokens.select(*cols, F.coalesce(F.size("_t"), F.lit(0)).alias("doc_len"))
        own.write.parquet(f"{self.root}/{folder}/docs")
        own = self.spark.read.parquet(f"{self.root}/{folder}/docs")
        n, total = own.agg(F.count(F.lit(1)), F.coalesce(F.sum("doc_len"), F.lit(0))).first()
        if not n:
            return
        changes = self._hide(own.select(*self.keys)) if self.state["segments"] else {}
        each = count_terms(tokens, self.keys)
        self._write_bucketed(each.select("term", self._part(self.keys).alias("part"), *self.keys, "tf", "doc_len"),
                             f"{self.root}/{folder}/postings")
        base = {**self.state, **changes}
        self._commit(**{**changes, "last": seq, "n_docs": base["n_docs"] + n, "total_len": base["total_len"] + total,
                        "segments": [*base["segments"], {"id": folder, "seq": seq, "level": 0}]})
        self._merge_levels()

    def _hide(self, keys: DataFrame) -> dict:
        """Write the entries that hide the live ones of these documents, and
        return what changes in the state; nothing is hidden before a commit."""
        named = keys.select(*[F.col(k).alias(f"_{k}") for k in self.keys]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys])
        hit = materialize(self.documents().join(named, same, "left_semi").select(*self.keys, "doc_len"))
        n, total = hit.agg(F.count(F.lit(1)), F.coalesce(F.sum("doc_len"), F.lit(0))).first()
        if not n:
            return {}
        folder = f"deletes-{uuid.uuid4().hex}"
        hit.select(*self.keys).distinct().withColumn("upto", F.lit(self.state["last"])).write.parquet(
            f"{self.root}/{folder}")
        return {"deletes": [*self.state["deletes"], folder], "n_docs": self.state["n_docs"] - n,
                "total_len": self.state["total_len"] - total}

    def drop(self, keys: DataFrame) -> int:
        """Remove documents by their keys; returns how many there were."""
        if not self.state["segments"] or not (changes := self._hide(keys)):
            return 0
        before = self.state["n_docs"]
        self._commit(**changes)
        return before - self.state["n_docs"]

    def drop_where(self, tag: str, names: DataFrame) -> int:
        """Remove the documents whose tag is in a one-column DataFrame."""
        if not self.state["segments"]:
            return 0
        named = names.select(F.col(names.columns[0]).alias(tag)).distinct()
        return self.drop(self.documents().join(named, tag, "left_semi").select(*self.keys))

    def _merge_levels(self) -> None:
        level = 0
        while len(own := [s for s in self.state["segments"] if s["level"] == level]) >= self.fan_in:
            self._merge(own, level + 1)
            level += 1

    def compact(self) -> None:
        """Merge all segments into one and empty the delete list."""
        if self.state["segments"]:
            self._merge(self.state["segments"], max(s["level"] for s in self.state["segments"]))
            self._commit(deletes=[])

    def _merge(self, segments: list[dict], level: int) -> None:
        """Replace segments by one without what is hidden."""
        seq = max(s["seq"] for s in segments)
        folder = f"segment-{seq:06d}-{uuid.uuid4().hex}"
        docs = reduce(DataFrame.unionByName, [self._docs(s) for s in segments])
        self._live(docs).drop("seq").write.parquet(f"{self.root}/{folder}/docs")
        rows = [self._postings(s).withColumn("seq", F.lit(s["seq"])) for s in segments]
        self._write_bucketed(self._live(reduce(DataFrame.unionByName, rows)).drop("seq"), f"{self.root}/{folder}/postings")
        gone = {s["id"] for s in segments}
        rest = [s for s in self.state["segments"] if s["id"] not in gone]
        self._commit(segments=sorted([*rest, {"id": folder, "seq": seq, "level": level}], key=lambda s: s["seq"]))

    # -- search -----------------------------------------------------------

    def found_postings(self, vocabulary: DataFrame) -> DataFrame:
        """(keys..., term, tf, doc_len) of the live postings of some terms."""
        parts = F.explode(F.sequence(F.lit(0), F.lit(self.state["parts"] - 1))).alias("part")
        path = scratch_path(self.spark, "vocabulary")
        name = self._write_bucketed(vocabulary.select("term").distinct().select("term", parts), path)
        wanted = self.spark.table(name).hint("shuffle_hash")
        found = [self._postings(s).join(wanted, ["term", "part"], "left_semi").withColumn("seq", F.lit(s["seq"]))
                 for s in self.state["segments"]]
        return self._live(reduce(DataFrame.unionByName, found)).select(*self.keys, "term", "tf", "doc_len")

    def search(self, questions: DataFrame, qkey: str, qtext: str, k: int = 5, k1: float = K.BM25_K1,
               b: float = K.BM25_B, decimals: int = 6) -> DataFrame:
        """Top ``k`` live documents per question, as ``retrieval.search``."""
        qterms = question_terms(questions, qkey, qtext)
        found = materialize(self.found_postings(qterms))
        post = weighted_postings(found, self.state["n_docs"], self.state["total_len"], k1, b)
        return rank_documents(post, self.keys, qterms, qkey, k, decimals)
