"""Corpus figures kept from changes: files, bytes and first files per corpus.

An append or a drop changes the figures of the corpora it touches and reads nothing of
the others:

  * counts and bytes are added and taken back (aggregates that combine before the
    shuffle, a row per task and corpus);
  * a corpus keeps its first ``FIRST`` files. New files are merged into them. When one
    of them goes and the corpus has more files than it keeps, they are taken anew from
    the stored file rows of that corpus;
  * file rows, delete lists and figures lie in folders by bucket of the corpus, so a
    change reads the buckets it touches (partition filter), and of figures it writes
    these buckets only.

Deleted and replaced files are hidden by delete lists: (corpus, ord, upto) hides the
file's rows up to a version, (corpus, upto) all rows of a corpus. Every change is one
new version (``versions``), so a lost writer leaves the figures as they were.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagesieve import constants as K
from pagesieve.operators import corpus as CO
from pagesieve.operators import versions
from pagesieve.session import materialize
from pagesieve.sources.tables import NO_HOST

FIRST = K.MANIFEST_FIRST_FILES
_PLACE = ", batch string, bucket int"
SCHEMAS = {
    "files": "corpus string, ord long, name string, size long, seq long" + _PLACE,
    "drops": "corpus string, ord long, upto long" + _PLACE,
    "whole": "corpus string, upto long" + _PLACE,
    "figures": "corpus string, files long, bytes long, first array<struct<ord:long,name:string,size:long>>" + _PLACE,
}


def entry() -> Column:
    return F.struct("ord", "name", "size").alias("entry")


def first_entries(entries: DataFrame) -> DataFrame:
    """(corpus, first): the ``FIRST`` entries of smallest ord per corpus, in order. The
    limit trims each task's rows before the shuffle."""
    order = Window.partitionBy("corpus").orderBy("entry")
    top = entries.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= FIRST)
    return top.groupBy("corpus").agg(F.array_sort(F.collect_list("entry")).alias("first"))


def _corpus(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(NO_HOST)).alias("corpus")


class CorpusFigures:
    """Figures of corpora under ``root``; every method works on the newest version.

    A file is named by (corpus, ord), which must be given; a null corpus is one corpus of
    its own. A file that is appended again replaces the one before; of rows of one append
    that name the same file, the one of smallest (name, size) counts. Null sizes are 0.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _state(self) -> tuple[int, dict]:
        number, state = versions.current(self.spark, self.root)
        return number, state or {"files": [], "drops": [], "whole": [], "figures": {}}

    def _read(self, kind: str, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], SCHEMAS[kind])
        base = f"{self.root}/{kind}"
        return self.spark.read.schema(SCHEMAS[kind]).option("basePath", base).parquet(
            *[f"{base}/{f}" for f in folders])

    def _write(self, kind: str, rows: DataFrame) -> str:
        folder = f"batch={uuid.uuid4().hex}"
        rows.withColumn("bucket", CO.corpus_bucket("corpus")).hint("rebalance", "bucket").write.partitionBy(
            "bucket").parquet(f"{self.root}/{kind}/{folder}")
        return folder

    def _figures(self, state: dict, buckets: list[int] | None = None) -> DataFrame:
        held = state["figures"]
        wanted = held if buckets is None else [b for b in map(str, buckets) if b in held]
        return self._read("figures", [f"{held[b]}/bucket={b}" for b in wanted]).select(
            "corpus", "files", "bytes", "first")

    def _live(self, state: dict, buckets: list[int]) -> DataFrame:
        """(corpus, ord, name, size): the file rows of some buckets that are not hidden."""
        def of(kind):
            return self._read(kind, state[kind]).where(F.col("bucket").isin(buckets))

        gone = of("drops").groupBy("corpus", "ord").agg(F.max("upto").alias("_file"))
        all_gone = of("whole").groupBy("corpus").agg(F.max("upto").alias("_corpus"))
        rows = of("files").join(gone, ["corpus", "ord"], "left").join(all_gone, "corpus", "left")
        upto = F.greatest(F.coalesce("_file", F.lit(0)), F.coalesce("_corpus", F.lit(0)))
        return rows.where(F.col("seq") > upto).select("corpus", "ord", "name", "size")

    def _commit(self, number: int, state: dict, buckets: list[int], figures: DataFrame, **more: str) -> None:
        folder = self._write("figures", figures)
        written = {str(r[0]) for r in self._read("figures", [folder]).select("bucket").distinct().collect()}
        kept = {b: f for b, f in state["figures"].items() if int(b) not in buckets}
        lists = {kind: [*state[kind], *([more[kind]] if kind in more else [])] for kind in ("files", "drops", "whole")}
        versions.commit(self.spark, self.root, number, {**lists, "figures": {**kept, **dict.fromkeys(written, folder)}})

    def _change(self, keys: DataFrame, added: DataFrame) -> int:
        """Take away the files named by ``keys``, then add the rows ``added``, all of
        which ``keys`` names. Returns the number of files taken away."""
        number, state = self._state()
        buckets = [r[0] for r in keys.select(CO.corpus_bucket("corpus")).distinct().collect()]  # CO.BUCKETS at most
        named = ["corpus", "ord"]
        gone = materialize(self._live(state, buckets).join(keys, named, "left_semi"))
        old = materialize(self._figures(state, buckets))
        changes = gone.select("corpus", F.lit(-1).alias("files"), (-F.col("size")).alias("bytes")).unionAll(
            added.select("corpus", F.lit(1), "size"))
        sums = old.select("corpus", "files", "bytes").unionAll(changes).groupBy("corpus").agg(
            F.sum("files").alias("files"), F.sum("bytes").alias("bytes")).where("files > 0")

        heads = old.select("corpus", "files", F.size("first").alias("n"), F.explode("first").alias("entry"))
        heads = heads.withColumn("ord", F.col("entry.ord"))
        lost = heads.where("files > n").join(gone.select(*named), named, "left_semi")
        refilled = materialize(lost.select("corpus").distinct())
        kept = heads.join(refilled, "corpus", "left_anti").join(gone.select(*named), named, "left_anti")
        stored = self._live(state, buckets).join(refilled, "corpus", "left_semi").join(keys, named, "left_anti")
        firsts = first_entries(kept.select("corpus", "entry").unionAll(stored.select("corpus", entry())).unionAll(
            added.select("corpus", entry())))
        self._commit(number, state, buckets, sums.join(firsts, "corpus"),
                     files=self._write("files", added.withColumn("seq", F.lit(number + 1).cast("long"))),
                     drops=self._write("drops", gone.select(*named, F.lit(number).cast("long").alias("upto"))))
        return gone.count()

    def append(self, files: DataFrame, corpus: str = "corpus", order: str = "ord", name: str = "name",
               size: str = "size") -> int:
        """Add files, or replace those that are there. Returns the number replaced."""
        rows = files.select(_corpus(corpus), F.col(order).cast("long").alias("ord"), F.struct(
            F.col(name).alias("name"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size")).alias("file"))
        rows = rows.groupBy("corpus", "ord").agg(F.min("file").alias("file"))
        added = materialize(rows.select("corpus", "ord", "file.name", "file.size"))
        return self._change(added.select("corpus", "ord"), added)

    def drop(self, keys: DataFrame, corpus: str = "corpus", order: str = "ord") -> int:
        """Take files away, named by (corpus, ord). Returns how many were there."""
        named = materialize(keys.select(_corpus(corpus), F.col(order).cast("long").alias("ord")).distinct())
        none = self.spark.createDataFrame([], "corpus string, ord long, name string, size long")
        return self._change(named, none)

    def drop_corpora(self, names: DataFrame) -> int:
        """Take away whole corpora; no file row is read. Returns how many were there."""
        number, state = self._state()
        named = names.select(_corpus(names.columns[0])).distinct().withColumn("bucket", CO.corpus_bucket("corpus"))
        named = materialize(named)
        buckets = [r[0] for r in named.select("bucket").distinct().collect()]  # CO.BUCKETS at most
        old = self._figures(state, buckets)
        removed = old.join(named, "corpus", "left_semi").count()
        self._commit(number, state, buckets, old.join(named, "corpus", "left_anti"),
                     whole=self._write("whole", named.select("corpus", F.lit(number).cast("long").alias("upto"))))
        return removed

    def figures(self) -> DataFrame:
        """(corpus, files, bytes, first): a row per corpus that has files."""
        return self._figures(self._state()[1])

    def summary(self, as_of) -> DataFrame:
        """The rows of ``corpus.corpus_summary``."""
        def record(e: Column) -> Column:
            return CO.file_record(F.col("corpus"), e["name"], e["size"], as_of)

        return CO.summary_rows(self.figures().select(
            "corpus", "files", F.col("bytes").alias("total_size_bytes"),
            F.transform("first", record).alias("uploaded_files")), as_of, "corpus")
