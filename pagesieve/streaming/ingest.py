"""Incremental ingest of arriving page files into a corpus table.

``readStream`` tracks which files were already processed (checkpoint =
exactly-once file bookkeeping); each micro-batch is deduplicated on
(url, sha256(html)) and left-anti joined against the keys already in the
corpus, so a replayed batch, or a page crawled again unchanged, adds nothing.
Only changed or new pages are converted and appended. The corpus is written
partitioned by a hash bucket of the corpus, and a batch reads the keys of its
own buckets only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve.operators.convert import content_column, convert_pages
from pagesieve.operators.corpus import corpus_bucket
from pagesieve.session import ensure_checkpoint_dir, scratch_path
from pagesieve.sources.tables import PAGES_SCHEMA, host_of

CORPUS_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("content_sha256", T.StringType()),
    T.StructField("doc_name", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("title_source", T.StringType()),
    T.StructField("content_field", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("document", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    T.StructField("n_bytes", T.LongType()),
    T.StructField("corpus", T.StringType()),
    T.StructField("bucket", T.IntegerType()),
])


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether the corpus table has been written already. Any other trouble
    with the path is raised: a batch must not skip its duplicates' check."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath) and len(fs.listStatus(hpath)) > 0)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CORPUS_SCHEMA).parquet(path)


def known_keys(spark: SparkSession, corpus_path: str, buckets: list[int]) -> DataFrame:
    """(url, content_sha256) of the stored documents of some buckets: a filter
    on the partition column, so other buckets' files are not listed or read."""
    return read_corpus(spark, corpus_path).where(F.col("bucket").isin(buckets)).select("url", "content_sha256")


def ingest_batch(batch: DataFrame, corpus_path: str, as_of) -> None:
    """Append the new or changed pages of one batch to the corpus. Of equal
    pages the smallest page_id is added."""
    spark = batch.sparkSession
    # hash the content the document will be built from (any content field), and name a missing URL as it is stored
    named = F.coalesce(F.col("url"), F.concat(F.lit("unknown-"), F.col("page_id").cast("string")))
    pages = (batch.withColumn("content_sha256", F.sha2(content_column(batch), 256)).withColumn("_key", named)
             .filter(F.col("content_sha256").isNotNull()))
    first = Window.partitionBy("_key", "content_sha256").orderBy("page_id")
    pages = pages.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")
    if _exists(spark, corpus_path):
        buckets = [r[0] for r in batch.select(corpus_bucket(host_of("url")).alias("b")).distinct().collect()]
        known = known_keys(spark, corpus_path, buckets).withColumnRenamed("url", "_key")
        pages = pages.join(known, ["_key", "content_sha256"], "left_anti")
    docs = convert_pages(pages.drop("_key"), as_of, keep=("content_sha256",))
    docs = docs.withColumn("bucket", corpus_bucket("corpus"))
    out = docs.select(*[f.name for f in CORPUS_SCHEMA.fields]).hint("rebalance", "bucket")
    out.write.mode("append").partitionBy("bucket").parquet(corpus_path)


def stream_pages(spark: SparkSession, source_dir: str, corpus_path: str, as_of, checkpoint: str | None = None,
                 glob: str = "*.parquet", max_files_per_trigger: int | None = None, fmt: str = "parquet",
                 schema: T.StructType = PAGES_SCHEMA):
    """Start the ingest stream over ``source_dir`` and return the query handle
    (``trigger(availableNow=True)``: process what is there, then stop).
    ``fmt``/``schema`` read other item files, e.g. JSON scraped items whose
    content sits in any of several fields (``ITEMS_SCHEMA``)."""
    if checkpoint is None:
        checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pagesieve-stream/{uuid.uuid4().hex}"
    reader = spark.readStream.schema(schema).format(fmt).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    return (stream.writeStream.foreachBatch(lambda df, _epoch: ingest_batch(df, corpus_path, as_of))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def table_files(path: str) -> str:
    """A source of ``stream_pages`` for a table that is one file or a folder of
    files: a glob that only its own path matches, since a stream takes no path
    of a single file."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/[{name[0]}]{name[1:]}"


def run_ingest(spark: SparkSession, source_dir: str, as_of, glob: str = "*.parquet",
               corpus_path: str | None = None) -> DataFrame:
    """Run the stream to completion and return the corpus it wrote."""
    base = scratch_path(spark, "ingest")
    corpus_path = corpus_path or f"{base}/corpus"
    q = stream_pages(spark, source_dir, corpus_path, as_of, f"{base}/checkpoint", glob)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_corpus(spark, corpus_path)
