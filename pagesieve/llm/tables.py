"""Reading and shaping helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesieve.session import ensure_checkpoint_dir, materialize, scratch_path

__all__ = ["bucketed", "ensure_checkpoint_dir", "id_text", "materialize", "read", "scratch_path", "small_batches"]


BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Send at most BATCH_ROWS rows at once to Python workers: in a session of
    many stages the buffers of earlier ones live on in workers and executors."""
    if int(spark.conf.get(BATCH_CONF)) > BATCH_ROWS:
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names: other columns of the input
    (whatever their names) never reach an operator."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def bucketed(df: DataFrame, cols: list[str]) -> DataFrame:
    """``materialize`` as a table bucketed and sorted by ``cols``, with as many
    buckets as the session has shuffle partitions: joins of such tables on
    these columns need no exchange."""
    spark = df.sparkSession
    name, path = f"pagesieve_{uuid.uuid4().hex}", scratch_path(spark, "tables")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("path", path).bucketBy(buckets, *cols).sortBy(*cols).format("parquet").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the catalogue's entry: files and the DataFrame stay
    return table
