"""Readers for the page/document tables and builders for the fixed tables.

Readers pass an explicit schema so that a missing optional field reads as
null instead of failing, and so that Parquet column pruning and filter
pushdown apply (only the referenced columns are read).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve import constants as K

PAGES_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

# A scraped item as different scrapers emit it: content may sit in any of
# several fields, including a nested crawl.html.
ITEMS_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("markdown", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("crawl", T.StructType([T.StructField("html", T.StringType())])),
])

DOCUMENTS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


#: the corpus of pages whose URL names no host
NO_HOST = "no-host"
#: session setting for ``spread``
PARTITIONS_CONF = "spark.pagesieve.partitions"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan a page dataset (url + html) with a fixed nullable schema."""
    return spark.read.schema(PAGES_SCHEMA).format(fmt).load(path)


def read_items(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Scan scraped items whose content may sit in any of several fields."""
    return spark.read.schema(ITEMS_SCHEMA).format(fmt).load(path)


def spread(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Hash-spread rows on ``key`` over ``partitions`` tasks, only when the
    caller asks for it (or the session does, by
    ``spark.pagesieve.partitions``): for
    inputs in fewer splits than the cluster has cores, such as a file of one
    row group. By default a scan keeps its own splits."""
    if partitions is None:
        partitions = int(df.sparkSession.conf.get(PARTITIONS_CONF, "0"))
    return df.repartition(partitions, key) if partitions and not df.isStreaming else df


def dealt(table: DataFrame, key: str) -> DataFrame:
    """The rows of a stored table; of one in fewer files than the cluster has
    cores dealt out by ``key``, since a row group is read by one task however
    large it is. Adaptive execution chooses the number of tasks."""
    few = len(table.inputFiles()) < table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(key) if few else table


# --------------------------------------------------------------------------
# Fixed tables (constant size, safe to broadcast)
# --------------------------------------------------------------------------

CATALOGUE_SCHEMA = T.StructType([
    T.StructField("ord", T.IntegerType()),
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("username", T.StringType()),
    T.StructField("pricing_model", T.StringType()),
    T.StructField("success_rate", T.DoubleType()),
    T.StructField("monthly_users", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("best_for", T.ArrayType(T.StringType())),
    T.StructField("output_format", T.StringType()),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("speed", T.StringType()),
    T.StructField("cost", T.StringType()),
    T.StructField("supports_files", T.BooleanType()),
    T.StructField("stats", T.StructType([T.StructField("runs", T.StructType([
        T.StructField("total", T.LongType()), T.StructField("finished", T.LongType()),
        T.StructField("failed", T.LongType())]))])),
    T.StructField("description", T.StringType()),
])


def _literal(value, dtype: T.DataType) -> F.Column:
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.StructType):
        return F.struct(*[_literal(v, f.dataType).alias(f.name) for v, f in zip(value, dtype.fields)])
    if isinstance(dtype, T.ArrayType):
        return F.array(*[_literal(v, dtype.elementType) for v in value]).cast(dtype)
    return F.lit(value).cast(dtype)


def local_table(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A small constant table built from literals (a JVM-local relation: no
    Python worker, no RDD), safe to broadcast."""
    structs = [_literal(r, schema) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs))) if structs else spark.createDataFrame([], schema)


def catalogue(spark: SparkSession) -> DataFrame:
    """The source catalogue: official list followed by the community list."""
    rows = [(*r[:15], ((r[15], r[16], r[17]),), None) for r in K.CATALOGUE]
    official = local_table(spark, rows[:K.OFFICIAL_COUNT], CATALOGUE_SCHEMA)
    community = local_table(spark, rows[K.OFFICIAL_COUNT:], CATALOGUE_SCHEMA)
    return official.unionByName(community)


def host_of(url_col) -> F.Column:
    """The corpus key of a page, never null or empty: the host of its URL
    (lower case, no port); of a URL without a scheme its first path part; for
    a missing URL, or one that names neither, a fixed name."""
    c = F.col(url_col) if isinstance(url_col, str) else url_col
    host = F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#:]*)", 1)
    first = F.regexp_extract(c, r"^([^/?#:]+)", 1)
    named = F.when(c.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//"), host).otherwise(first)
    return F.coalesce(F.nullif(F.lower(named), F.lit("")), F.lit(NO_HOST))
