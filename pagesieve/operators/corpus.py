"""Corpus bookkeeping: manifests, summaries, costs, run records, appends.

All aggregates are sums and counts (partial aggregation before the shuffle).
Money is computed in exact decimals and rounded once at the end, then
returned as double.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagesieve import constants as K
from pagesieve.operators.convert import as_of_iso
from pagesieve.session import materialize
from pagesieve.sources.tables import NO_HOST


def _dec(x: float, scale: int = 6) -> Column:
    return F.lit(Decimal(str(x))).cast(f"decimal(18,{scale})")


def content_hash(col) -> Column:
    return F.sha2(F.col(col) if isinstance(col, str) else col, 256)


# --------------------------------------------------------------------------
# Costs
# --------------------------------------------------------------------------

def indexing_cost_chars(docs: DataFrame, text_col: str = "text", by=()) -> DataFrame:
    """Character form: sum over files of len // 5; cost = tokens / 1e6 * 0.15 (unrounded)."""
    tokens = F.sum(F.floor(F.length(F.col(text_col)) / K.CHARS_PER_TOKEN)).cast("long")
    agg = docs.groupBy(*by).agg(F.count(F.lit(1)).alias("files"), tokens.alias("total_tokens"))
    return agg.withColumn("cost_usd", F.col("total_tokens") / 1e6 * K.INDEXING_PRICE_PER_MILLION_TOKENS)


def indexing_cost_bytes(docs: DataFrame, text_col: str = "text", by=()) -> DataFrame:
    """Byte form: (sum of bytes) // 5; cost rounded to 4 places."""
    agg = docs.groupBy(*by).agg(F.count(F.lit(1)).alias("files"),
                                F.sum(F.octet_length(F.col(text_col))).cast("long").alias("total_size_bytes"))
    return with_byte_cost(agg)


def with_byte_cost(sizes: DataFrame) -> DataFrame:
    """Tokens and cost of ``total_size_bytes``."""
    tokens = F.floor(F.col("total_size_bytes") / K.CHARS_PER_TOKEN).cast("long")
    return (sizes.withColumn("estimated_tokens", tokens)
            .withColumn("cost_estimate_usd",
                        F.round(F.col("estimated_tokens") / 1e6 * K.INDEXING_PRICE_PER_MILLION_TOKENS, 4)))


def page_charge_exact(pages_col: Column) -> Column:
    """start fee + pages * price, unrounded, in doubles."""
    return F.lit(K.START_FEE) + pages_col.cast("double") * F.lit(K.PRICE_PER_PAGE)


def page_charge(pages_col: Column, discount: Column | None = None, decimals: int = 2) -> Column:
    """round(start fee + pages * price * (1 - discount), decimals) in exact decimals."""
    price = _dec(K.PRICE_PER_PAGE)
    if discount is not None:
        price = price * (F.lit(1).cast("decimal(18,6)") - discount.cast("decimal(18,6)"))
    return F.round(_dec(K.START_FEE) + pages_col.cast("decimal(18,0)") * price, decimals).cast("double")


def page_pricing(counts: DataFrame, pages_col: str = "pages_processed") -> DataFrame:
    """Per-page charge; counts every scraped row, skipped ones included."""
    return (counts.withColumn("price_per_page", F.lit(K.PRICE_PER_PAGE))
            .withColumn("start_fee", F.lit(K.START_FEE))
            .withColumn("estimated_total", page_charge(F.col(pages_col)))
            .withColumn("estimated_total_unrounded", page_charge_exact(F.col(pages_col))))


def tier_pricing(counts: DataFrame, pages_col: str = "pages_processed") -> DataFrame:
    """Charge under each plan discount tier (discount on the page price only)."""
    tiers = F.array(*[F.struct(F.lit(p).alias("plan"), F.lit(d).alias("discount")) for p, d in K.PRICE_TIERS])
    t = counts.withColumn("_t", F.explode(tiers)).select("*", "_t.plan", "_t.discount").drop("_t")
    per_page = (_dec(K.PRICE_PER_PAGE) * (F.lit(1).cast("decimal(18,6)") - F.col("discount").cast("decimal(18,6)")))
    return (t.withColumn("price_per_page", per_page.cast("double"))
            .withColumn("estimated_total", page_charge(F.col(pages_col), F.col("discount"), 4)))


def total_cost(counts: DataFrame, index_cost: Column, pages_col: str = "pages_processed") -> DataFrame:
    """actor fee (by tier) + scraper cost (pages/100 x rate by budget) + indexing cost."""
    tiers = tier_pricing(counts, pages_col)
    modes = F.array(*[F.struct(F.lit(b).alias("budget"), F.lit(c).alias("rate")) for b, c in K.SCRAPER_COST_PER_100_PAGES])
    t = tiers.withColumn("_m", F.explode(modes)).select("*", "_m.budget", "_m.rate").drop("_m")
    scraper = F.round(F.col(pages_col).cast("decimal(18,0)") / 100 * F.col("rate").cast("decimal(18,6)"), 4)
    return (t.withColumn("scraper_cost", scraper.cast("double"))
            .withColumn("total_usd", F.round(F.col("estimated_total").cast("decimal(18,6)") + scraper
                                             + index_cost.cast("decimal(18,6)"), 4).cast("double")))


def run_counters(items: DataFrame, by: str = "target", content_col: str = "content") -> DataFrame:
    """pages scraped (all items), documents created and files indexed (items with content)."""
    has = F.col(content_col).isNotNull()
    return items.groupBy(by).agg(F.count(F.lit(1)).alias("pages_scraped"),
                                 F.count_if(has).alias("documents_created"),
                                 F.count_if(has).alias("files_indexed"))


# --------------------------------------------------------------------------
# Manifest, corpora
# --------------------------------------------------------------------------

def build_manifest(docs: DataFrame, as_of, corpus: str = "corpus", name: str = "doc_name",
                   document: str = "document") -> DataFrame:
    """Per file: name, path, byte size, import time and the custom metadata map."""
    path = F.concat(F.col(corpus), F.lit("/"), F.col(name))
    size = F.octet_length(F.col(document)).cast("long")
    iso = as_of_iso(as_of)
    return docs.select(
        F.col(corpus).alias("corpus"), F.col(name).alias("name"), path.alias("path"),
        size.alias("size"), iso.alias("imported_at"),
        F.create_map(F.lit("source_path"), path, F.lit("upload_date"), iso,
                     F.lit("file_size"), size.cast("string")).alias("custom_metadata"))


def list_corpora(manifest: DataFrame) -> DataFrame:
    """One row per corpus: name, display name, created time, files, bytes."""
    return manifest.groupBy("corpus").agg(
        F.min("imported_at").alias("created_time"), F.count(F.lit(1)).alias("files"),
        F.sum("size").alias("total_size_bytes")).select(
        F.concat(F.lit("corpora/"), F.col("corpus")).alias("name"),
        F.col("corpus").alias("display_name"), "created_time", "files", "total_size_bytes")


def drop_corpora(df: DataFrame, names: DataFrame, corpus: str = "corpus") -> DataFrame:
    """Remove every row of the named corpora (left anti join on the corpus key)."""
    return df.join(names.select(F.col(names.columns[0]).alias(corpus)).distinct(), corpus, "left_anti")


BUCKETS = 64


def corpus_bucket(corpus: str | Column = "corpus") -> Column:
    """Storage bucket of a corpus: stored corpora are partitioned by it, so
    the number of folders is fixed, however many corpora there are."""
    return F.pmod(F.xxhash64(F.col(corpus) if isinstance(corpus, str) else corpus), F.lit(BUCKETS)).cast("int")


def drop_corpora_on_disk(spark, path: str, names: DataFrame, corpus: str = "corpus") -> int:
    """Remove stored corpora: the buckets that hold any of them are rewritten
    without them (an anti join, so the list may have any length); other
    buckets are not read. Returns the number of corpora removed."""
    stored = spark.read.parquet(path)
    named = names.select(F.col(names.columns[0]).alias(corpus)).distinct()
    hit = named.join(stored.select(corpus).distinct(), corpus, "left_semi")
    hit = materialize(hit.withColumn("bucket", corpus_bucket(corpus)))
    removed = hit.count()
    if not removed:
        return 0
    buckets = [r[0] for r in hit.select("bucket").distinct().collect()]  # BUCKETS at most
    rest = materialize(stored.where(F.col("bucket").isin(buckets)).join(hit.select(corpus), corpus, "left_anti"))
    left = {r[0] for r in rest.select("bucket").distinct().collect()}
    (rest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path))
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for bucket in buckets:
        if bucket not in left:  # an overwrite leaves a bucket alone that got no rows
            fs.delete(jvm.org.apache.hadoop.fs.Path(root, f"bucket={bucket}"), True)
    return removed


def file_record(corpus: Column, name: Column, size: Column, as_of) -> Column:
    """struct(name, path, size, imported_at) of a stored file."""
    return F.struct(name.alias("name"), F.concat(corpus, F.lit("/"), name).alias("path"), size.alias("size"),
                    as_of_iso(as_of).alias("imported_at"))


def first_files(docs: DataFrame, as_of, by: str = "corpus", order: str = "page_id", name: str = "doc_name",
                text_col: str = "document", n: int = K.MANIFEST_FIRST_FILES) -> DataFrame:
    """First n file records per corpus: name, path, size, imported_at. The
    row_number filter becomes a WindowGroupLimit (trimmed per task before the
    shuffle), so only n rows per task and corpus reach the collect."""
    w = Window.partitionBy(by).orderBy(order)
    size = F.octet_length(F.col(text_col)).cast("long")
    top = docs.select(by, order, F.col(name).alias("name"), size.alias("size"))
    top = top.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    record = F.struct(F.col(order).alias("o"), file_record(F.col(by), F.col("name"), F.col("size"), as_of).alias("file"))
    return top.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(record)), lambda s: s["file"])
                               .alias("uploaded_files"))


def corpus_summary(docs: DataFrame, as_of, by: str = "corpus", text_col: str = "document",
                   order: str = "page_id", name: str = "doc_name") -> DataFrame:
    """Corpus metadata: store, files, bytes, tokens, cost, MB, constants, the
    first file records. Rows whose corpus is null are one corpus."""
    docs = docs.withColumn(by, F.coalesce(F.col(by), F.lit(NO_HOST)))
    sizes = docs.groupBy(by).agg(F.count(F.lit(1)).alias("files"),
                                 F.sum(F.octet_length(F.col(text_col))).cast("long").alias("total_size_bytes"))
    return summary_rows(sizes.join(first_files(docs, as_of, by, order, name, text_col), by), as_of, by)


def summary_rows(figures: DataFrame, as_of, by: str = "corpus") -> DataFrame:
    """Corpus metadata from (corpus, files, total_size_bytes, uploaded_files)."""
    figures = with_byte_cost(figures)
    return figures.select(
        F.concat(F.lit("stores/"), F.col(by)).alias("store_name"),
        F.col(by).alias("corpus_name"), F.col("files").alias("files_indexed"),
        F.lit(K.STORAGE_TYPE).alias("storage_type"), F.lit(K.STORAGE_PERSISTENCE).alias("storage_persistence"),
        F.lit(True).alias("globally_accessible"), as_of_iso(as_of).alias("created_at"),
        "total_size_bytes", "estimated_tokens", "cost_estimate_usd",
        F.round(F.col("total_size_bytes") / 1024 / 1024, 2).alias("total_size_mb"), "uploaded_files")


def append_new_pages(existing: DataFrame, incoming: DataFrame, url: str = "url",
                     content: str = "content", order: str = "page_id") -> DataFrame:
    """Incoming rows not yet in the corpus by (url, sha256(content)): an
    unchanged page is skipped, a changed one is added. Of equal rows the one
    with the smallest ``order`` is added, if there is such a column. A null
    URL equals a null URL. Only the two key columns of the existing corpus are
    read and shuffled."""
    inc = incoming.withColumn("content_sha256", content_hash(content))
    if order in inc.columns:
        w = Window.partitionBy(url, "content_sha256").orderBy(order)
        inc = inc.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    else:
        inc = inc.dropDuplicates([url, "content_sha256"])
    ex = existing if "content_sha256" in existing.columns else existing.withColumn("content_sha256", content_hash(content))
    ex = ex.select(F.col(url).alias("_url"), F.col("content_sha256").alias("_sha"))
    return inc.join(ex, inc[url].eqNullSafe(ex["_url"]) & inc["content_sha256"].eqNullSafe(ex["_sha"]), "left_anti")


def write_corpus(docs: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                 corpus: str = "corpus") -> None:
    """Write documents partitioned by their corpus's bucket. The rebalance
    hint lets AQE size the write tasks: a hot bucket is split over several
    tasks and small ones are packed together."""
    (docs.withColumn("bucket", corpus_bucket(corpus)).hint("rebalance", "bucket").write.mode(mode)
     .partitionBy("bucket").format(fmt).save(path))


#: ends a record of the text sink; documents themselves hold newlines
RECORD_END = "\x1e"
#: stands, with a letter behind it, for itself and for a RECORD_END inside a document
ESCAPE = "\x1b"


def write_text_files(docs: DataFrame, path: str, column: str = "document") -> None:
    """The plain-text sink: a record per document, ended by ``RECORD_END``. A
    document with either control character is written with escapes; all
    others stand as they are."""
    text = F.replace(F.col(column), F.lit(ESCAPE), F.lit(ESCAPE + "e"))
    text = F.replace(text, F.lit(RECORD_END), F.lit(ESCAPE + "r"))
    docs.select(text.alias(column)).write.mode("overwrite").option("lineSep", RECORD_END).text(path)


def read_text_files(spark, path: str, column: str = "document") -> DataFrame:
    """The documents of the plain-text sink."""
    text = F.replace(F.col("value"), F.lit(ESCAPE + "r"), F.lit(RECORD_END))
    text = F.replace(text, F.lit(ESCAPE + "e"), F.lit(ESCAPE))
    return spark.read.option("lineSep", RECORD_END).text(path).select(text.alias(column))


def run_record(targets: DataFrame, as_of, corpus_name: str | None = None) -> DataFrame:
    """Nested run record per target. ``targets`` carries target, target_type,
    scraper_used, pages_scraped, documents_created, total_size_bytes."""
    tokens = F.floor(F.col("total_size_bytes") / K.CHARS_PER_TOKEN).cast("long")
    name = F.lit(corpus_name) if corpus_name else F.lit(K.DEFAULT_CORPUS_NAME)
    corpus = F.struct(
        F.concat(F.lit("stores/"), F.col("target")).alias("store_name"),
        name.alias("corpus_name"), F.col("documents_created").alias("files_indexed"),
        F.lit(K.STORAGE_TYPE).alias("storage_type"), F.lit(K.STORAGE_PERSISTENCE).alias("storage_persistence"),
        F.lit(True).alias("globally_accessible"), tokens.alias("estimated_tokens"),
        F.round(tokens / 1e6 * K.INDEXING_PRICE_PER_MILLION_TOKENS, 4).alias("cost_estimate_usd"))
    pricing = F.struct(
        F.lit(K.PRICING_MODEL).alias("model"), F.col("pages_scraped").alias("pages_processed"),
        F.lit(K.PRICE_PER_PAGE).alias("price_per_page"), F.lit(K.START_FEE).alias("start_fee"),
        page_charge(F.col("pages_scraped")).alias("estimated_total"), F.lit(K.PRICING_NOTE).alias("note"))
    record = F.struct(
        F.col("target").alias("target"), F.col("target_type").alias("target_type"),
        F.col("scraper_used").alias("scraper_used"), F.col("pages_scraped").alias("pages_scraped"),
        F.col("documents_created").alias("documents_created"), corpus.alias("corpus"),
        pricing.alias("pricing"), as_of_iso(as_of).alias("created_at"),
        F.lit(K.QUERY_INSTRUCTIONS).alias("query_instructions"))
    return targets.select(record.alias("record"))

