"""Pages -> documents: content resolution, titles, cleaning, headers.

The conversion is one projection over the page table: no shuffle, no Python
worker. The expensive token array is computed once per row in its own
projection and everything else is derived from it.
"""

from __future__ import annotations

import datetime as _dt
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagesieve import constants as K
from pagesieve.functions import html as H
from pagesieve.functions.text import iso_timestamp, metadata_header, normalize_ws, token_estimate
from pagesieve.operators.ordinal import position_within
from pagesieve.sources.tables import host_of, spread


def _has(df: DataFrame, path: str) -> bool:
    head, _, rest = path.partition(".")
    if head not in df.columns:
        return False
    if not rest:
        return True
    field = df.schema[head].dataType
    return hasattr(field, "fieldNames") and rest in field.fieldNames()


def content_column(df: DataFrame, html_field: str = "html") -> Column:
    """First non-empty of (configured field, html, text, markdown, content,
    crawl.html) among the fields ``df`` has; null when none."""
    fields = [html_field] + [f for f in K.CONTENT_FIELDS if f != html_field]
    present = [f for f in fields if _has(df, f)]
    return F.coalesce(*[F.when(F.length(F.col(f)) > 0, F.col(f)) for f in present]) if present \
        else F.lit(None).cast("string")


def resolve_content(df: DataFrame, url_field: str = "url", html_field: str = "html") -> DataFrame:
    """Add ``content`` = first non-empty of (configured field, html, text,
    markdown, content, crawl.html) and ``content_field`` = which one; null
    when none (empty string counts as missing)."""
    fields = [html_field] + [f for f in K.CONTENT_FIELDS if f != html_field]
    present = [f for f in fields if _has(df, f)]
    content = content_column(df, html_field)
    which = None
    for f in present:
        cond = F.length(F.col(f)) > 0
        which = F.when(cond, F.lit(f)) if which is None else which.when(cond, F.lit(f))
    which = which if which is not None else F.lit(None).cast("string")
    url = F.col(url_field) if url_field in df.columns else F.lit(None).cast("string")
    # Both derived in one projection: the input may itself have a "content" field.
    out = df.select("*", content.alias("_resolved"), which.alias("_field"), url.alias("_url"))
    return (out.drop("content", "content_field").withColumnRenamed("_resolved", "content")
            .withColumnRenamed("_field", "content_field"))


def with_default_url(df: DataFrame, ordinal: str) -> DataFrame:
    """A missing URL becomes ``unknown-{i}``; an empty one stays empty."""
    return df.withColumn("url", F.coalesce(F.col("_url"), F.concat(F.lit("unknown-"), F.col(ordinal).cast("string"))))


def skipped_items(df: DataFrame, url_field: str = "url", html_field: str = "html",
                  ordinal: str = "page_id") -> DataFrame:
    """Audit of items with no content in any field (they are still charged)."""
    r = with_default_url(resolve_content(df, url_field, html_field), ordinal)
    return r.filter(F.col("content").isNull()).select(ordinal, "url")


def doc_name(ordinal: Column) -> Column:
    """``doc_{i:04d}.txt`` (widens past 9999)."""
    return F.format_string("doc_%04d.txt", ordinal)


def doc_names(df: DataFrame, corpus_col: str = "corpus", order_col: str = "page_id") -> DataFrame:
    """Ordinal of each item within its corpus, counted before the skip filter
    (so skipped items leave gaps), and the document file name."""
    ranked = position_within(df, corpus_col, order_col, out="ordinal")
    return ranked.withColumn("doc_name", doc_name(F.col("ordinal")))


def as_of_iso(as_of) -> Column:
    """isoformat() of the scrape time; ``as_of`` is a datetime, a string, a
    column, or None for the query's current time (one value per query)."""
    if as_of is None:
        return iso_timestamp(F.current_timestamp())
    if isinstance(as_of, Column):
        return iso_timestamp(as_of)
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    return F.lit(as_of.isoformat())


@lru_cache(maxsize=64)
def _page_exprs(content: str, url: str):
    """Column expressions of the page projection, built once per column
    names (the trees are large; building them is many JVM round trips)."""
    toks = H.tokenize(F.col(content))
    drop = H._regions(F.col("_toks"), H._is_removed)
    tp = H.title_from_tokens(F.col("_toks"), F.col(url))
    text = normalize_ws(H.text_from_tokens(F.col("_toks"), F.col("_drop")))
    return toks, drop, tp, text


@lru_cache(maxsize=64)
def _clean_exprs(html_col: str):
    return H.tokenize(F.col(html_col)), H.clean_tokens(F.col("_toks"))


def _page_columns(df: DataFrame, content: str, url: str) -> DataFrame:
    """Add title, title_source and clean text from ``content``; the token
    array and the dropped regions are computed once, in their own projections."""
    toks, drop, tp, text = _page_exprs(content, url)
    t = df.select("*", toks.alias("_toks"))
    t = t.select("*", drop.alias("_drop"), tp.alias("_tp"))
    keep = [c for c in df.columns]
    return t.select(*keep, F.col("_tp.title").alias("title"), F.col("_tp.source").alias("title_source"),
                    text.alias("text"))


def clean_pages(df: DataFrame, html_col: str = "html", key: str = "page_id") -> DataFrame:
    """(key, text): clean text of every page."""
    base = spread(df.select(key, html_col), key)
    toks, text = _clean_exprs(html_col)
    return base.select(key, toks.alias("_toks")).select(key, text.alias("text"))


def extract_titles(df: DataFrame, html_col: str = "html", url_col: str = "url",
                   key: str = "page_id") -> DataFrame:
    """(key, url, title, title_source)."""
    base = spread(df.select(key, url_col, html_col), key)
    t = base.select(key, url_col, H.tokenize(F.col(html_col)).alias("_toks"))
    tp = H.title_from_tokens(F.col("_toks"), F.col(url_col))
    return t.select(key, url_col, tp["title"].alias("title"), tp["source"].alias("title_source"))


def main_content(df: DataFrame, html_col: str = "html", key: str = "page_id") -> DataFrame:
    """(key, main_text): clean text of the main content area."""
    base = spread(df.select(key, html_col), key)
    t = base.withColumn("_toks", H.tokenize(F.col(html_col)))
    t = t.withColumn("_main", H.main_content_tokens(F.col("_toks")))
    return t.select(key, H.clean_tokens(F.col("_main")).alias("main_text"))


def build_documents(df: DataFrame, as_of, include_metadata: bool = True,
                    text_col: str = "text", title_col: str = "title", url_col: str = "url") -> DataFrame:
    """document = metadata header + text, or the text alone."""
    if include_metadata:
        doc = F.concat(metadata_header(F.col(url_col), F.col(title_col), as_of_iso(as_of)), F.col(text_col))
    else:
        doc = F.col(text_col)
    return df.withColumn("document", doc)


def convert_pages(df: DataFrame, as_of, url_field: str = "url", html_field: str = "html",
                  ordinal: str = "page_id", include_metadata: bool = True,
                  corpus: Column | str | None = None, keep=(), partitions: int | None = None) -> DataFrame:
    """Scraped items -> documents.

    ``ordinal`` is the item's position in its scraped dataset (gaps are kept
    for skipped items). The corpus is that of the item's own URL, so an item
    without one goes to the corpus of pages without a host. Output: ordinal, corpus, doc_name, url, title,
    title_source, content_field, text, document, n_chars, n_bytes.
    """
    base = spread(df, ordinal, partitions)
    r = with_default_url(resolve_content(base, url_field, html_field), ordinal)
    r = r.filter(F.col("content").isNotNull())
    corpus_col = (host_of(F.col("_url")) if corpus is None
                  else (F.col(corpus) if isinstance(corpus, str) else corpus))
    r = r.select(F.col(ordinal), corpus_col.alias("corpus"), "url", "content", "content_field", *keep)
    r = _page_columns(r, "content", "url")
    r = build_documents(r, as_of, include_metadata)
    return r.select(ordinal, *keep, "corpus", doc_name(F.col(ordinal)).alias("doc_name"), "url", "title",
                    "title_source", "content_field", "text", "document",
                    F.length("document").cast("long").alias("n_chars"),
                    F.octet_length("document").cast("long").alias("n_bytes"))


def document_sizes(df: DataFrame, as_of, ordinal: str = "page_id", keep=()) -> DataFrame:
    """(keep..., n_bytes) for every item, skipped ones included: the size of
    the item's document, null when it has no content."""
    r = with_default_url(resolve_content(spread(df, ordinal)), ordinal)
    r = _page_columns(r.select(ordinal, "url", "content", *keep), "content", "url")
    return build_documents(r, as_of).select(*keep, F.when(
        F.col("content").isNotNull(), F.octet_length("document")).cast("long").alias("n_bytes"))


def cap_pages(df: DataFrame, max_pages: int = K.DEFAULT_MAX_PAGES, target: str = "target",
              order: str = "page_id") -> DataFrame:
    """At most ``max_pages`` items per target, lowest ``order`` first. The
    row_number filter is planned as a WindowGroupLimit, which trims each task's
    rows before the shuffle, so a hot target moves at most n rows per task."""
    w = Window.partitionBy(target).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= max_pages).drop("_rn")


def token_estimates(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.withColumn("tokens", token_estimate(F.col(text_col)))
