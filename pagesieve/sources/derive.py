"""Inputs derived from the driver tables to exercise operator branches.

The driver's page table is one narrow form of a scraped dataset; these
projections re-shape *every* row of it (nothing is dropped or sampled) into
the other shapes the operators accept: multi-field scraped items, per-target
scrape attempts, page variants that hit the title fallbacks and ad classes,
and a second crawl with changed pages. Each has an equivalent SQL statement
in the oracle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesieve.sources.tables import host_of, spread

# Item shapes by page_id % 6: 0 html; 1 no content (skipped); 2 empty html,
# text; 3 markdown + content; 4 content; 5 nested crawl.html.
# A null URL every seventh item (page_id % 7 == 3).


def scattered_items(pages: DataFrame) -> DataFrame:
    k = F.col("page_id") % 6
    h = F.col("html")
    return pages.select(
        "page_id",
        F.when(F.col("page_id") % 7 == 3, F.lit(None).cast("string")).otherwise(F.col("url")).alias("url"),
        F.when(k == 0, h).when(k == 2, F.lit("")).alias("html"),
        F.when(k == 2, h).alias("text"),
        F.when(k == 3, h).alias("markdown"),
        F.when(k.isin(3, 4), h).alias("content"),
        F.struct(F.when(k == 5, h).alias("html")).alias("crawl"),
        host_of("url").alias("target"))


def target_urls(pages: DataFrame) -> DataFrame:
    """The URLs that were asked for: those of the pages, with a path that
    tells the type (documentation, blog, forum, news, none) by the length of
    the host."""
    n = F.length(host_of("url")) % 5
    path = (F.when(n == 0, F.lit("/docs/")).when(n == 1, F.lit("/blog/")).when(n == 2, F.lit("/forum/"))
            .when(n == 3, F.lit("/story/")).otherwise(F.lit("")))
    return pages.select(F.concat("url", path).alias("url"))


def page_attempts(pages: DataFrame, selected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(attempts, items) for a scrape of every target with its selected sources.

    Items of a target are split over its ranked sources by page_id % 3; the
    first-ranked attempt fails for targets whose host name has odd length, all
    attempts fail where the length is a multiple of 9, and the items are empty
    where it is a multiple of 8. Returns attempts(target, rank, source_id,
    status, n_items, error) and items(target, rank, page_id, url, html).
    """
    empty = F.length(host_of("url")) % 8 == 0
    items = spread(pages, "page_id").select(
        host_of("url").alias("target"), (F.col("page_id") % 3 + 1).cast("int").alias("rank"), "page_id", "url",
        F.when(empty, F.lit("")).otherwise(F.col("html")).alias("html"))
    counts = items.groupBy("target", "rank").agg(F.count(F.lit(1)).alias("n_items"))
    failed = ((F.col("rank") == 1) & (F.length("target") % 2 == 1)) | (F.length("target") % 9 == 0)
    attempts = (selected.select("target", "rank", "source_id")
                .join(counts, ["target", "rank"], "left")
                .select("target", "rank", "source_id",
                        F.when(failed, F.lit("failed")).otherwise(F.lit("ok")).alias("status"),
                        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                        F.when(failed, F.concat(F.lit("Run failed: "), F.col("source_id"))).alias("error")))
    return attempts, items


def title_variants(pages: DataFrame) -> DataFrame:
    """Four versions of every page: as is; without <title>; without <title>
    and <h1> but with an og:title meta; without any of them."""
    h = F.col("html")
    no_title = F.regexp_replace(h, r"(?is)<title\b[^>]*>.*?</title\s*>", "")
    no_h1 = F.regexp_replace(no_title, r"(?is)<h1\b[^>]*>.*?</h1\s*>", "")
    og = F.regexp_replace(no_h1, r"(?i)<head>",
                          "<head><meta property=\"og:title\" content=\" Open Graph &amp; title \">")
    v = F.explode(F.array(
        F.struct(F.lit("as_is").alias("variant"), h.alias("html")),
        F.struct(F.lit("no_title").alias("variant"), no_title.alias("html")),
        F.struct(F.lit("og_only").alias("variant"), og.alias("html")),
        F.struct(F.lit("bare").alias("variant"), no_h1.alias("html"))))
    return pages.select("page_id", "url", v.alias("v")).select("page_id", "url", "v.variant", "v.html")


def main_content_variants(pages: DataFrame) -> DataFrame:
    """Every page three times: as is (<article>), with the article as <main>,
    and with it as <div class="post-content"> (the class rule)."""
    h = F.col("html")
    as_main = F.regexp_replace(F.regexp_replace(h, "<article>", "<main>"), "</article>", "</main>")
    as_div = F.regexp_replace(F.regexp_replace(h, "<article>", '<div class="post-content">'), "</article>", "</div>")
    v = F.explode(F.array(
        F.struct(F.lit("article").alias("variant"), h.alias("html")),
        F.struct(F.lit("main").alias("variant"), as_main.alias("html")),
        F.struct(F.lit("class").alias("variant"), as_div.alias("html"))))
    return pages.select("page_id", v.alias("v")).select("page_id", "v.variant", "v.html")


def ad_class_pages(pages: DataFrame) -> DataFrame:
    """Every page with its plain 'ad' block re-labelled with tracking classes
    (which the cleaner must drop) and a nested ad block added inside the article."""
    h = F.regexp_replace(F.col("html"), 'class="ad"', 'class="ad-container sponsored"')
    h = F.regexp_replace(h, r"(?i)<article>",
                         '<article><div class="Popup"><div>tracked</div> offer</div>')
    return pages.select("page_id", "url", h.alias("html"))


def nameless_pages(pages: DataFrame) -> DataFrame:
    """Every page, with every third URL missing and every fourth of the
    others without its scheme."""
    url = F.when(F.col("page_id") % 3 == 0, F.lit(None).cast("string")).when(
        F.col("page_id") % 4 == 0, F.regexp_replace("url", "^[a-z]+://", "")).otherwise(F.col("url"))
    return pages.select("page_id", url.alias("url"), "html")


def awkward_pages(pages: DataFrame) -> DataFrame:
    """Every page with an element whose name begins like a raw-text element,
    an unquoted class before another attribute, and an ad class behind a
    quoted value that holds a tag end, at the start of the article."""
    h = F.regexp_replace(F.col("html"), r"(?i)<article>",
                         '<article><style-guide>guide</style-guide><div class=foo data-x=ads>kept</div>'
                         '<div title=">" class="ads">gone</div>')
    return pages.select("page_id", "url", h.alias("html"))


def second_crawl(pages: DataFrame) -> DataFrame:
    """A later crawl of the same pages: pages under /en/ changed, others not."""
    changed = F.contains(F.col("url"), F.lit("/en/"))
    h = F.when(changed, F.regexp_replace(F.col("html"), "</article>", "<p>Updated.</p></article>")).otherwise(F.col("html"))
    return pages.select("page_id", "url", h.alias("html"))


def edited_documents(documents: DataFrame) -> DataFrame:
    """A later state of the documents: every second one has words added in its middle."""
    half = F.floor(F.length("text") / 2).cast("int")
    text = F.concat(F.expr("substr(text, 1, cast(floor(length(text) / 2) as int))"), F.lit(" words added later "),
                    F.substr("text", half + 1))
    return documents.select("doc_id", F.when(F.col("doc_id") % 2 == 0, text).otherwise(F.col("text")).alias("text"))


def attempt_arrivals(attempts: DataFrame, base: dt.datetime, batches: int = 3) -> list[DataFrame]:
    """Attempts with the minute they ended, in batches that are not in the order of
    ranks, and a last batch that only moves the time on by a day."""
    timed = attempts.withColumn("ended_at", F.lit(base) + F.make_dt_interval(mins=F.col("rank")))
    batch = F.pmod(F.xxhash64("target", "rank"), F.lit(batches))
    later = attempts.sparkSession.createDataFrame([(base + dt.timedelta(days=1),)], "ended_at timestamp")
    last = later.select(*(F.lit(None).cast(timed.schema[c].dataType).alias(c) for c in attempts.columns), "ended_at")
    return [*(timed.where(batch == i) for i in range(batches)), last]


def dirty_documents(documents: DataFrame) -> DataFrame:
    """Documents with whitespace noise added after every sentence end."""
    return documents.select("doc_id", F.replace(F.col("text"), F.lit(". "), F.lit(".  \t   \n\n\n\n ")).alias("text"))
