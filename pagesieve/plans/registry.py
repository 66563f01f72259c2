"""Registered queries: one Spark job per operator of the survey inventory,
each with an independent DuckDB statement that must give the same rows.

Every query reads the driver tables (or data Spark derives from them) in
full; nothing is sampled or capped except where the cap is the feature
(top-k, page cap, first-10 manifest).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesieve import constants as K
from pagesieve.functions import html as H
from pagesieve.functions.text import normalize_ws
from pagesieve.operators import chunking as CH
from pagesieve.operators import convert as CV
from pagesieve.operators import corpus as CO
from pagesieve.operators import fallback as FB
from pagesieve.operators import figures as FG
from pagesieve.operators import index_store as IX
from pagesieve.operators import passages as PS
from pagesieve.operators import pieces as PC
from pagesieve.operators import policy as PO
from pagesieve.operators import policy_table as PT
from pagesieve.operators import retrieval as RT
from pagesieve.operators import selection as SE
from pagesieve.operators import vector_index as VI
from pagesieve.plans import jobs as JB
from pagesieve.plans import sql as S
from pagesieve.session import materialize, scratch_path
from pagesieve.sources import derive as DV
from pagesieve.streaming import attempts as SA
from pagesieve.streaming import changes as SC
from pagesieve.streaming import ingest as ST
from pagesieve.sources.tables import catalogue, dealt, host_of, read_pages, read_table, table_path

AS_OF = dt.datetime(2024, 1, 1, 0, 0, 0)
AS_OF_ISO = AS_OF.isoformat()

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_pages(spark, table_path(sf, "pages"))


# ---------------------------------------------------------------------------
# Scan, clean, titles, convert
# ---------------------------------------------------------------------------

@register("scan_pages", """
SELECT page_id, url, length(html) AS html_chars, strlen(html) AS html_bytes FROM pages""")
def q_scan_pages(spark, sf):
    return pages(spark, sf).select("page_id", "url", F.length("html").cast("long").alias("html_chars"),
                                   F.octet_length("html").cast("long").alias("html_bytes"))


@register("clean_pages", f"SELECT page_id, {S.clean_html('html')} AS text FROM pages")
def q_clean_pages(spark, sf):
    return CV.clean_pages(pages(spark, sf))


@register("page_titles", f"""
SELECT page_id, url, {S.title('html')} AS title,
       CASE WHEN regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1) <> '' THEN 'title' ELSE 'h1' END
         AS title_source
FROM pages""")
def q_page_titles(spark, sf):
    return CV.extract_titles(pages(spark, sf))


_CONVERT_SQL = f"""
WITH c AS (
  SELECT page_id, coalesce(url, 'unknown-' || page_id) AS url, {S.title('html')} AS title,
         {S.clean_html('html')} AS text
  FROM pages WHERE length(html) > 0),
d AS (SELECT *, {S.header('url', 'title', AS_OF_ISO)} || text AS document FROM c)
SELECT page_id, {S.host('url')} AS corpus, printf('doc_%04d.txt', page_id) AS doc_name, url, title,
       'title' AS title_source, 'html' AS content_field, text, document,
       length(document) AS n_chars, strlen(document) AS n_bytes
FROM d"""


@register("convert_pages", _CONVERT_SQL)
def q_convert_pages(spark, sf):
    return CV.convert_pages(pages(spark, sf), AS_OF)


# ---------------------------------------------------------------------------
# Shared SQL pieces (oracle side)
# ---------------------------------------------------------------------------

_CAT_COLS = ["ord", "id", "title", "description", "success_rate", "monthly_users", "rating", "best_for",
             "output_format", "speed", "cost"]
_CAT_SQL = S.values([(r[0], r[1], r[3], None, r[6], r[7], r[8], r[9], r[10], r[12], r[13]) for r in K.CATALOGUE],
                    _CAT_COLS)
_TYPES_SQL = S.values([(t,) for t in K.TARGET_TYPES], ["target_type"])
_BUDGETS_SQL = S.values([(b,) for b in K.BUDGET_MODES], ["budget"])
_PAGE_PATTERNS = K.BANNED_PATTERNS + K.PAGE_POLICY_EXTRA


def _banned_sql(text: str, patterns=_PAGE_PATTERNS) -> str:
    return "(" + " OR ".join(f"contains({text}, {S.q(p)})" for p in patterns) + ")"


_SCORE_SQL = f"""
cat AS (SELECT * FROM {_CAT_SQL}),
tt AS (SELECT {S.host('url')} AS target, min(url || CASE length({S.host('url')}) % 5 WHEN 0 THEN '/docs/'
              WHEN 1 THEN '/blog/' WHEN 2 THEN '/forum/' WHEN 3 THEN '/story/' ELSE '' END) AS target_url
       FROM pages GROUP BY 1),
targets AS (SELECT target, {S.classify('target_url')} AS target_type FROM tt),
scored AS (
  SELECT ty.target_type, b.budget, c.*,
    round(c.success_rate * 40
      + CASE WHEN c.monthly_users > 0 THEN least(20, 5 + log10(c.monthly_users) * 5) ELSE 0 END
      + CASE WHEN c.cost = 'free' THEN 20 WHEN b.budget = 'premium' THEN 10 ELSE 0 END
      + CASE WHEN list_contains(c.best_for, ty.target_type) THEN 10 ELSE 0 END
      + CASE c.output_format WHEN 'markdown' THEN 10 WHEN 'text' THEN 7 WHEN 'html' THEN 5 ELSE 0 END, 1)
      AS score,
    least(CASE b.budget WHEN 'premium' THEN c.rating * 10 * 1.2 WHEN 'minimal' THEN c.rating * 10 * 0.9
               ELSE c.rating * 10 END, 100) AS legacy_score
  FROM cat c CROSS JOIN {_TYPES_SQL.replace(' AS t(', ' AS ty(')} CROSS JOIN {_BUDGETS_SQL.replace(' AS t(', ' AS b(')}),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY target_type, budget ORDER BY score DESC, ord) AS INTEGER) AS rank
  FROM scored WHERE NOT {_banned_sql("lower(concat_ws(' ', id, title, coalesce(description, '')))", K.BANNED_PATTERNS)}),
selected AS (
  SELECT t.target, t.target_type, r.budget, r.rank, r.ord, r.id AS source_id, r.score
  FROM targets t JOIN ranked r ON r.target_type = t.target_type AND r.budget = 'optimal' AND r.rank <= 3)"""

_ATTEMPTS_SQL = _SCORE_SQL + f""",
items AS (SELECT {S.host('url')} AS target, CAST(page_id % 3 + 1 AS INTEGER) AS rank, page_id, url,
                 CASE WHEN length({S.host('url')}) % 8 = 0 THEN '' ELSE html END AS html FROM pages),
counts AS (SELECT target, rank, count(*) AS n_items FROM items GROUP BY 1, 2),
attempts AS (
  SELECT s.target, s.rank, s.source_id,
         CASE WHEN (s.rank = 1 AND length(s.target) % 2 = 1) OR length(s.target) % 9 = 0 THEN 'failed' ELSE 'ok' END AS status,
         coalesce(c.n_items, 0) AS n_items,
         CASE WHEN (s.rank = 1 AND length(s.target) % 2 = 1) OR length(s.target) % 9 = 0 THEN 'Run failed: ' || s.source_id END AS error
  FROM selected s LEFT JOIN counts c ON c.target = s.target AND c.rank = s.rank),
win AS (
  SELECT a.target, a.rank, a.source_id FROM attempts a
  JOIN (SELECT target, min(rank) AS rank FROM attempts WHERE status = 'ok' AND n_items > 0 GROUP BY 1) m
    ON m.target = a.target AND m.rank = a.rank)"""

_ITEMS_SQL = f"""
items AS (
  SELECT page_id,
         CASE WHEN page_id % 7 = 3 THEN NULL ELSE url END AS url,
         CASE page_id % 6 WHEN 0 THEN html WHEN 2 THEN '' END AS html,
         CASE WHEN page_id % 6 = 2 THEN html END AS text,
         CASE WHEN page_id % 6 = 3 THEN html END AS markdown,
         CASE WHEN page_id % 6 IN (3, 4) THEN html END AS content,
         CASE WHEN page_id % 6 = 5 THEN html END AS crawl_html,
         {S.host('url')} AS target
  FROM pages),
resolved AS (
  SELECT *,
    coalesce(nullif(html, ''), nullif(text, ''), nullif(markdown, ''), nullif(content, ''), nullif(crawl_html, ''))
      AS resolved,
    CASE WHEN length(html) > 0 THEN 'html' WHEN length(text) > 0 THEN 'text'
         WHEN length(markdown) > 0 THEN 'markdown' WHEN length(content) > 0 THEN 'content'
         WHEN length(crawl_html) > 0 THEN 'crawl.html' END AS content_field
  FROM items)"""

_DOCS_CTE = f"""
conv AS (
  SELECT page_id, coalesce(url, 'unknown-' || page_id) AS url, {S.title('html')} AS title,
         {S.clean_html('html')} AS text
  FROM pages WHERE length(html) > 0),
docs AS (
  SELECT page_id, {S.host('url')} AS corpus, printf('doc_%04d.txt', page_id) AS doc_name, url, title, text,
         {S.header('url', 'title', AS_OF_ISO)} || text AS document
  FROM conv)"""


def _targets(spark, sf):
    return SE.targets_from_urls(DV.target_urls(pages(spark, sf))).select("target", "target_type")


def _selected(spark, sf):
    return SE.select_sources(_targets(spark, sf))


def _attempts(spark, sf):
    return DV.page_attempts(pages(spark, sf), _selected(spark, sf))


def _items(spark, sf):
    return CV.resolve_content(DV.scattered_items(pages(spark, sf)))


def _docs(spark, sf):
    return CV.convert_pages(pages(spark, sf), AS_OF)


# ---------------------------------------------------------------------------
# Classification, policy, catalogue, scores, selection
# ---------------------------------------------------------------------------

@register("classify_urls", f"SELECT page_id, url, {S.classify('url')} AS target_type FROM pages")
def q_classify_urls(spark, sf):
    return SE.classify_urls(pages(spark, sf).select("page_id", "url"))


@register("target_type_counts", f"SELECT {S.classify('url')} AS target_type, count(*) AS pages FROM pages GROUP BY 1")
def q_target_type_counts(spark, sf):
    return SE.classify_urls(pages(spark, sf)).groupBy("target_type").agg(F.count(F.lit(1)).alias("pages"))


@register("policy_allowed", f"SELECT page_id, url FROM pages WHERE NOT {_banned_sql('lower(url)')}")
def q_policy_allowed(spark, sf):
    return PO.apply_policy(pages(spark, sf).select("page_id", "url"), ("url",), _PAGE_PATTERNS)


@register("policy_audit", f"""
SELECT page_id, url, array_to_string(list_sort(list_filter({[p for p in _PAGE_PATTERNS]},
       lambda p: contains(lower(url), p))), ',') AS patterns
FROM pages WHERE {_banned_sql('lower(url)')}""")
def q_policy_audit(spark, sf):
    return PO.policy_audit(pages(spark, sf).select("page_id", "url"), ("url",), _PAGE_PATTERNS)


@register("policy_counts", f"""
SELECT CAST(count_if({_banned_sql('lower(url)')}) AS BIGINT) AS banned,
       CAST(count_if(NOT {_banned_sql('lower(url)')}) AS BIGINT) AS allowed
FROM pages""")
def q_policy_counts(spark, sf):
    return PO.policy_counts(pages(spark, sf), ("url",), _PAGE_PATTERNS)


@register("policy_table_audit", """
WITH p AS (SELECT DISTINCT array_to_string(string_split(lower(text), ' ')[2:3], ' ') AS pattern FROM documents),
t AS (SELECT doc_id, lower(text) AS text FROM documents)
SELECT t.doc_id, count(*) AS n_patterns, sha256(string_agg(pattern, chr(10) ORDER BY pattern)) AS patterns_sha256
FROM t JOIN p ON p.pattern <> '' AND contains(t.text, p.pattern) GROUP BY 1""")
def q_policy_table_audit(spark, sf):
    """A pattern table of thousands of rows: the second and third word of every
    document, looked for in all documents."""
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    words = F.split(F.lower("text"), " ", -1)
    patterns = docs.select(F.array_join(F.slice(words, 2, 2), " ").alias("pattern"))
    found = PT.audit_table(docs, ("text",), patterns)
    return found.select("doc_id", F.size("patterns").cast("long").alias("n_patterns"),
                        F.sha2(F.array_join("patterns", "\n"), 256).alias("patterns_sha256"))


@register("catalog_by_budget", f"""
WITH {_SCORE_SQL}
SELECT t.target, t.target_type, b.budget, c.ord, c.id AS source_id
FROM targets t CROSS JOIN {_BUDGETS_SQL.replace(' AS t(', ' AS b(')} JOIN cat c
  ON CASE b.budget WHEN 'minimal' THEN c.cost = 'free' AND c.speed IN ('very_fast', 'fast')
                   WHEN 'optimal' THEN c.cost = 'free' ELSE TRUE END""")
def q_catalog_by_budget(spark, sf):
    return SE.catalog_by_budget(_targets(spark, sf))


@register("catalog_by_target", f"""
WITH {_SCORE_SQL}
SELECT t.target, t.target_type, c.ord, c.id AS source_id
FROM targets t JOIN cat c ON list_contains(c.best_for, t.target_type)""")
def q_catalog_by_target(spark, sf):
    return SE.catalog_by_target(_targets(spark, sf))


@register("source_scores", f"""
WITH {_SCORE_SQL}
SELECT t.target, t.target_type, s.budget, s.ord, s.id AS source_id, s.score
FROM targets t JOIN scored s ON s.target_type = t.target_type""")
def q_source_scores(spark, sf):
    return SE.score_sources(_targets(spark, sf)).select(
        "target", "target_type", "budget", "ord", F.col("id").alias("source_id"), "score")


@register("source_scores_legacy", f"""
WITH {_SCORE_SQL}
SELECT t.target, s.budget, s.ord, s.id AS source_id, s.legacy_score
FROM targets t JOIN scored s ON s.target_type = t.target_type""")
def q_source_scores_legacy(spark, sf):
    return SE.score_sources(_targets(spark, sf)).select(
        "target", "budget", "ord", F.col("id").alias("source_id"), "legacy_score")


@register("top_sources", f"""
WITH {_SCORE_SQL},
top AS (SELECT *, CAST(row_number() OVER (PARTITION BY target_type, budget ORDER BY score DESC, ord) AS INTEGER) AS rank
         FROM scored)
SELECT t.target, t.target_type, p.budget, p.rank, p.ord, p.id AS source_id, p.score
FROM targets t JOIN top p ON p.target_type = t.target_type AND p.rank <= 3""")
def q_top_sources(spark, sf):
    small = SE.rank_sources(SE.scored_catalogue(catalogue(spark)), K.DEFAULT_TOP_N)
    t = SE.with_budgets(_targets(spark, sf))
    return t.join(small, ["target_type", "budget"]).select(
        "target", "target_type", "budget", "rank", "ord", F.col("id").alias("source_id"), "score")


@register("select_sources", f"WITH {_SCORE_SQL} SELECT * FROM selected")
def q_select_sources(spark, sf):
    return _selected(spark, sf)


# ---------------------------------------------------------------------------
# Fallback, status, caps
# ---------------------------------------------------------------------------

@register("source_fallback", f"""
WITH {_ATTEMPTS_SQL}
SELECT w.target, w.rank, w.source_id, i.page_id, i.url
FROM win w JOIN items i ON i.target = w.target AND i.rank = w.rank""")
def q_source_fallback(spark, sf):
    attempts, items = _attempts(spark, sf)
    return FB.first_successful_source(attempts, items).select("target", "rank", "source_id", "page_id", "url")


@register("source_failures", f"""
WITH {_ATTEMPTS_SQL},
e AS (SELECT target, rank,
             CASE WHEN status <> 'ok' THEN coalesce(error, 'All scrapers failed')
                  WHEN n_items = 0 THEN 'No data returned from ' || source_id END AS err,
             (status = 'ok' AND n_items > 0) AS ok
      FROM attempts)
SELECT target, count(*) AS attempts, coalesce(arg_max(err, rank), 'All scrapers failed') AS error
FROM e GROUP BY target HAVING count_if(ok) = 0""")
def q_source_failures(spark, sf):
    attempts, _ = _attempts(spark, sf)
    return FB.source_failures(attempts)


ARRIVALS_FROM, ARRIVALS_WAIT = dt.datetime(2024, 1, 1), dt.timedelta(hours=2)


def _streamed_outcomes(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(outcomes, items): the attempts followed as a stream, out of order."""
    attempts, items = _attempts(spark, sf)
    arrivals = DV.attempt_arrivals(materialize(attempts), ARRIVALS_FROM)
    return SA.run_attempts(spark, arrivals, ARRIVALS_WAIT), items


@register("streamed_fallback", f"""
WITH {_ATTEMPTS_SQL}
SELECT w.target, w.rank, w.source_id, i.page_id, i.url
FROM win w JOIN items i ON i.target = w.target AND i.rank = w.rank""")
def q_streamed_fallback(spark, sf):
    outcomes, items = _streamed_outcomes(spark, sf)
    won = outcomes.where("outcome = 'won'").select("target", "rank", "source_id")
    return items.join(won, ["target", "rank"]).select("target", "rank", "source_id", "page_id", "url")


@register("streamed_failures", ORACLES["source_failures"])
def q_streamed_failures(spark, sf):
    outcomes, _ = _streamed_outcomes(spark, sf)
    return outcomes.where("outcome = 'failed'").select("target", "attempts", "error")


@register("target_status", f"""
WITH {_ATTEMPTS_SQL},
content AS (SELECT w.target, count_if(length(i.html) > 0) AS n_content
            FROM win w JOIN items i ON i.target = w.target AND i.rank = w.rank GROUP BY 1)
SELECT t.target,
  CASE WHEN length(t.target) % 7 = 0 OR NOT EXISTS (SELECT 1 FROM selected s WHERE s.target = t.target)
            THEN 'no_source'
       WHEN NOT EXISTS (SELECT 1 FROM win w WHERE w.target = t.target) THEN 'all_failed'
       WHEN coalesce((SELECT n_content FROM content c WHERE c.target = t.target), 0) = 0 THEN 'no_content'
       ELSE 'ok' END AS status
FROM targets t""")
def q_target_status(spark, sf):
    attempts, items = _attempts(spark, sf)
    # no source is left for targets whose name's length is a multiple of 7
    selected = _selected(spark, sf).filter(F.length("target") % 7 != 0)
    return FB.target_status(_targets(spark, sf), selected, attempts, items)


@register("page_cap", f"""
SELECT target, page_id, url FROM (
  SELECT {S.host('url')} AS target, page_id, url,
         row_number() OVER (PARTITION BY {S.host('url')} ORDER BY page_id) AS rn FROM pages)
WHERE rn <= 2""")
def q_page_cap(spark, sf):
    p = pages(spark, sf).select(host_of("url").alias("target"), "page_id", "url")
    return CV.cap_pages(p, 2)


# ---------------------------------------------------------------------------
# Content resolution, ordinals, document variants
# ---------------------------------------------------------------------------

@register("resolve_content", f"""
WITH {_ITEMS_SQL}
SELECT page_id, url, content_field, resolved AS content FROM resolved""")
def q_resolve_content(spark, sf):
    return _items(spark, sf).select("page_id", F.col("_url").alias("url"), "content_field", "content")


@register("skipped_items", f"""
WITH {_ITEMS_SQL}
SELECT page_id, coalesce(url, 'unknown-' || page_id) AS url FROM resolved WHERE resolved IS NULL""")
def q_skipped_items(spark, sf):
    return CV.skipped_items(DV.scattered_items(pages(spark, sf)))


@register("doc_names", f"""
WITH {_ITEMS_SQL},
o AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY page_id) - 1 AS ordinal FROM resolved)
SELECT page_id, target AS corpus, ordinal, printf('doc_%04d.txt', ordinal) AS doc_name,
       coalesce(url, 'unknown-' || ordinal) AS url
FROM o WHERE resolved IS NOT NULL""")
def q_doc_names(spark, sf):
    items = _items(spark, sf).withColumnRenamed("target", "corpus")
    named = CV.doc_names(items, "corpus", "page_id")
    named = CV.with_default_url(named, "ordinal").filter(F.col("content").isNotNull())
    return named.select("page_id", "corpus", "ordinal", "doc_name", "url")


@register("documents_with_header", f"""
WITH {_ITEMS_SQL},
c AS (SELECT page_id, coalesce(url, 'unknown-' || page_id) AS url, content_field, {S.title('resolved')} AS title,
             {S.clean_html('resolved')} AS text FROM resolved WHERE resolved IS NOT NULL)
SELECT page_id, url, content_field, {S.header('url', 'title', AS_OF_ISO)} || text AS document FROM c""")
def q_documents_with_header(spark, sf):
    return CV.convert_pages(DV.scattered_items(pages(spark, sf)), AS_OF).select(
        "page_id", "url", "content_field", "document")


@register("documents_plain", f"""
WITH {_ITEMS_SQL}
SELECT page_id, {S.clean_html('resolved')} AS document FROM resolved WHERE resolved IS NOT NULL""")
def q_documents_plain(spark, sf):
    return CV.convert_pages(DV.scattered_items(pages(spark, sf)), AS_OF, include_metadata=False).select(
        "page_id", "document")


_TITLE_VARIANTS_SQL = """
v AS (
  SELECT page_id, url, 'as_is' AS variant, html FROM pages
  UNION ALL SELECT page_id, url, 'no_title', regexp_replace(html, '(?is)<title\\b[^>]*>.*?</title\\s*>', '', 'g') FROM pages
  UNION ALL SELECT page_id, url, 'og_only', regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<title\\b[^>]*>.*?</title\\s*>', '', 'g'), '(?is)<h1\\b[^>]*>.*?</h1\\s*>', '', 'g'), '(?i)<head>',
      '<head><meta property="og:title" content=" Open Graph &amp; title ">', 'g') FROM pages
  UNION ALL SELECT page_id, url, 'bare', regexp_replace(regexp_replace(html,
      '(?is)<title\\b[^>]*>.*?</title\\s*>', '', 'g'), '(?is)<h1\\b[^>]*>.*?</h1\\s*>', '', 'g') FROM pages),
base AS (
  SELECT *, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1) AS t_raw,
         regexp_matches(html, '(?i)<h1\\b') AS has_h1,
         regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1', 1) AS h1_raw,
         regexp_extract(html, '<meta property="og:title" content="([^"]*)"', 1) AS og_raw,
         regexp_extract(regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?(?://[^/?#]*)?([^?#]*)', 1),
                                       '/+$', ''), '([^/]*)$', 1) AS base
  FROM v),
titled AS (
  SELECT page_id, variant,
    CASE WHEN t_raw <> '' THEN {title}
         WHEN has_h1 THEN array_to_string(list_filter(list_transform(string_split(regexp_replace(h1_raw, '<[^>]*>',
              chr(10), 'g'), chr(10)), lambda l: {strip_l}), lambda l: l <> ''), '')
         WHEN og_raw <> '' THEN {og}
         WHEN base <> '' THEN array_to_string(list_transform(regexp_extract_all(translate(base, '-_', '  '),
              '[\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+'), lambda w: upper(w[1]) || lower(w[2:])), '')
         ELSE 'Untitled' END AS title,
    CASE WHEN t_raw <> '' THEN 'title' WHEN has_h1 THEN 'h1' WHEN og_raw <> '' THEN 'og'
         WHEN base <> '' THEN 'url' ELSE 'untitled' END AS title_source
  FROM base)""".format(title=S.strip(S.decode_entities("t_raw")), strip_l=S.strip(S.decode_entities("l")),
                       og=S.strip(S.decode_entities("og_raw")))


@register("title_fallbacks", f"WITH {_TITLE_VARIANTS_SQL} SELECT page_id, variant, title, title_source FROM titled")
def q_title_fallbacks(spark, sf):
    v = DV.title_variants(pages(spark, sf))
    tp = H.title_parts(F.col("html"), F.col("url"))
    return v.select("page_id", "variant", tp["title"].alias("title"), tp["source"].alias("title_source"))


@register("title_source_counts",
          f"WITH {_TITLE_VARIANTS_SQL} SELECT title_source, count(*) AS pages FROM titled GROUP BY 1")
def q_title_source_counts(spark, sf):
    v = DV.title_variants(pages(spark, sf))
    return (v.select(H.title_parts(F.col("html"), F.col("url"))["source"].alias("title_source"))
            .groupBy("title_source").agg(F.count(F.lit(1)).alias("pages")))


@register("main_content", f"""
SELECT page_id, {S.clean_html("regexp_extract(html, '(?is)<article\\b[^>]*>.*?</article\\s*>', 0)")} AS main_text
FROM pages""")
def q_main_content(spark, sf):
    return CV.main_content(pages(spark, sf))


@register("main_content_variants", f"""
WITH v AS (
  SELECT page_id, 'article' AS variant, regexp_extract(html, '(?is)<article\\b[^>]*>.*?</article\\s*>', 0) AS part
  FROM pages
  UNION ALL
  SELECT page_id, 'main', regexp_extract(html, '(?is)<article\\b[^>]*>.*?</article\\s*>', 0) FROM pages
  UNION ALL
  SELECT page_id, 'class', regexp_extract(html, '(?is)<article\\b[^>]*>.*?</article\\s*>', 0) FROM pages)
SELECT page_id, variant, {S.clean_html('part')} AS main_text FROM v""")
def q_main_content_variants(spark, sf):
    v = DV.main_content_variants(pages(spark, sf))
    t = v.withColumn("_toks", H.tokenize(F.col("html")))
    t = t.withColumn("_main", H.main_content_tokens(F.col("_toks")))
    return t.select("page_id", "variant", H.clean_tokens(F.col("_main")).alias("main_text"))


_AD_HTML_SQL = ("regexp_replace(replace(html, 'class=\"ad\"', 'class=\"ad-container sponsored\"'), '(?i)<article>', "
                "'<article><div class=\"Popup\"><div>tracked</div> offer</div>', 'g')")
_AD_BLOCK_RE = ("(?is)<div\\s+class=\"[^\"]*(?:" + "|".join(K.AD_CLASS_PATTERNS)
                + ")[^\"]*\"[^>]*>(?:<div[^>]*>[^<]*</div>|[^<])*</div>")


@register("strip_ad_blocks", f"""
SELECT page_id, {S.clean_html(f"regexp_replace({_AD_HTML_SQL}, '{_AD_BLOCK_RE}', chr(10), 'g')")} AS text
FROM pages""")
def q_strip_ad_blocks(spark, sf):
    return CV.clean_pages(DV.ad_class_pages(pages(spark, sf)))


@register("awkward_markup", f"""
SELECT page_id, {S.clean_html("regexp_replace(html, '(?i)<article>', '<article><p>guide</p><p>kept</p>', 'g')")} AS text
FROM pages""")
def q_awkward_markup(spark, sf):
    return CV.clean_pages(DV.awkward_pages(pages(spark, sf)))


@register("normalize_documents", f"""
SELECT doc_id, {S.normalize_ws("replace(text, '. ', '.  ' || chr(9) || '   ' || chr(10) || chr(10) || chr(10) || chr(10) || ' ')")}
  AS text FROM documents""")
def q_normalize_documents(spark, sf):
    d = DV.dirty_documents(read_table(spark, sf, "documents"))
    return d.select("doc_id", normalize_ws(F.col("text")).alias("text"))


# ---------------------------------------------------------------------------
# Tokens, costs, corpus summaries, manifests, run records
# ---------------------------------------------------------------------------

@register("token_estimates", "SELECT doc_id, length(text) AS n_chars, length(text) // 5 AS tokens FROM documents")
def q_token_estimates(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    return CV.token_estimates(d).select("doc_id", F.length("text").cast("long").alias("n_chars"), "tokens")


@register("indexing_cost", """
SELECT count(*) AS files, CAST(sum(length(text) // 5) AS BIGINT) AS total_tokens,
       sum(length(text) // 5) / 1e6 * 0.15 AS cost_usd FROM documents""")
def q_indexing_cost(spark, sf):
    return CO.indexing_cost_chars(read_table(spark, sf, "documents"), "text")


@register("indexing_cost_bytes", """
SELECT count(*) AS files, CAST(sum(strlen(text)) AS BIGINT) AS total_size_bytes,
       CAST(sum(strlen(text)) // 5 AS BIGINT) AS estimated_tokens,
       round((sum(strlen(text)) // 5) / 1e6 * 0.15, 4) AS cost_estimate_usd FROM documents""")
def q_indexing_cost_bytes(spark, sf):
    return CO.indexing_cost_bytes(read_table(spark, sf, "documents"), "text")


_SUMMARY_SQL = f"""
a AS (SELECT source, count(*) AS files, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM d GROUP BY 1),
f AS (SELECT source, string_agg(name || ' ' || source || '/' || name || ' ' || strlen(text) || ' {AS_OF_ISO}', ','
                           ORDER BY doc_id) AS first_files FROM (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM d) WHERE rn <= 10 GROUP BY 1)
SELECT 'stores/' || a.source AS store_name, a.source AS corpus_name, files AS files_indexed, '{K.STORAGE_TYPE}' AS storage_type,
       '{K.STORAGE_PERSISTENCE}' AS storage_persistence, TRUE AS globally_accessible,
       '{AS_OF_ISO}' AS created_at, bytes AS total_size_bytes, bytes // 5 AS estimated_tokens,
       round((bytes // 5) / 1e6 * 0.15, 4) AS cost_estimate_usd, round(bytes / 1024 / 1024, 2) AS total_size_mb,
       first_files
FROM a JOIN f ON f.source = a.source"""


@register("corpus_summary", """
WITH d AS (SELECT source, doc_id, text, printf('doc_%04d.txt', doc_id) AS name FROM documents),""" + _SUMMARY_SQL)
def q_corpus_summary(spark, sf):
    d = read_table(spark, sf, "documents").select(
        F.col("source").alias("corpus"), "doc_id", "text", CV.doc_name(F.col("doc_id")).alias("doc_name"))
    summary = CO.corpus_summary(d, AS_OF, by="corpus", text_col="text", order="doc_id", name="doc_name")
    return _flat_files(summary)


def _flat_files(summary: DataFrame) -> DataFrame:
    return summary.withColumn("first_files", F.array_join(F.transform("uploaded_files", lambda f: F.concat_ws(
        " ", f["name"], f["path"], f["size"].cast("string"), f["imported_at"])), ",")).drop("uploaded_files")


@register("kept_figures", """
WITH d AS (SELECT source, doc_id, text || CASE WHEN doc_id % 5 = 1 AND source <> 'src1' THEN ' edited' ELSE '' END AS text,
                  printf('doc_%04d.txt', doc_id) AS name
           FROM documents WHERE CASE WHEN source = 'src1' THEN doc_id % 10 = 0 ELSE doc_id % 7 <> 0 END),""" + _SUMMARY_SQL)
def q_kept_figures(spark, sf):
    """The figures of corpora after appends, replaced and dropped files, a dropped
    corpus and an append to it, none of them computed anew."""
    d = read_table(spark, sf, "documents").select(
        F.col("source").alias("corpus"), F.col("doc_id").alias("ord"), CV.doc_name(F.col("doc_id")).alias("name"),
        F.octet_length("text").alias("size"))
    kept = FG.CorpusFigures(spark, scratch_path(spark, "figures"))
    kept.append(d.where("ord % 3 = 0"))
    kept.append(d.where("ord % 3 <> 0"))
    kept.append(d.where("ord % 5 = 1").withColumn("size", F.col("size") + len(" edited")))
    kept.drop(d.where("ord % 7 = 0"))
    kept.drop_corpora(spark.createDataFrame([("src1",)], "corpus string"))
    kept.append(d.where("corpus = 'src1' AND ord % 10 = 0"))
    return _flat_files(kept.summary(AS_OF))


@register("page_pricing", f"""
WITH {_ITEMS_SQL}
SELECT target, count(*) AS pages_processed, 0.0015 AS price_per_page, 0.02 AS start_fee,
       CAST(round(0.02 + count(*) * 0.0015, 2) AS DOUBLE) AS estimated_total,
       CAST(0.02 AS DOUBLE) + CAST(count(*) AS DOUBLE) * CAST(0.0015 AS DOUBLE) AS estimated_total_unrounded
FROM items GROUP BY 1""")
def q_page_pricing(spark, sf):
    counts = DV.scattered_items(pages(spark, sf)).groupBy("target").agg(F.count(F.lit(1)).alias("pages_processed"))
    return CO.page_pricing(counts)


@register("tier_pricing", f"""
WITH {_ITEMS_SQL},
c AS (SELECT target, count(*) AS n FROM items GROUP BY 1)
SELECT c.target, c.n AS pages_processed, t.plan, t.discount,
       CAST(0.0015 * (1 - CAST(t.discount AS DECIMAL(18, 6))) AS DOUBLE) AS price_per_page,
       CAST(round(0.02 + c.n * 0.0015 * (1 - CAST(t.discount AS DECIMAL(18, 6))), 4) AS DOUBLE) AS estimated_total
FROM c CROSS JOIN {S.values(K.PRICE_TIERS, ['plan', 'discount'])}""")
def q_tier_pricing(spark, sf):
    counts = DV.scattered_items(pages(spark, sf)).groupBy("target").agg(F.count(F.lit(1)).alias("pages_processed"))
    return CO.tier_pricing(counts)


@register("run_counters", f"""
WITH {_ITEMS_SQL}
SELECT target, count(*) AS pages_scraped, CAST(count(resolved) AS BIGINT) AS documents_created,
       CAST(count(resolved) AS BIGINT) AS files_indexed
FROM resolved GROUP BY 1""")
def q_run_counters(spark, sf):
    return CO.run_counters(_items(spark, sf), "target", "content")


@register("total_cost", f"""
WITH {_DOCS_CTE},
idx AS (SELECT corpus, round((sum(strlen(document)) // 5) / 1e6 * 0.15, 4) AS index_cost FROM docs GROUP BY 1),
c AS (SELECT {S.host('url')} AS target, count(*) AS n FROM pages GROUP BY 1),
idxs AS (SELECT c.target AS corpus, coalesce(idx.index_cost, 0) AS index_cost
         FROM c LEFT JOIN idx ON idx.corpus = c.target)
SELECT c.target, t.plan, b.budget, c.n AS pages_processed,
       CAST(round(0.02 + c.n * 0.0015 * (1 - CAST(t.discount AS DECIMAL(18, 6))), 4) AS DOUBLE) AS estimated_total,
       CAST(round(c.n / 100 * CAST(b.rate AS DECIMAL(18, 6)), 4) AS DOUBLE) AS scraper_cost,
       idx.index_cost,
       CAST(round(round(0.02 + c.n * 0.0015 * (1 - CAST(t.discount AS DECIMAL(18, 6))), 4)
             + round(c.n / 100 * CAST(b.rate AS DECIMAL(18, 6)), 4) + CAST(idx.index_cost AS DECIMAL(18, 6)), 4)
            AS DOUBLE) AS total_usd
FROM c JOIN idxs idx ON idx.corpus = c.target
CROSS JOIN {S.values(K.PRICE_TIERS, ['plan', 'discount']).replace(' AS t(', ' AS t(')}
CROSS JOIN {S.values(K.SCRAPER_COST_PER_100_PAGES, ['budget', 'rate']).replace(' AS t(', ' AS b(')}""")
def q_total_cost(spark, sf):
    p = pages(spark, sf)
    counts = p.groupBy(host_of("url").alias("target")).agg(F.count(F.lit(1)).alias("pages_processed"))
    idx = (CO.indexing_cost_bytes(_docs(spark, sf), "document", by=["corpus"])
           .select(F.col("corpus").alias("target"), F.col("cost_estimate_usd").alias("index_cost")))
    costs = counts.join(idx, "target", "left").fillna(0.0, ["index_cost"])
    t = CO.total_cost(costs, F.col("index_cost"))
    return t.select("target", "plan", "budget", "pages_processed", "estimated_total", "scraper_cost",
                    "index_cost", "total_usd")


_MANIFEST_SQL = f"""{_DOCS_CTE},
manifest AS (
  SELECT corpus, doc_name AS name, corpus || '/' || doc_name AS path, strlen(document) AS size,
         '{AS_OF_ISO}' AS imported_at FROM docs)"""


@register("upload_manifest", f"""
WITH {_MANIFEST_SQL}
SELECT corpus, name, path, size, imported_at, path AS source_path, imported_at AS upload_date,
       CAST(size AS VARCHAR) AS file_size FROM manifest""")
def q_upload_manifest(spark, sf):
    m = CO.build_manifest(_docs(spark, sf), AS_OF)
    return m.select("corpus", "name", "path", "size", "imported_at",
                    F.col("custom_metadata")["source_path"].alias("source_path"),
                    F.col("custom_metadata")["upload_date"].alias("upload_date"),
                    F.col("custom_metadata")["file_size"].alias("file_size"))


@register("list_corpora", f"""
WITH {_MANIFEST_SQL}
SELECT 'corpora/' || corpus AS name, corpus AS display_name, min(imported_at) AS created_time,
       count(*) AS files, CAST(sum(size) AS BIGINT) AS total_size_bytes FROM manifest GROUP BY corpus""")
def q_list_corpora(spark, sf):
    return CO.list_corpora(CO.build_manifest(_docs(spark, sf), AS_OF))


@register("drop_corpora", f"""
WITH {_MANIFEST_SQL},
banned AS (SELECT DISTINCT {S.host('url')} AS corpus FROM pages WHERE {_banned_sql('lower(url)')})
SELECT corpus, name, size FROM manifest WHERE corpus NOT IN (SELECT corpus FROM banned)""")
def q_drop_corpora(spark, sf):
    m = CO.build_manifest(_docs(spark, sf), AS_OF)
    banned = PO.policy_audit(pages(spark, sf).select("url"), ("url",), _PAGE_PATTERNS).select(host_of("url").alias("corpus"))
    return CO.drop_corpora(m, banned).select("corpus", "name", "size")


@register("run_record", f"""
WITH {_ATTEMPTS_SQL},
wi AS (SELECT w.target, w.source_id, i.page_id, i.url, i.html FROM win w JOIN items i
         ON i.target = w.target AND i.rank = w.rank),
conv AS (SELECT target, source_id, page_id, coalesce(url, 'unknown-' || page_id) AS url, {S.title('html')} AS title,
                {S.clean_html('html')} AS text, length(html) > 0 AS has FROM wi),
agg AS (SELECT target, any_value(source_id) AS scraper_used, count(*) AS pages_scraped,
               CAST(count_if(has) AS BIGINT) AS documents_created,
               CAST(sum(CASE WHEN has THEN strlen({S.header('url', 'title', AS_OF_ISO)} || text) ELSE 0 END) AS BIGINT)
                 AS bytes
        FROM conv GROUP BY 1)
SELECT a.target, t.target_type, a.scraper_used, a.pages_scraped, a.documents_created,
       'stores/' || a.target AS corpus_store_name, '{K.DEFAULT_CORPUS_NAME}' AS corpus_corpus_name,
       a.documents_created AS corpus_files_indexed, '{K.STORAGE_TYPE}' AS corpus_storage_type,
       '{K.STORAGE_PERSISTENCE}' AS corpus_storage_persistence, TRUE AS corpus_globally_accessible,
       a.bytes // 5 AS corpus_estimated_tokens, round((a.bytes // 5) / 1e6 * 0.15, 4) AS corpus_cost_estimate_usd,
       '{K.PRICING_MODEL}' AS pricing_model, a.pages_scraped AS pricing_pages_processed, 0.0015 AS pricing_price_per_page,
       0.02 AS pricing_start_fee, CAST(round(0.02 + a.pages_scraped * 0.0015, 2) AS DOUBLE) AS pricing_estimated_total,
       '{K.PRICING_NOTE}' AS pricing_note, '{AS_OF_ISO}' AS created_at,
       '{K.QUERY_INSTRUCTIONS}' AS query_instructions
FROM agg a JOIN targets t ON t.target = a.target""")
def q_run_record(spark, sf):
    attempts, items = _attempts(spark, sf)
    return JB.flatten_record(JB.run_records(_targets(spark, sf), attempts, items, AS_OF))


@register("incremental_append", f"""
WITH existing AS (SELECT url, sha256(html) AS h FROM pages),
incoming AS (
  SELECT page_id, url, CASE WHEN contains(url, '/en/') THEN replace(html, '</article>', '<p>Updated.</p></article>')
                            ELSE html END AS html FROM pages)
SELECT page_id, url, sha256(html) AS content_sha256 FROM incoming i
WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.url = i.url AND e.h = sha256(i.html))""")
def q_incremental_append(spark, sf):
    p = pages(spark, sf)
    existing = p.select("url", F.col("html").alias("content"))
    incoming = DV.second_crawl(p).withColumnRenamed("html", "content")
    return CO.append_new_pages(existing, incoming).select("page_id", "url", "content_sha256")


_HASH_SUM = " + ".join(f"coalesce(lag(v, {j}) OVER w, 0) * {c}" for j, c in enumerate(PC.WEIGHTS))

# The bytes of both states of every document, the rolling sum at each byte, the cuts, the pieces.
_PIECES_CTE = f"""
t AS (SELECT 'first' AS batch, doc_id, coalesce(text, '') AS text FROM documents
      UNION ALL
      SELECT 'second', doc_id, coalesce(CASE WHEN doc_id % 2 = 0
             THEN substr(text, 1, length(text) // 2) || ' words added later ' || substr(text, length(text) // 2 + 1)
             ELSE text END, '') FROM documents),
hexed AS (SELECT batch, doc_id, text, hex(encode(text)) AS h FROM t),
bytes AS (SELECT batch, doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS x
          FROM (SELECT batch, doc_id, regexp_extract_all(h, '..') AS l FROM hexed)),
vals AS (SELECT batch, doc_id, i, (instr('0123456789ABCDEF', x[1]) - 1) * 16 + instr('0123456789ABCDEF', x[2]) - 1 AS v
         FROM bytes),
sums AS (SELECT batch, doc_id, i, ({_HASH_SUM}) % 4294967296 AS s FROM vals
         WINDOW w AS (PARTITION BY batch, doc_id ORDER BY i)),
hits AS (SELECT batch, doc_id, i AS e, lag(i) OVER (PARTITION BY batch, doc_id ORDER BY i) AS before
         FROM sums WHERE i >= {PC.WINDOW}
         AND (s::UBIGINT * {PC.SPREAD}::UBIGINT) % 4294967296 < {(1 << 32) // PC.SHARE}),
cuts AS (SELECT batch, doc_id, e FROM hits WHERE before IS NULL OR e - before >= {PC.MIN_BYTES}
         UNION SELECT batch, doc_id, length(h) // 2 FROM hexed WHERE h <> ''),
gaps AS (SELECT batch, doc_id, e, coalesce(lag(e) OVER (PARTITION BY batch, doc_id ORDER BY e), 0) AS p FROM cuts),
ends AS (SELECT batch, doc_id, e FROM cuts
         UNION SELECT batch, doc_id, unnest(range(p + {PC.MAX_BYTES}, e, {PC.MAX_BYTES})) FROM gaps),
spans AS (SELECT batch, doc_id, e, coalesce(lag(e) OVER (PARTITION BY batch, doc_id ORDER BY e), 0) AS p FROM ends),
pieces AS (SELECT s.batch, s.doc_id, s.p AS start, sha256(unhex(substr(h, 2 * p + 1, 2 * (e - p)))) AS sha256
           FROM spans s JOIN hexed USING (batch, doc_id))"""


def _piece_store(spark, sf) -> tuple[PC.PieceStore, str, str]:
    """Two states of the documents appended, the second one twice."""
    documents = read_table(spark, sf, "documents").select("doc_id", "text")
    store = PC.PieceStore(spark, scratch_path(spark, "pieces"))
    store.append(documents, "first", "doc_id")
    edited = DV.edited_documents(documents)
    store.append(edited, "second", "doc_id")
    store.append(edited, "second", "doc_id")
    return store, "first", "second"


@register("piece_append", f"""
WITH {_PIECES_CTE},
known AS (SELECT doc_id, count(*) AS n_pieces, count(*) FILTER (sha256 IN (SELECT sha256 FROM pieces WHERE batch = 'first'))
          AS n_known FROM pieces WHERE batch = 'second' GROUP BY 1)
SELECT doc_id, coalesce(n_pieces, 0) AS n_pieces, coalesce(n_known, 0) AS n_known, sha256(text) AS text_sha256
FROM hexed LEFT JOIN known USING (doc_id) WHERE batch = 'second'""")
def q_piece_append(spark, sf):
    """The second state of every document put together from its pieces, and how
    many of these the store held before."""
    store, first, second = _piece_store(spark, sf)
    recipes = store.recipes()
    held = recipes.where(F.col("batch") == first).select("sha256").distinct()
    known = recipes.where(F.col("batch") == second).join(held, "sha256", "left_semi").groupBy("key").agg(
        F.count(F.lit(1)).alias("n_known"))
    return store.texts(second).join(known, "key", "left").select(
        F.col("key").cast("long").alias("doc_id"), F.col("n_pieces").cast("long").alias("n_pieces"),
        F.coalesce("n_known", F.lit(0)).alias("n_known"), F.sha2("text", 256).alias("text_sha256"))


@register("stored_pieces", f"""
WITH {_PIECES_CTE}
SELECT sha256, count(*) AS n_uses FROM pieces GROUP BY 1""")
def q_stored_pieces(spark, sf):
    """Every piece the store holds (once each) and its uses in both states."""
    store, _, _ = _piece_store(spark, sf)
    uses = store.recipes().groupBy("sha256").agg(F.count(F.lit(1)).alias("n_uses"))
    return store.pieces().select(F.sha2("data", 256).alias("sha256")).join(uses, "sha256")


@register("stored_corpus", f"""
WITH {_DOCS_CTE}
SELECT page_id, corpus, doc_name, strlen(document) AS n_bytes, sha256(document) AS document_sha256 FROM docs""")
def q_stored_corpus(spark, sf):
    """Sink round trip: documents written partitioned by corpus bucket, read back."""
    path = scratch_path(spark, "corpus")
    CO.write_corpus(_docs(spark, sf).select("page_id", "doc_name", "document", "n_bytes", "corpus"), path,
                    mode="overwrite")
    back = spark.read.schema("page_id long, doc_name string, document string, corpus string, bucket int").parquet(path)
    return back.select("page_id", "corpus", "doc_name", F.octet_length("document").cast("long").alias("n_bytes"),
                       F.sha2("document", 256).alias("document_sha256"))


@register("text_sink", f"""
WITH {_DOCS_CTE}
SELECT sha256(document) AS document_sha256, count(*) AS records FROM docs GROUP BY 1""")
def q_text_sink(spark, sf):
    """The plain-text sink, one record per document, read back."""
    path = scratch_path(spark, "text")
    CO.write_text_files(_docs(spark, sf), path)
    return CO.read_text_files(spark, path).groupBy(F.sha2("document", 256).alias("document_sha256")).agg(
        F.count(F.lit(1)).alias("records"))


# ---------------------------------------------------------------------------
# Pages without a URL or a scheme: no row lost, none added
# ---------------------------------------------------------------------------

_NAMELESS_CTE = f"""
np AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN NULL WHEN page_id % 4 = 0
                            THEN regexp_replace(url, '^[a-z]+://', '') ELSE url END AS url, html FROM pages),
nconv AS (
  SELECT page_id, {S.host('url')} AS corpus, coalesce(url, 'unknown-' || page_id) AS url, {S.title('html')} AS title,
         {S.clean_html('html')} AS text, sha256(html) AS content_sha256
  FROM np WHERE length(html) > 0),
ndocs AS (
  SELECT *, printf('doc_%04d.txt', page_id) AS doc_name, {S.header('url', 'title', AS_OF_ISO)} || text AS document
  FROM nconv)"""


@register("nameless_manifest", f"""
WITH {_NAMELESS_CTE}
SELECT corpus, doc_name AS name, corpus || '/' || doc_name AS path, strlen(document) AS size FROM ndocs""")
def q_nameless_manifest(spark, sf):
    """The manifest of documents written and read back, with missing URLs."""
    path = scratch_path(spark, "corpus")
    CO.write_corpus(CV.convert_pages(DV.nameless_pages(pages(spark, sf)), AS_OF), path, mode="overwrite")
    return CO.build_manifest(spark.read.parquet(path), AS_OF).select("corpus", "name", "path", "size")


@register("nameless_summary", f"""
WITH {_NAMELESS_CTE}
SELECT corpus AS corpus_name, count(*) AS files_indexed, CAST(sum(strlen(document)) AS BIGINT) AS total_size_bytes
FROM ndocs GROUP BY 1""")
def q_nameless_summary(spark, sf):
    docs = CV.convert_pages(DV.nameless_pages(pages(spark, sf)), AS_OF)
    return CO.corpus_summary(docs, AS_OF).select("corpus_name", "files_indexed", "total_size_bytes")


@register("replayed_ingest", f"""
WITH {_NAMELESS_CTE}
SELECT page_id, corpus, url, content_sha256, strlen(document) AS n_bytes FROM ndocs""")
def q_replayed_ingest(spark, sf):
    """The same batch ingested twice: the second time adds nothing."""
    path = scratch_path(spark, "ingest")
    batch = DV.nameless_pages(pages(spark, sf))
    ST.ingest_batch(batch, path, AS_OF)
    ST.ingest_batch(batch, path, AS_OF)
    return ST.read_corpus(spark, path).select("page_id", "corpus", "url", "content_sha256", "n_bytes")


# ---------------------------------------------------------------------------
# Chunking
# ---------------------------------------------------------------------------

CHUNK_MAX, CHUNK_OVERLAP, CHUNK_SEP = 60, 15, "\n"


def _chunks(spark, sf):
    docs = read_table(spark, sf, "documents")
    return CH.chunk_documents(docs, "doc_id", "text", CHUNK_MAX, CHUNK_OVERLAP, CHUNK_SEP, keep=("source",))


@register("chunk_documents", S.chunks(CHUNK_MAX, CHUNK_OVERLAP) + """
SELECT doc_id, chunk_no, chunk, length(chunk) // 5 AS chunk_tokens FROM chunks""")
def q_chunk_documents(spark, sf):
    return _chunks(spark, sf).select("doc_id", "chunk_no", "chunk", "chunk_tokens")


@register("chunk_stats", S.chunks(CHUNK_MAX, CHUNK_OVERLAP) + """,
per_doc AS (SELECT source, doc_id, count(*) AS n, max(length(chunk) // 5) AS mx FROM chunks GROUP BY 1, 2)
SELECT source, count(*) AS documents, CAST(sum(n) AS BIGINT) AS chunks,
       CAST(count_if(n > 1) AS BIGINT) AS multi_chunk_documents, max(mx) AS max_chunk_tokens
FROM per_doc GROUP BY 1""")
def q_chunk_stats(spark, sf):
    return CH.chunk_stats(_chunks(spark, sf), "source", "doc_id")


# ---------------------------------------------------------------------------
# Retrieval
# ---------------------------------------------------------------------------

_TERMS = "regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}]+')"


def _bm25_sql(corpus_cte: str, key: str, text: str, k: int) -> str:
    """BM25 top-k of benchmark questions over ``corpus(key, text)``."""
    return f"""
{corpus_cte},
toks AS (SELECT {key} AS key, {_TERMS.format(x=text)} AS t FROM corpus),
post AS (SELECT key, term, count(*) AS tf, max(dl) AS dl
         FROM (SELECT key, len(t) AS dl, unnest(t) AS term FROM toks) GROUP BY 1, 2),
stats AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM toks),
q AS (SELECT DISTINCT item_id, unnest(list_distinct({_TERMS.format(x='text')})) AS term FROM benchmark),
df AS (SELECT term, count(*) AS df FROM post WHERE term IN (SELECT term FROM q) GROUP BY 1),
sc AS (SELECT q.item_id, p.key,
              round(sum(ln(1 + (s.n - df.df + 0.5) / (df.df + 0.5)) * p.tf * {K.BM25_K1 + 1}
                        / (p.tf + {K.BM25_K1} * (1 - {K.BM25_B} + {K.BM25_B} * p.dl / s.avgdl))), 6) AS score
       FROM q JOIN post p USING (term) JOIN df USING (term) CROSS JOIN stats s GROUP BY 1, 2),
hits AS (SELECT item_id, CAST(rank AS INTEGER) AS rank, key AS {key}, score FROM (
           SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, key) AS rank FROM sc)
         WHERE rank <= {k})"""


@register("term_index", S.chunks(CHUNK_MAX, CHUNK_OVERLAP) + f""",
toks AS (SELECT doc_id, chunk_no, {_TERMS.format(x='chunk')} AS t FROM chunks),
ex AS (SELECT doc_id, chunk_no, len(t) AS doc_len, unnest(t) AS term FROM toks)
SELECT doc_id, chunk_no, term, count(*) AS tf, max(doc_len) AS doc_len FROM ex GROUP BY 1, 2, 3""")
def q_term_index(spark, sf):
    idx = RT.build_term_index(_chunks(spark, sf), ["doc_id", "chunk_no"], "chunk")
    return idx.select("doc_id", "chunk_no", "term", "tf", F.col("doc_len").cast("long").alias("doc_len"))


KEYWORD_K = 5


@register("keyword_search", "WITH " + _bm25_sql("corpus AS (SELECT doc_id, text FROM documents)", "doc_id", "text",
                                                KEYWORD_K) + " SELECT * FROM hits")
def q_keyword_search(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    questions = read_table(spark, sf, "benchmark")
    return RT.bm25_search(docs, ["doc_id"], "text", questions, "item_id", "text", k=KEYWORD_K)


@register("store_search", "WITH " + _bm25_sql(
    "corpus AS (SELECT doc_id, text FROM documents WHERE source IN ('src0', 'src1', 'src2'))", "doc_id", "text",
    KEYWORD_K) + " SELECT * FROM hits")
def q_store_search(spark, sf):
    """Questions asked of three named stores."""
    docs = read_table(spark, sf, "documents").select("doc_id", "text", "source")
    return RT.bm25_search(docs, ["doc_id"], "text", read_table(spark, sf, "benchmark"), "item_id", "text",
                          k=KEYWORD_K, corpora=["src0", "src1", "src2"], corpus_col="source")


# an index that is kept: three crawls, edited documents in the last, then one store dropped
_INDEXED_CORPUS = """corpus AS (
  SELECT doc_id, CASE WHEN doc_id % 4 = 1 THEN text || ' ' || source || ' edited again' ELSE text END AS text
  FROM documents WHERE source IS DISTINCT FROM 'src1')"""


def _kept_index(spark, sf) -> IX.IndexStore:
    docs = dealt(read_table(spark, sf, "documents"), "doc_id").select("doc_id", "source", "text")
    store = IX.IndexStore(spark, scratch_path(spark, "index"), ["doc_id"], ["source"], fan_in=3)
    store.append(docs.where("doc_id % 3 = 0"))
    store.append(docs.where("doc_id % 3 <> 0"))
    store.append(docs.where("doc_id % 4 = 1").withColumn(
        "text", F.concat_ws(" ", "text", "source", F.lit("edited again"))))
    store.drop_where("source", spark.createDataFrame([("src1",)], "source string"))
    return store


@register("indexed_search", "WITH " + _bm25_sql(_INDEXED_CORPUS, "doc_id", "text", KEYWORD_K) + " SELECT * FROM hits")
def q_indexed_search(spark, sf):
    """Questions asked of an index after appends, replacements, a merge of its
    segments and a drop, without building it anew."""
    return _kept_index(spark, sf).search(read_table(spark, sf, "benchmark"), "item_id", "text", k=KEYWORD_K)


@register("indexed_documents", f"""
WITH {_INDEXED_CORPUS}
SELECT doc_id, CAST(len({_TERMS.format(x='text')}) AS BIGINT) AS doc_len FROM corpus""")
def q_indexed_documents(spark, sf):
    """The live documents of that index."""
    return _kept_index(spark, sf).documents().select("doc_id", F.col("doc_len").cast("long").alias("doc_len"))


_VECTOR_SQL = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
dims AS (SELECT label, i, avg(v[i]) AS x FROM (SELECT label, v, unnest(range(1, len(v) + 1)) AS i FROM e) GROUP BY 1, 2),
cen AS (SELECT label, list(x ORDER BY i) AS q FROM dims GROUP BY 1),
sims AS (SELECT c.label, e.vec_id,
                round(list_dot_product(c.q, e.v) / (sqrt(list_dot_product(c.q, c.q)) * sqrt(list_dot_product(e.v, e.v))), 6)
                  AS score
         FROM cen c CROSS JOIN e)
SELECT label, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM sims) WHERE rank <= 5"""


@register("vector_search", _VECTOR_SQL)
def q_vector_search(spark, sf):
    emb = read_table(spark, sf, "embeddings")
    queries = RT.centroids(emb.select("label", "embedding"), "label", "embedding")
    return RT.cosine_search(emb, "vec_id", "embedding", queries, "label", "embedding", k=5)


@register("cell_search", _VECTOR_SQL)
def q_cell_search(spark, sf):
    """The same through cells of vectors, skipped by the triangle inequality."""
    emb = read_table(spark, sf, "embeddings")
    queries = RT.centroids(emb.select("label", "embedding"), "label", "embedding")
    return VI.VectorIndex(emb, "vec_id", "embedding").search(queries, "label", "embedding", k=5)


CITATION_K = 3


@register("citations", f"WITH {_DOCS_CTE}, " + _bm25_sql("corpus AS (SELECT page_id, text FROM docs)", "page_id",
                                                          "text", CITATION_K).lstrip().lstrip(",") + """
SELECT h.item_id, h.rank, h.page_id, d.url, d.title, h.score FROM hits h JOIN docs d USING (page_id)""")
def q_citations(spark, sf):
    # the converted pages feed the index and the citation join: convert once
    docs = materialize(_docs(spark, sf).select("page_id", "url", "title", "text"))
    questions = read_table(spark, sf, "benchmark")
    hits = RT.bm25_search(docs.select("page_id", "text"), ["page_id"], "text", questions, "item_id", "text",
                          k=CITATION_K)
    return RT.citations(hits, docs, ["page_id"]).select("item_id", "rank", "page_id", "url", "title", "score")



@register("positional_index", """
WITH w AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[\\p{L}\\p{N}]+'), lambda x: lower(x)) AS w FROM documents),
e AS (SELECT doc_id, unnest(w) AS term, unnest(range(len(w))) AS place FROM w)
SELECT doc_id, term, string_agg(CAST(place AS VARCHAR), ',' ORDER BY place) AS positions FROM e GROUP BY 1, 2""")
def q_positional_index(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return PS.positional_postings(docs, ["doc_id"], "text").select(
        "doc_id", "term", F.array_join(F.transform("positions", lambda p: p.cast("string")), ",").alias("positions"))


@register("best_passages", "WITH " + _bm25_sql("corpus AS (SELECT doc_id, text FROM documents)", "doc_id", "text",
                                               CITATION_K) + """,
words AS (SELECT doc_id, text, list_transform(regexp_extract_all(text, '[\\p{L}\\p{N}]+'), lambda x: lower(x)) AS w,
                 regexp_extract_all(text, '[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+') AS tk
          FROM documents WHERE doc_id IN (SELECT doc_id FROM hits)),
occ AS (SELECT h.item_id, h.doc_id, q.term, o.place
        FROM hits h JOIN (SELECT doc_id, unnest(w) AS term, unnest(range(len(w))) AS place FROM words) o USING (doc_id)
        JOIN q ON q.item_id = h.item_id AND q.term = o.term),
nexts AS (SELECT s.item_id, s.doc_id, s.place AS first_word, t.term, min(t.place) AS nxt
          FROM occ s JOIN occ t ON t.item_id = s.item_id AND t.doc_id = s.doc_id AND t.place >= s.place
          GROUP BY 1, 2, 3, 4),
n AS (SELECT item_id, doc_id, count(DISTINCT term) AS n FROM occ GROUP BY 1, 2),
wins AS (SELECT x.item_id, x.doc_id, x.first_word, max(x.nxt) AS last_word
         FROM nexts x JOIN n ON n.item_id = x.item_id AND n.doc_id = x.doc_id GROUP BY 1, 2, 3, n.n HAVING count(*) = n.n),
best AS (SELECT * FROM wins QUALIFY row_number() OVER (PARTITION BY item_id, doc_id
                                                       ORDER BY last_word - first_word, first_word) = 1),
cut AS (SELECT h.item_id, h.rank, h.doc_id, b.first_word, b.last_word, w.tk,
               2 * b.first_word + CASE WHEN regexp_matches(w.tk[1], '^[\\p{L}\\p{N}]') THEN 0 ELSE 1 END AS a
        FROM hits h JOIN best b ON b.item_id = h.item_id AND b.doc_id = h.doc_id JOIN words w ON w.doc_id = h.doc_id)
SELECT item_id, rank, doc_id, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       length(array_to_string(tk[1:a], '')) AS start,
       array_to_string(tk[a + 1:a + 2 * (last_word - first_word) + 1], '') AS passage,
       length(array_to_string(tk[1:a + 2 * (last_word - first_word) + 1], '')) AS end
FROM cut""")
def q_best_passages(spark, sf):
    """The smallest passage of each hit that holds all of the question's terms
    that the document has."""
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    questions = read_table(spark, sf, "benchmark")
    hits = RT.bm25_search(docs, ["doc_id"], "text", questions, "item_id", "text", k=CITATION_K)
    hits = materialize(hits.select("item_id", "rank", "doc_id"))
    found = PS.best_passages(hits, docs, ["doc_id"], "text", questions, "item_id", "text")
    return found.withColumns({c: F.col(c).cast("long") for c in ("first_word", "last_word", "start", "end")})


@register("chunk_search", S.chunks(CHUNK_MAX, CHUNK_OVERLAP) + ", " + _bm25_sql(
    "corpus AS (SELECT doc_id * 100000 + chunk_no AS chunk_key, chunk FROM chunks)", "chunk_key", "chunk",
    KEYWORD_K).lstrip().lstrip(",") + """
SELECT h.item_id, h.rank, c.doc_id, c.chunk_no, c.source, h.score
FROM hits h JOIN chunks c ON c.doc_id * 100000 + c.chunk_no = h.chunk_key""")
def q_chunk_search(spark, sf):
    """Chunk-level retrieval: BM25 over the chunks of every document, cited
    by (document, chunk number, source)."""
    # the chunks feed the index, the corpus count and the citation join
    chunks = materialize(_chunks(spark, sf).select("doc_id", "chunk_no", "source", "chunk"))
    hits = RT.bm25_search(chunks, ["doc_id", "chunk_no"], "chunk", read_table(spark, sf, "benchmark"), "item_id",
                          "text", k=KEYWORD_K)
    cited = hits.join(chunks.select("doc_id", "chunk_no", "source"), ["doc_id", "chunk_no"])
    return cited.select("item_id", "rank", "doc_id", "chunk_no", "source", "score")


@register("passage_citations", S.chunks(
    CHUNK_MAX, CHUNK_OVERLAP, table="page_docs",
    before=f"{_DOCS_CTE}, page_docs AS (SELECT page_id AS doc_id, url AS source, text FROM docs),") + ", " + _bm25_sql(
    "corpus AS (SELECT doc_id * 100000 + chunk_no AS chunk_key, chunk FROM chunks)", "chunk_key", "chunk",
    CITATION_K).lstrip().lstrip(",") + """
SELECT h.item_id, h.rank, c.doc_id AS page_id, c.chunk_no, c.chunk, d.url, d.title, h.score
FROM hits h JOIN chunks c ON c.doc_id * 100000 + c.chunk_no = h.chunk_key JOIN docs d ON d.page_id = c.doc_id""")
def q_passage_citations(spark, sf):
    """The passages that answer a question, with the URL and title of their page."""
    docs = CV.convert_pages(dealt(pages(spark, sf), "page_id"), AS_OF)
    docs = materialize(docs.select("page_id", "url", "title", "text"))
    chunks = CH.chunk_documents(docs, "page_id", "text", CHUNK_MAX, CHUNK_OVERLAP, CHUNK_SEP, keep=("url", "title"))
    chunks = materialize(chunks.select("page_id", "chunk_no", "chunk", "url", "title"))
    hits = RT.bm25_search(chunks, ["page_id", "chunk_no"], "chunk", read_table(spark, sf, "benchmark"), "item_id",
                          "text", k=CITATION_K)
    cited = RT.citations(hits, chunks, ["page_id", "chunk_no"], ("chunk", "url", "title"))
    return cited.select("item_id", "rank", "page_id", "chunk_no", "chunk", "url", "title", "score")


# ---------------------------------------------------------------------------
# Streaming ingest
# ---------------------------------------------------------------------------

@register("stream_ingest", f"""
WITH c AS (
  SELECT page_id, coalesce(url, 'unknown-' || page_id) AS url, sha256(html) AS content_sha256,
         {S.title('html')} AS title, {S.clean_html('html')} AS text
  FROM pages WHERE length(html) > 0),
d AS (SELECT *, {S.header('url', 'title', AS_OF_ISO)} || text AS document FROM c)
SELECT page_id, {S.host('url')} AS corpus, printf('doc_%04d.txt', page_id) AS doc_name, url, title, document,
       content_sha256
FROM d""")
def q_stream_ingest(spark, sf):
    corpus = ST.run_ingest(spark, ST.table_files(table_path(sf, "pages")), AS_OF, glob="*")
    return corpus.select("page_id", "corpus", "doc_name", "url", "title", "document", "content_sha256")


FIRST_CRAWL, SECOND_CRAWL = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 8)


@register("page_changes", f"""
WITH c1 AS (SELECT page_id, url, sha256(html) AS h FROM pages WHERE page_id % 5 <> 1),
c2 AS (SELECT page_id, url, sha256(CASE WHEN contains(url, '/en/')
              THEN replace(html, '</article>', '<p>Updated.</p></article>') ELSE html END) AS h
       FROM pages WHERE page_id % 5 <> 2)
SELECT url, page_id, 'new' AS status, h AS content_sha256, '{FIRST_CRAWL}' AS crawled_at FROM c1
UNION ALL
SELECT c2.url, c2.page_id, CASE WHEN c1.url IS NULL THEN 'new' WHEN c1.h = c2.h THEN 'unchanged' ELSE 'changed' END,
       c2.h, '{SECOND_CRAWL}'
FROM c2 LEFT JOIN c1 ON c1.url = c2.url
UNION ALL
SELECT url, page_id, 'gone', h, '{FIRST_CRAWL}' FROM c1 WHERE url NOT IN (SELECT url FROM c2)""")
def q_page_changes(spark, sf):
    """Two crawls followed with state per URL: a fifth of the pages is missing in
    each, and pages under /en/ changed in between."""
    p = pages(spark, sf)
    one = p.where("page_id % 5 <> 1").withColumn("crawled_at", F.lit(FIRST_CRAWL))
    two = DV.second_crawl(p).where("page_id % 5 <> 2").withColumn("crawled_at", F.lit(SECOND_CRAWL))
    changes = SC.run_crawls(spark, [one, two], dt.timedelta(days=3))
    return changes.withColumn("crawled_at", F.col("crawled_at").cast("string"))


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
