"""Building blocks for the DuckDB oracle statements.

These are independent restatements of the operators in plain SQL (RE2
regexes, list lambdas, recursive CTEs). They are used only to check the Spark
jobs; they are not an execution path of the library.
"""

from __future__ import annotations

from pagesieve import constants as K

NL = "chr(10)"
# Python's whitespace set in RE2 syntax, with and without the newline.
WS = r"[\t\n\x0B\f\r\x1C-\x1F\x{85}\pZ]"
WS_NO_NL = r"[\t\x0B\f\r\x1C-\x1F\x{85}\pZ]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def normalize_ws(x: str) -> str:
    s = f"replace({x}, chr(9), ' ')"
    s = f"regexp_replace({s}, '{WS_NO_NL}+\\n', {NL}, 'g')"
    s = f"regexp_replace({s}, '{WS_NO_NL}+$', '')"
    s = f"regexp_replace({s}, ' {{2,}}', ' ', 'g')"
    s = f"regexp_replace({s}, '\\n{{3,}}', {NL} || {NL}, 'g')"
    return strip(s)


def decode_entities(x: str) -> str:
    s = x
    for ent, val in [("&quot;", "'\"'"), ("&copy;", "'©'"), ("&middot;", "'·'"), ("&lt;", "'<'"),
                     ("&gt;", "'>'"), ("&nbsp;", "chr(160)"), ("&#39;", "''''"), ("&apos;", "''''")]:
        s = f"replace({s}, '{ent}', {val})"
    return f"replace({s}, '&amp;', '&')"


def drop_blocks(x: str, tags) -> str:
    s = x
    for tag in tags:
        s = f"regexp_replace({s}, '(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>', {NL}, 'g')"
    return s


def drop_ad_blocks(x: str, tag: str = "div") -> str:
    pat = "|".join(K.AD_CLASS_PATTERNS)
    return (f"regexp_replace({x}, '(?is)<{tag}\\b[^>]*\\sclass=\"[^\"]*(?:{pat})[^\"]*\"[^>]*>.*?</{tag}\\s*>', "
            f"{NL}, 'g')")


def nodes_to_text(x: str, sep: str = NL) -> str:
    """Tags -> line breaks, then per line decode + strip, drop empties, join."""
    s = f"regexp_replace({x}, '<[^>]*>', {NL}, 'g')"
    lines = f"list_transform(string_split({s}, {NL}), lambda l: {strip(decode_entities('l'))})"
    return f"array_to_string(list_filter({lines}, lambda l: l <> ''), {sep})"


def clean_html(x: str, ad_blocks: bool = False) -> str:
    s = f"regexp_replace({x}, '(?s)<!--.*?-->', {NL}, 'g')"
    s = drop_blocks(s, ["script", "style"])
    s = drop_blocks(s, ["nav", "footer", "iframe", "noscript"])
    if ad_blocks:
        s = drop_ad_blocks(s)
    return normalize_ws(nodes_to_text(s))


def title(x: str) -> str:
    return strip(decode_entities(f"regexp_extract({x}, '(?is)<title[^>]*>(.*?)</title', 1)"))


def host(url: str) -> str:
    scheme = "^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//"
    return (f"coalesce(nullif(lower(CASE WHEN regexp_matches({url}, '{scheme}') "
            f"THEN regexp_extract({url}, '{scheme}([^/?#:]*)', 1) "
            f"ELSE regexp_extract({url}, '^([^/?#:]+)', 1) END), ''), 'no-host')")


def header(url: str, title_: str, iso: str) -> str:
    return (f"'---' || {NL} || 'Source: ' || {url} || {NL} || 'Title: ' || {title_} || {NL} || "
            f"'Scraped: ' || {q(iso)} || {NL} || '---' || {NL} || {NL}")


def classify(url: str) -> str:
    u = f"lower({url})"
    parts = []
    for kind, pats in K.URL_TYPE_RULES:
        cond = " OR ".join(f"contains({u}, {q(p)})" for p in pats)
        parts.append(f"WHEN {cond} THEN {q(kind)}")
    return f"(CASE {' '.join(parts)} ELSE {q(K.DEFAULT_TARGET_TYPE)} END)"


def values(rows, cols) -> str:
    """Inline VALUES table."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, (int, float)):
            return repr(v)
        if isinstance(v, (list, tuple)):
            return "[" + ", ".join(lit(e) for e in v) + "]"
        return q(str(v))
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


def chunks(max_tokens: int, overlap: int, sep_sql: str = NL, table: str = "documents", before: str = "") -> str:
    """WITH RECURSIVE ... defining ``chunks(doc_id, chunk_no, chunk)`` over
    ``table`` (doc_id, source, text), which ``before`` may define. Paragraph prefix sums C(i); from state (start s, last
    appended a) the next cut is the first i > a with C(i) - C(s-1) > max, and
    the next start is the first j in [s, cut) with C(cut-1) - C(j-1) <= overlap
    (else the cut itself)."""
    return f"""
WITH RECURSIVE {before}
d AS (SELECT doc_id, source, text, string_split(text, {sep_sql}) AS ps FROM {table}),
long_docs AS (SELECT * FROM d WHERE length(text) // 5 > {max_tokens}),
cp AS MATERIALIZED (
  SELECT doc_id, i, c, c - n AS cprev FROM (
    SELECT doc_id, i, n, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS c FROM (
      SELECT doc_id, i, length(ps[i]) // 5 AS n
      FROM (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM long_docs)))),
walk(doc_id, chunk_no, s, a, nxt) AS (
  SELECT doc_id, 0, 1, 1, (SELECT min(q.i) FROM cp q WHERE q.doc_id = l.doc_id AND q.i > 1 AND q.c > {max_tokens})
  FROM long_docs l
  UNION ALL
  SELECT doc_id, chunk_no + 1, s2, nxt,
         (SELECT min(q.i) FROM cp q, cp z WHERE q.doc_id = w2.doc_id AND z.doc_id = w2.doc_id AND z.i = w2.s2
                 AND q.i > w2.nxt AND q.c - z.cprev > {max_tokens})
  FROM (SELECT w.doc_id, w.chunk_no, w.nxt,
               coalesce((SELECT min(j.i) FROM cp j, cp b WHERE j.doc_id = w.doc_id AND b.doc_id = w.doc_id
                           AND b.i = w.nxt AND j.i >= w.s AND j.i < w.nxt AND b.cprev - j.cprev <= {overlap}),
                        w.nxt) AS s2
        FROM walk w WHERE w.nxt IS NOT NULL) w2),
chunks AS (
  SELECT w.doc_id, l.source, CAST(w.chunk_no AS INTEGER) AS chunk_no,
         array_to_string(list_slice(l.ps, w.s, coalesce(w.nxt - 1, len(l.ps))), {sep_sql}) AS chunk
  FROM walk w JOIN long_docs l USING (doc_id)
  UNION ALL
  SELECT doc_id, source, 0, text FROM d WHERE length(text) // 5 <= {max_tokens})
"""
