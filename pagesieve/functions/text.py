"""Column expressions for plain-text work: whitespace, entities, title case.

All functions take and return ``Column`` objects built from Spark built-ins, so
they stay JVM-side and work the same in batch and streaming plans.
"""

from __future__ import annotations

import html.entities
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagesieve import constants as K

# Python's str.isspace() set, spelled out for Java regex: ASCII controls
# \t\n\x0B\f\r, the information separators \x1C-\x1F, NEL \x85 and every
# Unicode separator (\p{Z}: spaces, line and paragraph separators).
WS_CLASS = r"[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]"
# The same set without the newline (used for per-line right strip).
WS_NO_NL_CLASS = r"[\t\x0B\f\r\x1C-\x1F\x85\p{Z}]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Lambda bodies are evaluated per array element; referring to a large
    expression from inside one would recompute it for every element.
    """
    return F.transform(F.array(value), body)[0]


def py_strip(col) -> Column:
    """``str.strip()`` with Python's whitespace set."""
    return F.regexp_replace(_c(col), F.lit(rf"\A{WS_CLASS}+|{WS_CLASS}+\z"), F.lit(""))


def normalize_ws(col) -> Column:
    """Whitespace normalisation, in the documented order.

    tabs -> spaces; strip each line's right end; collapse runs of U+0020;
    three or more newlines -> two; strip both ends.
    """
    c = F.replace(_c(col), F.lit("\t"), F.lit(" "))
    c = F.regexp_replace(c, F.lit(rf"{WS_NO_NL_CLASS}+(?=\n|\z)"), F.lit(""))
    c = F.regexp_replace(c, F.lit(" {2,}"), F.lit(" "))
    c = F.regexp_replace(c, F.lit(r"\n{3,}"), F.lit("\n\n"))
    return py_strip(c)


# Entities that dominate real pages; checked before the full table.
_COMMON_ENTITIES = [
    ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"),
    ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&#39;", "'"),
]


@lru_cache(maxsize=1)
def _entity_table() -> str:
    """Named character references from the standard library's HTML5 table,
    packed into one string: \x01&name;\x02value\x01... A lookup is one
    ``instr`` over a single literal, instead of a 2,000-entry map expression
    copied into the plan at every use."""
    parts = [f"&{name}\x02{value}" for name, value in sorted(html.entities.html5.items()) if name.endswith(";")]
    return "\x01" + "\x01".join(parts) + "\x01"


def _named_entity(p: Column) -> Column:
    table = F.lit(_entity_table())
    key = F.concat(F.lit("\x01"), p, F.lit("\x02"))
    pos = F.instr(table, key)
    value = F.substring_index(F.substring(table, pos + F.length(key), 64), "\x01", 1)
    return F.when(pos > 0, value)


_ENTITY_TOKEN = r"&(?:#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,8}|[A-Za-z][A-Za-z0-9]{0,40});|[^&]+|&"


def _codepoint_to_str(n: Column) -> Column:
    # HTML replaces NUL, surrogates and values past U+10FFFF with U+FFFD.
    safe = (F.when(n.isNull() | (n <= 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF),
                   F.lit(0xFFFD)).otherwise(n))
    return F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")


def decode_entities(col) -> Column:
    """Decode character references once (``&amp;lt;`` -> ``&lt;``)."""
    c = _c(col)

    def piece(p: Column) -> Column:
        common = None
        for ent, val in _COMMON_ENTITIES:
            common = (F.when(p == F.lit(ent), F.lit(val)) if common is None
                      else common.when(p == F.lit(ent), F.lit(val)))
        body = F.regexp_extract(p, r"^&#([0-9]+);$", 1)
        hexbody = F.regexp_extract(p, r"^&#[xX]([0-9a-fA-F]+);$", 1)
        numeric = F.when(body != "", _codepoint_to_str(body.try_cast("long"))) \
            .when(hexbody != "", _codepoint_to_str(F.conv(hexbody, 16, 10).try_cast("long")))
        return (common
                .when(F.startswith(p, F.lit("&#")), F.coalesce(numeric, p))
                .when(F.startswith(p, F.lit("&")) & F.endswith(p, F.lit(";")),
                      F.coalesce(_named_entity(p), p))
                .otherwise(p))

    decoded = F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_ENTITY_TOKEN), 0), piece), "")
    return F.when(F.contains(c, F.lit("&")), decoded).otherwise(c)


def py_title_case(col) -> Column:
    """Python ``str.title()``: upper-case the first cased letter of each run
    of cased letters, lower-case the rest."""
    runs = F.regexp_extract_all(_c(col), F.lit(r"[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+"), 0)
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)),
                                             F.lower(F.substring(r, 2, 1 << 30)))), "")


def token_estimate(col) -> Column:
    """Tokens ~= characters // 5 (code points)."""
    return F.floor(F.length(_c(col)) / F.lit(K.CHARS_PER_TOKEN)).cast("long")


def iso_timestamp(ts) -> Column:
    """``datetime.isoformat()``: fraction only when microseconds are non-zero."""
    t = _c(ts)
    return F.when(F.date_format(t, "SSSSSS") == "000000", F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")) \
        .otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def metadata_header(url, title, scraped_at_iso) -> Column:
    """``---\\nSource: {url}\\nTitle: {title}\\nScraped: {iso}\\n---\\n\\n``."""
    return F.concat(F.lit("---\nSource: "), _c(url), F.lit("\nTitle: "), _c(title),
                    F.lit("\nScraped: "), _c(scraped_at_iso), F.lit("\n---\n\n"))
