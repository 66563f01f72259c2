"""HTML -> text as Spark column expressions.

One regex splits a page into tokens (comments, raw-text elements, tags, text
runs). A fold over the tag tokens finds the regions to drop (removed elements
and ad/tracking classes, nesting-aware); text tokens outside those regions are
decoded, stripped and joined with newlines. Everything is a built-in
expression, so it runs per row inside the executor with no Python worker and
no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagesieve import constants as K
from pagesieve.functions.text import _c, decode_entities, let, normalize_ws, py_strip, py_title_case

# Tokens, in priority order: comment; CDATA section (ignored); raw-text element (script/style/iframe,
# content is never markup); RCDATA element (title/textarea, content is text);
# quote-aware tag; unterminated tag; text run (a '<' that cannot open a tag
# is text, so "a <- b" stays one run).
# Attribute list of a tag; quoted values may hold '>'. Written with
# possessive char-class runs so that Java's matcher never recurses per char.
ATTRS = r"[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+"

TOKEN_RE = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\z)"
    r"|<(script|style|iframe|title|textarea)(?=[\s/>])" + ATTRS + r">.*?(?:</\1(?=[\s/>])[^>]*+>|\z)"
    r"|<[a-z/!?]" + ATTRS + r">"
    r"|<[a-z/!?][^>]*+>?"
    r"|(?:[^<]|<(?![a-z/!?]))[^<]*+(?:<(?![a-z/!?])[^<]*+)*+"
)

_AD_RE = "(?i)" + "|".join(K.AD_CLASS_PATTERNS)
# Block elements whose start tag closes an open <p>.
_P_CLOSERS = ["address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption",
              "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main",
              "menu", "nav", "ol", "p", "pre", "section", "table", "ul"]
# Containers whose end tag closes any element still open inside them.
_CONTAINERS = ["div", "section", "article", "main", "aside", "header", "footer", "nav", "body", "html", "ul",
               "ol", "li", "table", "tbody", "thead", "tr", "td", "th", "form", "dl", "dd", "dt", "figure",
               "blockquote"]
_BIG = 1 << 30
_REGION_T = "array<struct<s:int,e:int>>"


# The attributes before ``class``, each a name with an optional quoted or
# bare value, then the value of ``class`` as written.
CLASS_RE = (
    r"(?is)^<[a-z][^\s/>]*+(?:[\s/]++(?!class[\s=/>])[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"']*+))?+)*+"
    r"[\s/]++class\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]*+)"
)


def class_value(tag: Column) -> Column:
    """The class attribute of a tag: a quoted value up to its own quote, an
    unquoted one up to the next blank."""
    return let(F.regexp_extract(tag, CLASS_RE, 1), lambda raw: F.when(
        F.startswith(raw, F.lit('"')) | F.startswith(raw, F.lit("'")),
        F.substr(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw))


def tokenize(html) -> Column:
    """array<struct<i, t, kind, name, cls>>; kind: o(pen) c(lose) t(ext) r(cdata) x(ignored)."""
    toks = F.regexp_extract_all(_c(html), F.lit(TOKEN_RE), 0)

    def describe(t: Column, i: Column) -> Column:
        low2 = F.lower(F.substring(t, 1, 12))
        kind = (F.when(~F.startswith(t, F.lit("<")), F.lit("t"))
                .when(F.startswith(t, F.lit("<!")) | F.startswith(t, F.lit("<?")), F.lit("x"))
                .when(low2.rlike(r"^<(script|style|iframe)([\s/>]|$)"), F.lit("x"))
                .when(low2.rlike(r"^<(title|textarea)([\s/>]|$)"), F.lit("r"))
                .when(F.startswith(t, F.lit("</")), F.lit("c"))
                .when(t.rlike(r"^<[A-Za-z]"), F.lit("o"))
                .otherwise(F.lit("t")))
        name = F.lower(F.regexp_extract(t, r"^</?([A-Za-z][^\s/>]*)", 1))
        return F.struct(i.alias("i"), t.alias("t"), kind.alias("kind"), name.alias("name"),
                        class_value(t).alias("cls"))

    return F.transform(toks, describe)


def _regions(toks: Column, starts, first_only: bool = False) -> Column:
    """Token-index intervals [s, e] of elements whose open tag satisfies
    ``starts(token)``. The element ends at its matching end tag (same-name
    tags nested inside are matched by depth), or earlier where an HTML parser
    closes it implicitly: a <p> at the start of a block element, an <li> at
    the next sibling <li>, any element at the end tag of an enclosing
    container (only containers left open inside it keep that end tag to
    themselves). An element never closed runs to the end of the page."""
    tags = F.filter(toks, lambda x: (x["kind"] == "o") | (x["kind"] == "c"))
    # Closed regions are recorded as "s:e;" in a string: appending copies
    # bytes, where growing an array inside the fold would copy every element
    # on each append (quadratic in the number of regions).
    init = F.struct(F.lit(None).cast("string").alias("n"), F.lit(0).alias("d"), F.lit(0).alias("a"),
                    F.lit(0).alias("s"), F.lit("").alias("iv"))

    def record(iv, s, e):
        return F.concat(iv, s.cast("string"), F.lit(":"), e.cast("string"), F.lit(";"))

    def state(n, d, a, s, iv):
        return F.struct(n.alias("n"), d.alias("d"), a.alias("a"), s.alias("s"), iv.alias("iv"))

    def implicit_close(acc, x):
        inside = acc["n"].isNotNull() & (acc["a"] == 0)
        opening, closing = x["kind"] == "o", x["kind"] == "c"
        return inside & (
            ((acc["n"] == "p") & opening & x["name"].isin(*_P_CLOSERS))
            | ((acc["n"] == "li") & opening & (x["name"] == "li"))
            | (closing & (x["name"] != acc["n"]) & x["name"].isin(*_CONTAINERS)))

    def step(acc, x):
        idle = acc["n"].isNull()
        if first_only:
            idle = idle & (acc["iv"] == "")
        opens = idle & (x["kind"] == "o") & starts(x)
        same = acc["n"].isNotNull() & (x["name"] == acc["n"])
        other = acc["n"].isNotNull() & (x["name"] != acc["n"]) & x["name"].isin(*_CONTAINERS)
        depth = (F.when(opens, F.lit(1))
                 .when(same & (x["kind"] == "o"), acc["d"] + 1)
                 .when(same & (x["kind"] == "c"), acc["d"] - 1)
                 .otherwise(acc["d"]))
        inner = (F.when(opens, F.lit(0))
                 .when(other & (x["kind"] == "o"), acc["a"] + 1)
                 .when(other & (x["kind"] == "c"), F.greatest(acc["a"] - 1, F.lit(0)))
                 .otherwise(acc["a"]))
        closes = same & (x["kind"] == "c") & (acc["d"] <= 1)
        return state(
            F.when(opens, x["name"]).when(closes, F.lit(None).cast("string")).otherwise(acc["n"]),
            depth, inner, F.when(opens, x["i"]).otherwise(acc["s"]),
            F.when(closes, record(acc["iv"], acc["s"], x["i"])).otherwise(acc["iv"]))

    def merge(acc, x):
        # close implicitly first; the same token may then open a new region
        closed = state(F.lit(None).cast("string"), F.lit(0), F.lit(0), acc["s"], record(acc["iv"], acc["s"], x["i"]))
        return step(F.when(implicit_close(acc, x), closed).otherwise(acc), x)

    def finish(acc):
        return F.when(acc["n"].isNotNull(), record(acc["iv"], acc["s"], F.lit(_BIG))).otherwise(acc["iv"])

    spans = F.filter(F.split(F.aggregate(tags, init, merge, finish), ";"), lambda x: x != "")
    return F.transform(spans, lambda x: F.struct(F.split(x, ":")[0].cast("int").alias("s"),
                                                 F.split(x, ":")[1].cast("int").alias("e")))


def _is_removed(x) -> Column:
    void = x["name"].isin(*K.VOID_TAGS)
    return x["name"].isin(*K.REMOVED_TAGS) | ((~void) & (x["cls"] != "") & x["cls"].rlike(_AD_RE))


def _rc_text(t: Column) -> Column:
    return F.regexp_extract(t, r"(?is)^<[a-z]+(?=[\s/>])" + ATTRS + r">(.*?)(?:</(?:title|textarea)(?=[\s/>])[^>]*>)?$", 1)


def _node_text(x) -> Column:
    return F.when(x["kind"] == "r", _rc_text(x["t"])).otherwise(x["t"])


def _outside(toks: Column, drop: Column) -> Column:
    """Tokens outside the dropped intervals. The intervals are sorted and
    disjoint, so the kept tokens are the gaps between them: one slice per gap,
    flattened (linear in the page, whatever the number of regions)."""
    n_iv = F.size(drop)
    last = F.size(toks) - 1

    def gap(j):
        a = F.when(j == 0, F.lit(0)).otherwise(F.element_at(drop, j)["e"] + 1)
        b = F.when(j == n_iv, last).otherwise(F.element_at(drop, j + 1)["s"] - 1)
        return F.slice(toks, a + 1, F.greatest(b - a + 1, F.lit(0)))

    return F.flatten(F.transform(F.sequence(F.lit(0), n_iv), gap))


def text_from_tokens(toks: Column, drop: Column | None = None, sep: str = "\n") -> Column:
    """Join stripped, decoded text nodes outside the ``drop`` intervals."""
    kept = toks if drop is None else _outside(toks, drop)
    nodes = F.filter(kept, lambda x: (x["kind"] == "t") | (x["kind"] == "r"))
    stripped = F.transform(nodes, lambda x: py_strip(decode_entities(_node_text(x))))
    return F.array_join(F.filter(stripped, lambda s: s != ""), sep)


def clean_tokens(toks: Column) -> Column:
    """Text of a token array after removing tags, ad blocks and whitespace noise."""
    return let(toks, lambda t: let(_regions(t, _is_removed),
                                   lambda drop: normalize_ws(text_from_tokens(t, drop))))


def clean_html(html) -> Column:
    """HTML -> clean text (removed elements and ad classes dropped, one line
    per text node, whitespace normalised)."""
    return clean_tokens(tokenize(html))


# --------------------------------------------------------------------------
# Title
# --------------------------------------------------------------------------

_CONTENT_ATTR_RE = r"(?is)\scontent\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
# Path of a URL as urlparse sees it: optional scheme, optional //netloc,
# then everything up to '?' or '#'; ';params' of the last segment dropped.
_URL_PATH_RE = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


def url_basename_title(url) -> Column:
    """Last path segment of a URL, '-'/'_' -> space, Python title case."""
    u = F.regexp_replace(_c(url), r"[\t\r\n]", "")
    u = F.regexp_replace(u, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    path = F.regexp_extract(u, _URL_PATH_RE, 1)
    path = F.regexp_replace(path, r";[^/]*$", "")
    base = F.regexp_extract(F.regexp_replace(path, r"/+$", ""), r"([^/]*)$", 1)
    words = F.translate(base, "-_", "  ")
    return F.when(base != "", py_title_case(words)).otherwise(F.lit("Untitled"))


_OG_PROP_RE = r"(?is)\sproperty\s*=\s*(?:\"og:title\"|'og:title'|og:title(?=[\s/>]))"


def title_from_tokens(toks: Column, url) -> Column:
    """struct(title, source), source in title | h1 | og | url | untitled.

    Works on the token array, so markup inside comments, scripts and styles
    is never mistaken for a title. <title> wins when it holds any text (a
    blank one gives an empty title); then the first <h1> (its text nodes
    stripped and concatenated, even if empty); then the first og:title meta
    with a non-empty content; then the URL's last path segment."""
    t_tok = F.try_element_at(F.filter(toks, lambda x: (x["kind"] == "r") & (x["name"] == "title")), F.lit(1))
    t_raw = F.coalesce(_rc_text(t_tok["t"]), F.lit(""))
    tags = F.filter(toks, lambda x: (x["kind"] == "o") | (x["kind"] == "c"))
    h1 = F.try_element_at(F.filter(tags, lambda x: (x["kind"] == "o") & (x["name"] == "h1")), F.lit(1))

    def h1_text(start):
        return let(_element_end(tags, start), lambda end: text_from_tokens(
            F.filter(toks, lambda x: (x["i"] > start["i"]) & (x["i"] < end)), sep=""))

    og_tag = F.coalesce(F.try_element_at(F.filter(tags, lambda x: (x["kind"] == "o") & (x["name"] == "meta")
                                                  & x["t"].rlike(_OG_PROP_RE)), F.lit(1))["t"], F.lit(""))
    og_val = decode_entities(F.concat(F.regexp_extract(og_tag, _CONTENT_ATTR_RE, 1),
                                      F.regexp_extract(og_tag, _CONTENT_ATTR_RE, 2),
                                      F.regexp_extract(og_tag, _CONTENT_ATTR_RE, 3)))
    url_title = url_basename_title(url)
    has_og = (og_tag != "") & (og_val != "")
    title = (F.when(t_raw != "", py_strip(decode_entities(t_raw)))
             .when(h1.isNotNull(), let(h1, h1_text))
             .when(has_og, py_strip(og_val))
             .otherwise(url_title))
    source = (F.when(t_raw != "", F.lit("title"))
              .when(h1.isNotNull(), F.lit("h1"))
              .when(has_og, F.lit("og"))
              .when(url_title != "Untitled", F.lit("url"))
              .otherwise(F.lit("untitled")))
    return F.struct(title.alias("title"), source.alias("source"))


def title_parts(html, url) -> Column:
    """struct(title, source) of a page (see ``title_from_tokens``)."""
    return let(tokenize(html), lambda t: title_from_tokens(t, _c(url)))


def extract_title(html, url) -> Column:
    return title_parts(html, url)["title"]


# --------------------------------------------------------------------------
# Main content
# --------------------------------------------------------------------------

def _element_end(tags: Column, start: Column) -> Column:
    """Index of the tag closing the element opened at ``start`` (depth count
    over same-name tags only); past the end when it is never closed."""
    same = F.filter(tags, lambda x: (x["name"] == start["name"]) & (x["i"] >= start["i"]))
    init = F.struct(F.lit(0).alias("d"), F.lit(None).cast("int").alias("e"))

    def merge(acc, x):
        d = acc["d"] + F.when(x["kind"] == "o", 1).otherwise(-1)
        return F.struct(F.when(acc["e"].isNull(), d).otherwise(acc["d"]).alias("d"),
                        F.when(acc["e"].isNull() & (d <= 0), x["i"]).otherwise(acc["e"]).alias("e"))

    return F.aggregate(same, init, merge, lambda acc: F.coalesce(acc["e"], F.lit(_BIG)))


def _class_search(pattern: str):
    def pred(x):
        return (x["cls"] != "") & x["cls"].rlike("(?i)" + pattern)
    return pred


def main_content_tokens(toks: Column) -> Column:
    """Tokens of the main content: first <main>, else <article>, else the
    first element whose class searches 'content' (then 'documentation'), else
    <body>, else the page without its head."""
    tags = F.filter(toks, lambda x: (x["kind"] == "o") | (x["kind"] == "c"))
    opens = F.filter(tags, lambda x: x["kind"] == "o")
    cands = [lambda x: x["name"] == "main", lambda x: x["name"] == "article"]
    cands += [_class_search(pat) for pat in K.CONTENT_CLASS_PATTERNS]
    cands.append(lambda x: x["name"] == "body")
    first = F.coalesce(*[F.try_element_at(F.filter(opens, c), F.lit(1)) for c in cands])
    first_head = F.try_element_at(F.filter(opens, lambda x: x["name"] == "head"), F.lit(1))

    def pick(start, head):
        def bounds(end, head_end):
            inside = F.filter(toks, lambda x: (x["i"] >= start["i"]) & (x["i"] <= end))
            no_head = F.filter(toks, lambda x: (x["kind"] != "r")
                               & (head.isNull() | (x["i"] < head["i"]) | (x["i"] > head_end)))
            return F.when(start.isNotNull(), inside).otherwise(no_head)
        return let(_element_end(tags, start), lambda end: let(_element_end(tags, head),
                                                                lambda head_end: bounds(end, head_end)))

    return let(first, lambda start: let(first_head, lambda head: pick(start, head)))


def main_content_text(html) -> Column:
    """Clean text of the main content area of a page."""
    return clean_tokens(main_content_tokens(tokenize(html)))
