"""Main text of web pages with a suffix array per host.

A page is read into blocks (runs of text between block elements) with what the
markup says about each: part of the article, part of something else by its
element or class (menu, footer, advert, ...), or nothing. The token streams of
a host's pages, block borders included, are concatenated and sorted as suffixes;
substrings of at least ``MIN_TOKENS`` tokens that stand on ``MIN_PAGES`` or more
distinct pages are boilerplate of the host, and a block most of whose tokens
they cover is removed unless the markup says it is the article: a text that two
pages of a host publish alike is still their article. Pages of equal ids, and
copies of a page (pages of equal main streams), are not distinct, and a page
never loses all its blocks in this way. The other blocks, unique runs of text,
stay.

A class or id counts by its whole name (``related``, ``cookie-notice``), never
by a word in it, and an element that holds the page's article or most of its
text is never left out for its name.

Repeats are counted over the whole host. A host of at most twice
``PAGES_PER_GROUP`` pages is read at once. Of a larger one, each page gives the
hashes of its substrings of ``MIN_TOKENS`` tokens; those on ``MIN_PAGES`` pages
of the host are sent to the tasks that read its pages, ``PAGES_PER_GROUP`` at a
time. Hosts all of whose pages mark their article need no counting. Hosts with
more than 1 / ``HOT_SHARE`` of all pages, at most ``HOT_SHARE`` of them, are
dealt out over several tasks, which changes no result.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesieve.llm import arrowtext as A
from pagesieve.llm.tables import materialize

MIN_TOKENS = 6
MIN_PAGES = 3
COVERED = 0.7
PAGES_PER_GROUP = 256
HOT_SHARE = 2000
PAGES_PER_TASK = 2048
PAGES_PER_COUNT = 256
BROADCAST_HOSTS = 100_000

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*'|["'])*+)>""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")

RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "template", "svg", "math", "object", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
NOT_MAIN = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "head", "fieldset",
            "audio", "video", "canvas"}
NOT_MAIN_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog",
                  "menu", "menubar", "form", "toolbar"}
COMMENT_NAMES = {"comment", "comments", "disqus", "reply", "replies", "respond", "comments-area", "comment-area",
                 "comment-list", "comments-list", "commentlist", "comment-section", "comments-section",
                 "comment-respond", "comment-form", "comments-wrapper", "comments-container", "user-comments",
                 "post-comments", "article-comments", "disqus-thread", "disqus-comments"}
NOT_MAIN_NAMES = COMMENT_NAMES | {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsbygoogle", "sponsor", "sponsored", "promo",
    "promotion", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "header",
    "masthead", "topbar", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal",
    "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "related",
    "recommended", "widget", "toolbar", "pagination", "pager", "legal", "copyright", "banner", "disclaimer", "teaser",
    "teasers",
    "ad-banner", "ad-box", "ad-container", "ad-slot", "ad-unit", "ad-wrapper", "banner-ad", "google-ad", "google-ads",
    "cookie-banner", "cookie-bar", "cookie-consent", "cookie-message", "cookie-notice", "cookie-notification",
    "cookie-popup", "cookies-banner", "consent-banner", "gdpr-banner", "gdpr-consent",
    "site-header", "site-footer", "site-nav", "site-navigation", "site-menu", "page-footer", "main-nav",
    "main-navigation", "main-menu", "nav-bar", "nav-menu", "nav-links", "navbar-nav", "top-nav", "top-bar", "top-menu",
    "side-bar", "side-nav", "side-menu", "left-sidebar", "right-sidebar", "sidebar-left", "sidebar-right",
    "primary-sidebar", "footer-nav", "footer-links", "footer-menu", "footer-widgets", "post-navigation",
    "share-bar", "share-buttons", "share-links", "sharing-buttons", "social-bar", "social-buttons", "social-icons",
    "social-links", "social-media", "social-share", "social-sharing", "related-articles", "related-content",
    "related-links", "related-posts", "related-stories", "recommended-articles", "recommended-posts",
    "newsletter-box", "newsletter-form", "newsletter-signup", "signup-form", "login-form", "subscribe-box",
    "subscribe-form", "legal-notice", "widget-area", "modal-dialog"}
TEASERS = {"teaser", "related", "promo", "sponsored", "ad"}
TITLES = {"h1", "h2", "h3", "h4", "h5", "h6"}
LISTS = {"ul", "ol", "dl", "menu"}
CONTAINERS = {"div", "ul", "ol", "dl", "table", "form"}  # inside the main text, only their ids are names of parts
HEADINGS = {"header"}  # an article's own header holds its title

OTHER, OPEN, MAIN, ARTICLE = range(4)


@dataclass
class Block:
    text: str
    kind: int
    linked: int  # characters inside links
    listed: bool = False  # in a list, and no heading or paragraph


def names(value: str) -> set[str]:
    return set(value.lower().replace("_", "-").split())


def signals(tag: str, attributes: str, in_article: bool, in_main: bool = False) -> tuple[bool, bool, bool]:
    """Whether an element is no part of the main text; whether it holds
    readers' comments; whether no more than its name, or that it is a form,
    says that it is no part."""
    by_tag = tag in NOT_MAIN and not (in_article and tag in HEADINGS)
    if not attributes or "=" not in attributes:
        return by_tag, False, tag in ("form", "fieldset")
    if tag in ("html", "body", "main"):
        return False, False, False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    words = names(found.get("class", ""))
    # ids of headings, and of sections and paragraphs of the main text, are made from their titles
    if tag not in TITLES and not ((in_article or in_main) and (tag not in CONTAINERS or "section" in words)):
        words |= names(found.get("id", ""))
    comments = bool(words & COMMENT_NAMES)
    if tag == "article":
        return comments or bool(words & TEASERS), comments, True
    named = words & NOT_MAIN_NAMES - (HEADINGS if in_article else set())
    sure = by_tag and tag not in ("form", "fieldset") or found.get(
        "role", "").lower() in NOT_MAIN_ROLES or found.get("aria-hidden", "").lower() == "true" or bool(
        re.search(r"\bhidden\b", re.sub(r"""=\s*("[^"]*"|'[^']*')""", "", attributes)))
    return by_tag or sure or bool(named), comments, not sure


def read_blocks(page: str) -> list[Block]:
    """The blocks of a page in order, with character references decoded and
    white space turned into single blanks."""
    blocks, doubtful = read_once(page, frozenset())
    if doubtful:
        free = wrappers(page, max((b.kind for b in blocks), default=OTHER) >= MAIN)
        if free:
            blocks, _ = read_once(page, free)
    return blocks


def tags(page: str) -> Iterator[tuple[int, int, re.Match | None]]:
    """(start and end of the text before a tag, the tag); the last without a
    tag. Raw elements come as their start tag only."""
    at = 0
    while True:
        found = TAG.search(page, at)
        if not found:
            yield at, len(page), None
            return
        start, at = at, found.end()
        tag = (found[2] or "").lower()
        if tag in RAW and not found[1] and not found[3].endswith("/"):
            over = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            at = page.find(">", over.start()) + 1 if over else len(page)
            at = at or len(page)
        yield start, found.start(), found


def wrappers(page: str, marked: bool) -> frozenset[int]:
    """Places of the elements that are out by their name only but wrap most of
    the page's text or, when no other text is ``marked`` as article or main, its
    article. Elements for comments count only when none is marked."""
    text, borders, articles = 0, 0, 0  # before the place: characters of text, block elements, articles
    open_tags: dict[str, list[tuple[int, bool, bool, int, int, int]]] = {}
    closed: list[tuple[int, bool, bool, int, int, int]] = []

    def over(element: tuple[int, bool, bool, int, int, int]) -> None:
        place, out, comments, *before = element
        if out:
            closed.append((place, out, comments, text - before[0], borders - before[1], articles - before[2]))

    for start, end, found in tags(page):
        text += len("".join(page[start:end].split()))
        if not found or not found[2]:
            continue
        tag = found[2].lower()
        if tag in RAW or tag in VOID or tag == "p":
            borders += tag == "p"
            continue
        if found[1]:
            if open_tags.get(tag):
                over(open_tags[tag].pop())
            continue
        borders += tag not in INLINE
        out, comments, weak = signals(tag, found[3], bool(open_tags.get("article")), bool(open_tags.get("main")))
        if tag in ("article", "main") and not out:
            articles += 1
        open_tags.setdefault(tag, []).append((found.start(), out and weak, comments, text, borders, articles))
    for left in open_tags.values():
        for element in left:
            over(element)
    return frozenset(place for place, _, comments, own, inside, holds in closed if not (comments and marked) and (
        (2 * own > text and inside > 0) or (holds > 0 and not marked)))


def read_once(page: str, free: frozenset[int]) -> tuple[list[Block], bool]:
    """The blocks, and whether elements that were left out for their name only
    may be ``wrappers``. Elements that start at a place of ``free`` are not left
    out."""
    by_name, length, dropped, doubtful = False, 0, 0, False
    blocks: list[Block] = []
    parts: list[str] = []
    state = {"article": 0, "main": 0, "link": 0, "linked": 0, "list": 0}
    leaf = ""  # the last block element that began or ended
    skip: tuple[str, bool] | None = None  # element that is left out, whether it holds comments
    depth = 0

    def close() -> None:
        text = " ".join(html_lib.unescape("".join(parts)).split())
        if text:
            kind = OTHER if skip and skip[0] not in INLINE else ARTICLE if state["article"] else MAIN if state["main"] else OPEN
            blocks.append(Block(text, kind, state["linked"], state["list"] > 0 and leaf not in TITLES and leaf != "p"))
        parts.clear()
        state["linked"] = 0

    def add(text: str) -> None:
        nonlocal length, dropped
        own = len("".join(text.split()))
        length += own
        dropped += own if skip and by_name else 0
        if text and not (skip and skip[0] in INLINE):  # an inline element that is left out does not cut its block
            parts.append(text)
            if state["link"]:
                state["linked"] += len(text)

    for start, end, found in tags(page):
        add(page[start:end])
        if not found or not found[2]:
            continue
        tag, ends, attributes = found[2].lower(), bool(found[1]), found[3]
        if tag in RAW:
            if not ends and not attributes.endswith("/"):
                parts.append(" ")
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag == "a":
            state["link"] = max(0, state["link"] + (-1 if ends else 1))
        border = tag not in INLINE
        if border:
            close()
            state["link"] = state["link"] if tag == "a" else 0
            leaf = "" if ends else tag
            if tag in LISTS:
                state["list"] = max(0, state["list"] + (-1 if ends else 1))
        if skip:
            doubtful |= by_name and skip[1] and tag in ("article", "main") and not ends
            # the element ends with its own end tag; a paragraph also at the next block; the article ends a region
            # that was never closed
            if tag == skip[0]:
                depth += -1 if ends else tag not in VOID
                if tag == "p" and not ends:
                    depth = 0
            elif skip[0] == "p" and border or tag in ("article", "main") and not ends and not skip[1]:
                depth = 0
            if depth <= 0:
                skip = None
                if ends and tag not in ("article", "main", "p"):
                    continue
            else:
                continue
        if tag in ("article", "main"):
            out, comments, weak = signals(tag, attributes, state["article"] > 0) if not ends else (False, False, False)
            if out and found.start() not in free:
                by_name = weak
                close()
                skip, depth = (tag, comments), 1
            else:
                state[tag] = max(0, state[tag] + (-1 if ends else 1))
            continue
        if not ends and tag not in VOID:
            out, comments, weak = signals(tag, attributes, state["article"] > 0, state["main"] > 0)
            if out and found.start() not in free:
                by_name = weak
                skip, depth = (tag, comments), 1
    close()
    return blocks, doubtful or 2 * dropped > length


def covered_tokens(tokens: np.ndarray, pages: np.ndarray, min_tokens: int = MIN_TOKENS,
                   min_pages: int = MIN_PAGES, contents: np.ndarray | None = None) -> np.ndarray:
    """For each token of the concatenated streams, whether it lies in a
    substring of ``min_tokens`` tokens that stands on ``min_pages`` distinct
    pages. ``pages`` holds each token's page number, in ascending order. With
    ``contents``, the numbers of the pages' main streams, so many of them must
    be distinct too.

    The suffixes are sorted by doubling: ranks by 2^k tokens from ranks by
    2^(k-1), up to ``min_tokens`` tokens (the last step overlaps)."""
    n = len(tokens)
    covered = np.zeros(n, bool)
    if n < min_tokens:
        return covered
    _, rank = np.unique(tokens, return_inverse=True)
    length = 1
    while length < min_tokens:
        step = min(length, min_tokens - length)
        key = rank[:-step].astype(np.int64) * (n + 1) + rank[step:] + 1
        _, rank = np.unique(key, return_inverse=True)
        length += step
    whole = pages[:len(rank)] == pages[min_tokens - 1:]
    starts = np.flatnonzero(whole)
    if len(starts) == 0:  # only pages of fewer tokens
        return covered
    order = starts[np.argsort(rank[starts], kind="stable")]  # suffixes in order; a stable sort keeps pages ascending
    group = rank[order]
    new_group = np.concatenate([[True], group[1:] != group[:-1]])
    new_page = new_group | np.concatenate([[True], pages[order][1:] != pages[order][:-1]])
    number = np.cumsum(new_group) - 1
    distinct = np.bincount(number, weights=new_page)
    repeats = distinct >= min_pages
    if contents is not None:
        pairs = np.unique(np.stack([number, contents[order]]), axis=1)[0]
        repeats &= np.bincount(pairs, minlength=len(distinct)) >= min_pages
    hits = order[repeats[number]]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, hits, 1)
    np.add.at(edge, hits + min_tokens, -1)
    return np.cumsum(edge[:-1]) > 0


def main_texts(pages: list[tuple[int | None, str | None]], min_tokens: int = MIN_TOKENS,
               min_pages: int = MIN_PAGES, repeated: np.ndarray | None = None) -> list[str]:
    """Main texts of one host's pages (id, html): all of them, or some with
    the sorted hashes ``repeated`` of the substrings that stand on
    ``min_pages`` pages of the host. Pages of equal ids count as one page, pages
    of equal main streams as well."""
    read = [read_blocks(page or "") for _, page in pages]
    if repeated is not None:
        return [join_blocks(covered_blocks(blocks, repeated, min_tokens)) for blocks in read]
    numbers: dict[object, int] = {}
    order = sorted(range(len(pages)), key=lambda i: numbers.setdefault(pages[i][0], len(numbers)))
    words: dict[str, int] = {"\n": 0}  # the block border
    stream, owner, content, place = [], [], [], {}
    streams: dict[str, int] = {}
    for i in order:
        page = numbers[pages[i][0]]
        main = streams.setdefault(main_stream(read[i]), len(streams))
        for k, block in enumerate(read[i]):
            own = [words.setdefault(w, len(words)) for w in block.text.split(" ")]
            place[i, k] = len(stream) + 1, len(stream) + 1 + len(own)
            stream += [0, *own]
            owner += [page] * (len(own) + 1)
            content += [main] * (len(own) + 1)
    covered = covered_tokens(np.array(stream, np.int64), np.array(owner, np.int64), min_tokens, min_pages,
                             np.array(content, np.int64))
    before = np.concatenate([[0], np.cumsum(covered)])
    return [join_blocks([(b, float(before[place[i, k][1]] - before[place[i, k][0]]) / (place[i, k][1] - place[i, k][0]))
                         for k, b in enumerate(blocks)]) for i, blocks in enumerate(read)]


def main_stream(blocks: list[Block]) -> str:
    best = max((b.kind for b in blocks), default=OTHER)
    return "\n".join(b.text for b in blocks if b.kind == best)


def gram_hashes(blocks: list[Block], min_tokens: int = MIN_TOKENS) -> np.ndarray:
    """Hashes of the substrings of ``min_tokens`` tokens of a page's stream, by
    their start; the same in every process."""
    data = np.frombuffer(" ".join(f"\n {b.text}" for b in blocks).encode("utf-8", "surrogatepass"), np.uint8)
    blanks = np.flatnonzero(data == 32)
    tokens = A.span_hashes(data, np.concatenate([[0], blanks + 1]), np.concatenate([blanks, [len(data)]]))
    n = len(tokens) - min_tokens + 1
    if not blocks or n <= 0:
        return np.zeros(0, np.int64)
    grams = np.zeros(n, np.uint64)
    for k in range(min_tokens):
        grams = A.mix64(grams + np.uint64(k + 1)) + tokens[k:k + n]
    return A.mix64(grams).view(np.int64)


def covered_blocks(blocks: list[Block], repeated: np.ndarray, min_tokens: int = MIN_TOKENS) -> list[tuple[Block, float]]:
    """Each block with the share of its tokens that lie in a substring whose
    hash is among ``repeated``."""
    if max((b.kind for b in blocks), default=OTHER) in (OTHER, ARTICLE):
        return [(b, 0.0) for b in blocks]
    grams = gram_hashes(blocks, min_tokens)
    at = np.searchsorted(repeated, grams)
    hits = np.flatnonzero(np.append(repeated, 0)[at] == grams) if len(repeated) else np.zeros(0, np.int64)
    hits = hits[at[hits] < len(repeated)]
    ends = np.cumsum([b.text.count(" ") + 2 for b in blocks])
    edge = np.zeros(int(ends[-1]) + 1, np.int64)
    np.add.at(edge, hits, 1)
    np.add.at(edge, hits + min_tokens, -1)
    before = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    starts = np.concatenate([[0], ends[:-1]]) + 1
    return [(b, float(before[e] - before[a]) / (e - a)) for b, a, e in zip(blocks, starts, ends, strict=True)]


def repeated_grams(rows: DataFrame, big: DataFrame, min_tokens: int = MIN_TOKENS,
                   min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, gram) of the substrings that stand on ``min_pages`` distinct pages
    (ids and main streams) of a host of ``big``, counted over all its pages, for hosts with a page that
    does not mark its article. ``rows``: (host, mixed, html)."""

    def unmarked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = {host for host, html in zip(A.column(batch, "host").to_pylist(), A.column(batch, "html").to_pylist(),
                                                strict=True)
                     if max((b.kind for b in read_blocks(html or "")), default=OTHER) in (MAIN, OPEN)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(hosts), pa.string())], names=["host"])

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, PAGES_PER_COUNT):
                seen: dict[str, dict[tuple[int, int], np.ndarray]] = {}
                part = batch.slice(low, PAGES_PER_COUNT)
                for host, page, html in zip(*(A.column(part, c).to_pylist() for c in ("host", "mixed", "html")),
                                            strict=True):
                    blocks = read_blocks(html or "")
                    main = hashlib.blake2b(main_stream(blocks).encode("utf-8", "surrogatepass"), digest_size=8).digest()
                    own = np.unique(gram_hashes(blocks, min_tokens))
                    # rows of one id and main stream may differ in other blocks
                    pages = seen.setdefault(host, {})
                    key = page, int.from_bytes(main, "little", signed=True)
                    pages[key] = np.union1d(pages[key], own) if key in pages else own
                for host, pages in seen.items():
                    keys = np.array(list(pages), np.int64)
                    gram = np.concatenate(list(pages.values()))
                    of = np.repeat(np.arange(len(keys)), [len(g) for g in pages.values()])
                    order = np.argsort(gram, kind="stable")
                    gram, of = gram[order], of[order]
                    if len(set(keys[:, 0])) == len(set(keys[:, 1])) == len(keys):
                        first = np.flatnonzero(np.append(True, gram[1:] != gram[:-1])[:len(gram)])
                        nth = np.arange(len(gram)) - np.repeat(first, np.diff(np.append(first, len(gram))))
                        gram, of = gram[nth < min_pages], of[nth < min_pages]  # more of them decide nothing
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([host] * len(gram), pa.string()), pa.array(gram), pa.array(keys[of, 0]),
                         pa.array(keys[of, 1])], names=["host", "gram", "page", "content"])

    rows = rows.select("host", "mixed", "html")
    counted = materialize(rows.join(few_hosts(big), "host", "left_semi").mapInArrow(unmarked, "host string").distinct())
    found = rows.join(few_hosts(counted), "host", "left_semi").mapInArrow(
        grams, "host string, gram long, page long, content long")
    return found.repartition("host", "gram").groupBy("host", "gram").agg(
        F.size(F.collect_set("page")).alias("pages"), F.size(F.collect_set("content")).alias("contents")).where(
        (F.col("pages") >= min_pages) & (F.col("contents") >= min_pages)).select("host", "gram")


def few_hosts(hosts: DataFrame) -> DataFrame:
    return F.broadcast(hosts) if hosts.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS else hosts


def join_blocks(blocks: list[tuple[Block, float]]) -> str:
    """The blocks that stay, one a line: those of the article; on pages that
    mark none, those of the main element; on pages that mark neither, all that
    the markup does not give to something else. The latter two without lists of
    links, and without blocks covered by the host's boilerplate unless that is
    all they have."""
    best = max((b.kind for b, _ in blocks), default=OTHER)
    if best == OTHER:
        return ""
    own = [(b, covered) for b, covered in blocks if b.kind == best and (
        best == ARTICLE or not b.listed or 2 * b.linked <= len(b.text))]
    kept = [b for b, covered in own if best == ARTICLE or covered < COVERED]
    return "\n".join(b.text for b in kept or [b for b, _ in own])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                      pages_per_group: int = PAGES_PER_GROUP, pages_per_task: int = PAGES_PER_TASK) -> DataFrame:
    """Return page_id, url, text, n_chars (code points); a row per input row.
    Null html gives an empty text. Pages whose url is null or names no host
    are one host of their own."""
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"), host.alias("host"))
    sizes = materialize(rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    # HOT_SHARE hosts at most can have so many pages each
    hot = sizes.where(F.col("n") > max(total / HOT_SHARE, pages_per_task)).select(
        "host", F.ceil(F.col("n") / pages_per_task).cast("int").alias("parts"))
    rows = rows.join(F.broadcast(hot), "host", "left").withColumn("mixed", F.xxhash64("page_id"))
    rows = rows.withColumn("part", F.pmod("mixed", F.coalesce("parts", F.lit(1))))
    rows = rows.select("host", "part", F.lit(None).cast("long").alias("gram"), F.col("parts").isNotNull().alias("parted"),
                       "mixed", "page_id", "url", "html")
    big = sizes.where(F.col("n") > min(2 * pages_per_group, pages_per_task)).select("host")
    marks = repeated_grams(rows, big).join(F.broadcast(hot), "host", "left").select(
        "host", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)).cast("long") - 1)).alias("part"), "gram")
    rows = rows.unionByName(marks, allowMissingColumns=True)
    # the repeated substrings of a host come before its pages
    rows = rows.repartition("host", "part").sortWithinPartitions("host", "part", F.col("gram").asc_nulls_last(), "mixed")
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []  # pages of one host
        place = None  # host, part
        grams = array("q")  # of this host, in order
        split = False  # whether the host is larger than a group

        def extracted(group: list[dict]) -> pa.RecordBatch:
            whole = not split and not group[0]["parted"]
            texts = main_texts([(r["page_id"], r["html"]) for r in group],
                               repeated=None if whole else np.array(grams, np.int64))
            return pa.RecordBatch.from_arrays(
                [pa.array([r["page_id"] for r in group], id_type), pa.array([r["url"] for r in group], pa.string()),
                 pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

        id_type = None
        for batch in batches:
            id_type = A.column(batch, "page_id").type
            for low in range(0, batch.num_rows, 256):
                for row in batch.slice(low, 256).to_pylist():
                    if (row["host"], row["part"]) != place:
                        if held:
                            yield extracted(held)
                        held, grams, split, place = [], array("q"), False, (row["host"], row["part"])
                    if row["gram"] is not None:
                        grams.append(row["gram"])
                        continue
                    if len(held) >= 2 * pages_per_group:
                        split = True
                        yield extracted(held[:pages_per_group])
                        held = held[pages_per_group:]
                    held.append(row)
        if held:
            yield extracted(held)

    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
