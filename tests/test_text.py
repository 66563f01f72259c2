"""HTML cleaning, titles, whitespace and main content on authored rows."""

import pytest
from pyspark.sql import functions as F

from pagesieve.functions import html as H
from pagesieve.functions.html import clean_html, main_content_text, title_parts, url_basename_title
from pagesieve.functions.text import decode_entities, normalize_ws, py_title_case

# (html, url, text, title)
ROWS = [
    ('<html><head><title>T &amp; U</title><script>var t="</p>";</script></head><body><nav>n</nav>'
     '<p>a <b>x</b> c</p><footer>f</footer></body></html>', "https://e.org/", "T & U\na\nx\nc", "T & U"),
    ('<title>Q</title><div class="top-Ads">gone<div>too</div></div><p>stay</p>', "https://e.org/", "Q\nstay", "Q"),
    ('<div class="ad">stays</div>', "https://e.org/a/getting-started_guide.html?x=1", "stays",
     "Getting Started Guide.Html"),
    ('<body class="popup-open"><p>gone</p></body>', "https://e.org/", "", "Untitled"),
    ("<title> </title><h1>H</h1>", "https://e.org/", "H", ""),
    ("<h1>A <i>B</i></h1>", "https://e.org/", "A\nB", "AB"),
    ('<meta property="og:title" content=" OG "><p>z</p>', "https://e.org/", "z", "OG"),
    ("# Hi", "https://e.org/", "# Hi", "Untitled"),
    ("<pre>l1\n\n\n\nl2\t x</pre>", "https://e.org/", "l1\n\nl2 x", "Untitled"),
    ('<a class="downloads">d</a><p>k</p>', "https://e.org/", "k", "Untitled"),
    ("<p>&amp;lt;b&amp;gt;</p>", "https://e.org/", "&lt;b&gt;", "Untitled"),
    ("<p>a<!-- c -->b</p>", "https://e.org/", "a\nb", "Untitled"),
    ("<nav>a<nav>b</nav>c</nav><p>d</p>", "https://e.org/", "d", "Untitled"),
    ("plain <- text", "https://e.org/", "plain <- text", "Untitled"),
    ('<img class="ads" src="x"><p>kept</p>', "https://e.org/", "kept", "Untitled"),
    ('<div class="order-tracking">t</div><div class="ad">a</div>', "https://e.org/", "a", "Untitled"),
    ("<p>x</p>", "https://e.org/docs/", "x", "Docs"),
    ("<p>x</p>", "https://e.org/it's-2fast", "x", "It'S 2Fast"),
    ("<p>x</p>", "unknown-5", "x", "Unknown 5"),
    # implicit ends of a dropped element, as an HTML parser builds the tree
    ('<p class="ads">x<div>y</div>', "https://e.org/", "y", "Untitled"),
    ('<ul><li class="ads">a<li>b</ul>', "https://e.org/", "b", "Untitled"),
    ('<div><span class="ads">x</div><p>y</p>', "https://e.org/", "y", "Untitled"),
    ('<div class="ads"><p>a<p>b</div><p>c</p>', "https://e.org/", "c", "Untitled"),
    ('<li class="ads">x<ul><li>y</li></ul></li><p>z</p>', "https://e.org/", "z", "Untitled"),
    # markup inside scripts and comments is never a title
    ('<script>var s="<title>no</title><h1>no</h1>";</script><!-- <h1>no</h1> --><p>k</p>', "https://e.org/x",
     "k", "X"),
    ('<TITLE>Up</TITLE><H1>h</H1>', "https://e.org/", "Up\nh", "Up"),
    ('<meta content="C &amp; D" property=\'og:title\'><p>z</p>', "https://e.org/", "z", "C & D"),
    ('<meta property="og:title" content=""><p>z</p>', "https://e.org/last-part/", "z", "Last Part"),
    ("<p>a</p><![CDATA[x > y]]><p>b</p>", "https://e.org/", "a\nb", "Untitled"),
    # title content is raw text: markup inside it is literal
    ("<title>A <b>B</b> &amp; C</title><p>x</p>", "https://e.org/", "A <b>B</b> & C\nx", "A <b>B</b> & C"),
    ('<a title="1 > 0">link</a>', "https://e.org/", "link", "Untitled"),
]


@pytest.fixture(scope="module")
def results(spark):
    df = spark.createDataFrame([(i, h, u) for i, (h, u, _, _) in enumerate(ROWS)], "n int, html string, url string")
    out = df.select("n", clean_html("html").alias("text"), title_parts("html", "url").alias("tp")).collect()
    return {r.n: r for r in out}


@pytest.mark.parametrize("n", range(len(ROWS)))
def test_clean_and_title(results, n):
    r = results[n]
    assert r.text == ROWS[n][2]
    assert r.tp.title == ROWS[n][3]


@pytest.mark.parametrize("raw,expected", [
    ("  a\t\tb \n\n\n\n c \n", "a b\n\n c"),
    ("\x1cx\r\ny\r\n", "x\ny"),
    ("   ", ""),
    ("a\n \n \nb", "a\n\nb"),
    ("a\xa0 b", "a\xa0 b"),
    ("　x ", "x"),
])
def test_normalize_ws(spark, raw, expected):
    assert spark.createDataFrame([(raw,)], "s string").select(normalize_ws("s")).first()[0] == expected


def test_entities(spark):
    df = spark.createDataFrame([("&#233;&#x41;&eacute;&zzz;&nbsp;&amp;amp;&#0;",)], "s string")
    assert df.select(decode_entities("s")).first()[0] == "éAé&zzz;\xa0&amp;�"


def test_title_case_matches_python(spark):
    words = ["474.html", "it's", "2fast", "getting started", "ÉCOLE ünd", "mIxEd-CaSe", "a1b2", ""]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(py_title_case("w")).collect()]
    assert got == [w.title() for w in words]


def test_url_basename_matches_urlparse(spark):
    from urllib.parse import urlparse
    urls = ["https://e.org/a/b-c_d.html?x=1#f", "https://e.org/", "e.org/x/y/", "https://e.org/p;params",
            "https://m.x.net/en/25#top", "https://x.org"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r[0] for r in df.select(url_basename_title("u")).collect()]

    def ref(u):
        base = urlparse(u).path.rstrip("/").split("/")[-1]
        return base.replace("-", " ").replace("_", " ").title() if base else "Untitled"
    assert got == [ref(u) for u in urls]


@pytest.mark.parametrize("html,expected", [
    ("<main><p>m</p></main><article>a</article>", "m"),
    ("<article>a</article><div class=\"content\">c</div>", "a"),
    ('<div class="Post-Content">c</div><p>x</p>', "c"),
    ('<p class="documentation">d</p><p>x</p>', "d"),
    ("<body><p>x</p></body>", "x"),
    ("<article><article>in</article>out</article><p>z</p>", "in\nout"),
])
def test_main_content(spark, html, expected):
    assert spark.createDataFrame([(html,)], "h string").select(main_content_text("h")).first()[0] == expected


def test_clean_matches_stdlib_parser_on_pages(spark):
    """Independent check: a small html.parser cleaner over the real pages."""
    from html.parser import HTMLParser

    class Cleaner(HTMLParser):
        SKIP = {"script", "style", "nav", "footer", "iframe", "noscript"}

        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.depth, self.parts = 0, []

        def handle_starttag(self, tag, attrs):
            if tag in self.SKIP:
                self.depth += 1

        def handle_endtag(self, tag):
            if tag in self.SKIP and self.depth:
                self.depth -= 1

        def handle_data(self, data):
            if not self.depth and data.strip():
                self.parts.append(data.strip())

    def ref(html):
        c = Cleaner()
        c.feed(html)
        c.close()
        return "\n".join(c.parts)

    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = df.select("html", clean_html("html").alias("t")).collect()
    assert len(rows) == 250
    assert all(r.t == ref(r.html) for r in rows)


@pytest.mark.parametrize(("html", "text"), [
    ("<p>a</p><style-guide>b</style-guide><p>c</p>", "a\nb\nc"),
    ("<title-bar>t</title-bar><p>c</p>", "t\nc"),
    ("<div class=foo data-x=ads>keep</div>", "keep"),
    ('<div title=">" class="ads">gone</div>', ""),
    ("<div class=\"it's ads\">gone</div>", ""),
    ('<div><span class="ads">x<p>y</div><p>z</p>', "z"),
    ("<div data-class=ads>keep</div>", "keep"),
    ("<p " + "a=b " * 3000 + "class=ads>gone</p>keep", "keep"),
])
def test_markup_as_a_parser_reads_it(spark, html, text):
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(H.clean_html("h")).first()[0] == text


def test_title_and_main_content_with_awkward_markup(spark):
    df = spark.createDataFrame([("<title-bar>nav</title-bar><h1>Real</h1>",
                                 "<div class=a id=content>m</div><p>x</p>")], "t string, m string")
    got = df.select(H.extract_title("t", F.lit("")), H.main_content_text("m")).first()
    assert tuple(got) == ("Real", "m\nx")
