"""Source policy: every case of the original test suite, as DataFrame rows."""

import pytest
from pyspark.sql import functions as F

from pagesieve import constants as K
from pagesieve.operators.policy import apply_policy, is_banned, policy_audit, policy_counts, policy_text

# (id, title, description, banned)
CASES = [
    # social media
    ("apify/instagram-scraper", None, None, True),
    ("apify/instagram-posts-scraper", None, None, True),
    ("apify/facebook-posts", None, None, True),
    ("apify/facebook-pages-scraper", None, None, True),
    ("apify/tiktok-scraper", None, None, True),
    ("apify/linkedin-profile-scraper", None, None, True),
    ("epctex/linkedin-jobs-scraper", None, None, True),
    ("apify/twitter-scraper", None, None, True),
    ("apify/x-scraper", None, None, True),
    ("apify/youtube-scraper", None, None, True),
    ("apify/youtube-channel-scraper", None, None, True),
    # e-commerce
    ("apify/amazon-scraper", None, None, True),
    ("apify/amazon-products-scraper", None, None, True),
    ("apify/amazon-reviews-scraper", None, None, True),
    ("apify/amz-product-scraper", None, None, True),
    # search engines
    ("apify/google-maps-scraper", None, None, True),
    ("apify/google-search-scraper", None, None, True),
    ("apify/google-trends-scraper", None, None, True),
    # B2B
    ("apify/apollo-scraper", None, None, True),
    ("apify/apollo-io-scraper", None, None, True),
    # allowed
    ("apify/web-scraper", None, None, False),
    ("apify/cheerio-scraper", None, None, False),
    ("apify/puppeteer-scraper", None, None, False),
    ("apify/playwright-scraper", None, None, False),
    ("apify/beautifulsoup-scraper", None, None, False),
    ("apify/reddit-scraper", None, None, False),
    ("apify/github-scraper", None, None, False),
    ("apify/hacker-news-scraper", None, None, False),
    ("apify/documentation-scraper", None, None, False),
    ("apify/blog-scraper", None, None, False),
    ("apify/news-article-scraper", None, None, False),
    # edge cases
    ("APIFY/INSTAGRAM-SCRAPER", None, None, True),
    ("apify/FaceBook-Scraper", None, None, True),
    ("apify/web-scraper", "Instagram Data Extractor", None, True),
    ("apify/web-scraper", "Web Scraper", "Scrape data from Amazon product pages", True),
    ("apify/interface-scraper", None, None, False),
    ("apify/linked-data-scraper", None, None, False),
    (None, None, None, False),
    (None, "Web Scraper", None, False),
    ("apify/googlemaps", None, None, False),
    # real ids
    ("epctex/instagram-scraper", None, None, True),
    ("epctex/smart-web-scraper", None, None, False),
]


@pytest.fixture(scope="module")
def actors(spark):
    rows = [(i, a, t, d, b) for i, (a, t, d, b) in enumerate(CASES)]
    return spark.createDataFrame(rows, "pos int, id string, title string, description string, expected boolean")


def test_every_case(actors):
    got = actors.select("pos", "expected", is_banned(policy_text(["id", "title", "description"])).alias("b")).collect()
    wrong = [(CASES[r.pos], r.b) for r in got if r.b != r.expected]
    assert not wrong


def test_every_pattern_has_a_case():
    ids = " ".join((a or "").lower() for a, _, _, b in CASES if b)
    assert all(p in ids for p in K.BANNED_PATTERNS)


@pytest.mark.parametrize("ids,kept", [
    (["apify/web-scraper", "apify/cheerio-scraper", "apify/reddit-scraper"], 3),
    (["apify/instagram-scraper", "apify/facebook-scraper", "apify/amazon-scraper"], 0),
    (["apify/web-scraper", "apify/instagram-scraper", "apify/cheerio-scraper", "apify/amazon-scraper",
      "apify/reddit-scraper"], 3),
    ([], 0),
])
def test_filter_lists(spark, ids, kept):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "pos int, id string")
    assert apply_policy(df, ("id", "title", "description")).count() == kept


def test_filter_preserves_order(spark):
    df = spark.createDataFrame([(0, "apify/web-scraper"), (1, "apify/instagram-scraper"), (2, "apify/cheerio-scraper")],
                               "pos int, id string")
    out = [r.id for r in apply_policy(df, ("id",)).orderBy("pos").collect()]
    assert out == ["apify/web-scraper", "apify/cheerio-scraper"]


def test_audit_and_counts(spark, actors):
    audit = {r.id: r.patterns for r in policy_audit(actors).collect()}
    assert audit["apify/apollo-io-scraper"] == "apollo,apollo-io"
    c = policy_counts(actors).collect()[0]
    banned = sum(1 for *_, b in CASES if b)
    assert (c.banned, c.allowed) == (banned, len(CASES) - banned)
    # allowed and banned partition the input
    assert apply_policy(actors).count() + policy_audit(actors).count() == actors.count()


def test_page_policy_on_urls(spark):
    from pagesieve.sources.tables import read_pages
    p = read_pages(spark, f"{'/root/testdata/sf0.01'}/pages.parquet")
    pats = K.BANNED_PATTERNS + K.PAGE_POLICY_EXTRA
    audit = policy_audit(p.select("page_id", "url"), ("url",), pats)
    hits = {r.patterns: r["count"] for r in audit.groupBy("patterns").count().collect()}
    assert hits == {"spam-farm": 3, "cheap-pills": 6}
