"""Fixed values that must equal the behaviour being reproduced.

Everything in this module is data, not logic: word lists, prices and the
source catalogue. They are stated plainly, in their natural order, so that a
reader can check them against the documented behaviour line by line.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must not be edited to make a result match)
# ---------------------------------------------------------------------------

# Source policy: a source is banned when any of these lower-case substrings
# occurs in "<id> <title> <description>" (lower-cased).
BANNED_PATTERNS = [
    "instagram",
    "facebook",
    "tiktok",
    "linkedin",
    "twitter",
    "x-scraper",
    "youtube",
    "amazon",
    "amz-",
    "google-maps",
    "google-search",
    "google-trends",
    "apollo",
    "apollo-io",
]

# Extra page-level patterns used when the policy runs over crawled page URLs.
PAGE_POLICY_EXTRA = ["spam-farm", "cheap-pills"]

# HTML elements whose whole subtree is dropped before text extraction.
REMOVED_TAGS = ["script", "style", "nav", "footer", "iframe", "noscript"]

# Class-attribute regex searches (case-insensitive) that drop a subtree.
AD_CLASS_PATTERNS = [
    "advertisement",
    "ads",
    "ad-container",
    "sponsored",
    "tracking",
    "analytics",
    "cookie-banner",
    "popup",
]

# Class-attribute patterns tried, in order, by the main-content heuristic.
CONTENT_CLASS_PATTERNS = [
    "content",
    "main-content",
    "article-content",
    "post-content",
    "entry-content",
    "documentation",
]

# HTML void elements: they never have content and never open a subtree.
VOID_TAGS = [
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen",
    "link", "meta", "param", "source", "track", "wbr",
]

# URL classification rules, tried in this order; first match wins.
URL_TYPE_RULES = [
    ("documentation", ["docs.", "/docs/", "documentation", "api.", "developer."]),
    ("blog", ["/blog/", "blog.", "medium.com", "substack.com"]),
    ("forum", ["forum", "reddit.com", "stackoverflow.com", "discourse"]),
    ("news", ["news", "article", "press", "/story/"]),
]
DEFAULT_TARGET_TYPE = "general"
TARGET_TYPES = ["documentation", "blog", "forum", "news", "general"]

BUDGET_MODES = ["minimal", "optimal", "premium"]

# Source catalogue: official list followed by the community list; `ord` is
# the position in the concatenated list (ties in ranking resolve by it).
# (ord, id, name, title, username, pricing_model, success_rate, monthly_users,
#  rating, best_for, output_format, features, speed, cost, supports_files,
#  runs_total, runs_finished, runs_failed)
CATALOGUE = [
    (0, "apify/website-content-crawler", "Website Content Crawler",
     "Website Content Crawler - LLM content extraction", "apify", "FREE",
     0.948, 4650, 4.36, ["documentation", "blog", "general"], "markdown",
     ["markdown", "text", "html", "file_download", "anti_blocking"], "medium",
     "free", True, 87679, 82679, 5000),
    (1, "apify/cheerio-scraper", "Cheerio Scraper",
     "Cheerio Scraper - Fast HTML parsing", "apify", "FREE",
     0.993, 607, 4.93, ["general", "simple_sites"], "html",
     ["fast", "no_javascript"], "very_fast", "free", False, 10860, 10780, 80),
    (2, "apify/beautifulsoup-scraper", "BeautifulSoup Scraper",
     "BeautifulSoup Scraper - Python alternative", "apify", "FREE",
     0.981, 12, 4.24, ["general", "simple_sites"], "html",
     ["python", "fast"], "fast", "free", False, 928, 910, 18),
    (3, "janbuchar/crawl4ai", "Crawl4AI",
     "Crawl4AI - Open-source AI content retrieval", "janbuchar", "FREE",
     0.897, 22, 3.26, ["documentation", "blog"], "text",
     ["ai_optimized"], "medium", "free", False, 658, 590, 68),
    (4, "quaking_pail/ai-website-content-markdown-scraper",
     "AI Website Content Markdown Scraper",
     "AI Markdown Scraper - LLM optimized", "quaking_pail", "PER_RESULT",
     0.932, 22, 3.93, ["documentation", "blog"], "markdown",
     ["markdown", "ai_optimized"], "medium", "paid", False, 817, 761, 56),
]
OFFICIAL_COUNT = 3  # the first three catalogue rows form the official list

# Production score weights.
SCORE_SUCCESS_WEIGHT = 40.0
SCORE_POPULARITY_BASE = 5.0
SCORE_POPULARITY_PER_DECADE = 5.0
SCORE_POPULARITY_CAP = 20.0
SCORE_FREE = 20.0
SCORE_PAID_PREMIUM = 10.0
SCORE_TYPE_MATCH = 10.0
SCORE_FORMAT = [("markdown", 10.0), ("text", 7.0), ("html", 5.0)]

# Legacy score.
LEGACY_RUNS_DIVISOR = 1000.0
LEGACY_RUNS_CAP = 50.0
LEGACY_RATING_WEIGHT = 10.0
LEGACY_USERS_DIVISOR = 10.0
LEGACY_USERS_CAP = 20.0
LEGACY_PREMIUM_FACTOR = 1.2
LEGACY_MINIMAL_FACTOR = 0.9
LEGACY_SCORE_CAP = 100.0

# Token estimate and prices.
CHARS_PER_TOKEN = 5
INDEXING_PRICE_PER_MILLION_TOKENS = 0.15
PRICE_PER_PAGE = 0.0015
START_FEE = 0.02
PRICING_MODEL = "pay-per-page"
PRICING_NOTE = "Store discounts applied automatically based on your Apify plan"

# Plan discount tiers on the per-page price: (plan, discount).
PRICE_TIERS = [("free", 0.0), ("starter", 0.10), ("scale", 0.20), ("business", 0.30)]

# Scraper cost per 100 pages by budget mode.
SCRAPER_COST_PER_100_PAGES = [("minimal", 0.10), ("optimal", 0.50), ("premium", 1.00)]

# Corpus metadata constants.
STORAGE_TYPE = "File Search Store"
STORAGE_PERSISTENCE = "Indefinite (until manually deleted)"
DEFAULT_CORPUS_NAME = "scraped-knowledge"
QUERY_INSTRUCTIONS = "See query-guide.md in Key-Value Store for detailed usage instructions"
MANIFEST_FIRST_FILES = 10

# Run defaults.
DEFAULT_MAX_PAGES = 100
DEFAULT_TOP_N = 3
DEFAULT_BUDGET = "optimal"
DEFAULT_CHUNK_MAX_TOKENS = 10000
DEFAULT_CHUNK_OVERLAP = 500

# Content fields tried in order after the configured field.
CONTENT_FIELDS = ["html", "text", "markdown", "content", "crawl.html"]

# Retrieval (published BM25 defaults).
BM25_K1 = 1.2
BM25_B = 0.75
