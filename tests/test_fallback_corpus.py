"""Fallback, content resolution, counters, pricing (authored rows)."""

from pyspark.sql import functions as F

from pagesieve.operators import convert as CV
from pagesieve.operators import corpus as CO
from pagesieve.operators import fallback as FB
from pagesieve.sources.tables import ITEMS_SCHEMA


def test_fallback(spark):
    attempts = spark.createDataFrame([
        ("t1", 0, "s0", "ok", 3, None),
        ("t2", 0, "s0", "failed", 0, "boom"), ("t2", 1, "s1", "ok", 0, None), ("t2", 2, "s2", "ok", 2, None),
        ("t3", 0, "s0", "failed", 0, "e0"), ("t3", 1, "s1", "ok", 0, None),
    ], "target string, rank int, source_id string, status string, n_items long, error string")
    won = {r.target: r.source_id for r in FB.winners(attempts).collect()}
    assert won == {"t1": "s0", "t2": "s2"}
    fails = {r.target: r.error for r in FB.source_failures(attempts).collect()}
    assert fails == {"t3": "No data returned from s1"}


def test_items_resolution_and_counters(spark):
    rows = [
        (0, "https://e.org/0", "<p>a</p>", None, None, None, None),
        (1, "https://e.org/1", None, None, None, None, None),
        (2, "https://e.org/2", "", "<p>t</p>", None, None, None),
        (3, "https://e.org/3", None, None, "# md", "c", None),
        (4, "https://e.org/4", None, None, None, None, ("<p>n</p>",)),
        (5, None, "<p>no titles</p>", None, None, None, None),
    ]
    items = spark.createDataFrame(rows, ITEMS_SCHEMA)
    docs = {r.page_id: r for r in CV.convert_pages(items, "2024-01-01T00:00:00").collect()}
    assert sorted(docs) == [0, 2, 3, 4, 5]
    assert docs[0].doc_name == "doc_0000.txt" and docs[2].doc_name == "doc_0002.txt"
    assert docs[2].content_field == "text" and docs[3].content_field == "markdown"
    assert docs[4].content_field == "crawl.html"
    assert docs[5].url == "unknown-5" and docs[5].title == "Unknown 5"
    assert docs[0].document.startswith("---\nSource: https://e.org/0\nTitle: 0\nScraped: 2024-01-01T00:00:00\n---\n\n")
    assert [r.page_id for r in CV.skipped_items(items).collect()] == [1]
    resolved = CV.resolve_content(items).withColumn("target", F.lit("t"))
    c = CO.run_counters(resolved).first()
    assert (c.pages_scraped, c.documents_created) == (6, 5)
    price = CO.page_pricing(spark.createDataFrame([(6,)], "pages_processed long")).first()
    assert price.estimated_total == 0.03


def test_tiers(spark):
    t = CO.tier_pricing(spark.createDataFrame([(100,)], "pages_processed long"))
    assert {r.plan: r.estimated_total for r in t.collect()} == {
        "free": 0.17, "starter": 0.155, "scale": 0.14, "business": 0.125}


def test_costs_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    c = CO.indexing_cost_chars(docs).first()
    assert c.total_tokens == 481556 and abs(c.cost_usd - 0.0722334) < 1e-9
    b = CO.indexing_cost_bytes(docs).first()
    assert b.total_size_bytes == 2472458 and b.estimated_tokens == 494491 and b.cost_estimate_usd == 0.0742


def test_append_new_pages(spark):
    existing = spark.createDataFrame([("u1", "a"), ("u2", "b")], "url string, content string")
    incoming = spark.createDataFrame([("u1", "a"), ("u2", "changed"), ("u3", "new"), ("u3", "new")],
                                     "url string, content string")
    got = sorted((r.url, r.content) for r in CO.append_new_pages(existing, incoming).collect())
    assert got == [("u2", "changed"), ("u3", "new")]


def test_write_and_drop_corpora(spark, tmp_path):
    docs = spark.createDataFrame([("c1", "d0", "x"), ("c2", "d1", "y")], "corpus string, doc_name string, document string")
    CO.write_corpus(docs, str(tmp_path / "corpus"), mode="overwrite")
    back = spark.read.parquet(str(tmp_path / "corpus"))
    assert back.count() == 2
    left = CO.drop_corpora(back, spark.createDataFrame([("c1",)], "name string"))
    assert [r.corpus for r in left.collect()] == ["c2"]


def test_drop_corpora_on_disk(spark, tmp_path):
    docs = spark.createDataFrame([("c1", "d0"), ("c2", "d1"), ("c 3", "d2")], "corpus string, doc_name string")
    path = str(tmp_path / "store")
    CO.write_corpus(docs, path, mode="overwrite")
    n = CO.drop_corpora_on_disk(spark, path, spark.createDataFrame([("c1",), ("c 3",), ("zz",)], "n string"))
    assert n == 2
    assert [r.corpus for r in spark.read.parquet(path).collect()] == ["c2"]
    assert CO.drop_corpora_on_disk(spark, path, spark.createDataFrame([("c1",)], "n string")) == 0


def test_kept_plus_skipped_is_input(spark):
    from pagesieve.sources.derive import scattered_items
    from pagesieve.sources.tables import read_pages
    items = scattered_items(read_pages(spark, "/root/testdata/sf0.01/pages.parquet"))
    kept = CV.convert_pages(items, "2024-01-01T00:00:00").count()
    skipped = CV.skipped_items(items).count()
    assert kept + skipped == items.count() == 250 and skipped > 0


def test_text_sink(spark, tmp_path):
    texts = sorted(["a\nb", "c", "one\x1etwo", "\x1e", "\x1b", "\x1br\x1ee\x1b\x1e", "\x1ber\x1b\x1be"])
    CO.write_text_files(spark.createDataFrame([(t,) for t in texts], "document string"), str(tmp_path / "txt"))
    assert sorted(r.document for r in CO.read_text_files(spark, str(tmp_path / "txt")).collect()) == texts


def test_header_time_defaults_to_now(spark):
    import re
    items = spark.createDataFrame([(0, "https://e.org/a", "<p>x</p>"), (1, "https://e.org/b", "<p>y</p>")],
                                  "page_id long, url string, html string")
    docs = CV.convert_pages(items, None).collect()
    stamps = {re.search(r"Scraped: (\S+)", d.document).group(1) for d in docs}
    assert len(stamps) == 1 and re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{6})?", stamps.pop())


def test_drop_corpora_list_of_any_length(spark, tmp_path):
    names = spark.range(10_001).select(F.concat(F.lit("c"), "id").alias("n"))
    path = str(tmp_path / "store")
    CO.write_corpus(names.select(F.col("n").alias("corpus"), F.lit("d").alias("document")), path, mode="overwrite")
    assert CO.drop_corpora_on_disk(spark, path, names.where("n != 'c77'")) == 10_000
    assert [r.corpus for r in spark.read.parquet(path).collect()] == ["c77"]
    assert CO.drop_corpora_on_disk(spark, path, names) == 1
    assert not list((tmp_path / "store").glob("bucket=*"))


def test_corpus_key_is_total(spark):
    from pagesieve.sources.tables import host_of
    rows = ["https://E.org:80/a", "//e.org/x", "e.org/a", "E.org:8080", "e.org?q", "/path", "", None, "https:///x", "http://"]
    df = spark.createDataFrame([(r,) for r in rows], "url string")
    assert [r[0] for r in df.select(host_of("url")).collect()] == [
        "e.org", "e.org", "e.org", "e.org", "e.org", "no-host", "no-host", "no-host", "no-host", "no-host"]


def test_summary_keeps_the_corpus_without_a_name(spark):
    docs = spark.createDataFrame([("a", 1, "d1", "xx"), (None, 2, "d2", "yyy")],
                                 "corpus string, page_id long, doc_name string, document string")
    got = {r.corpus_name: r for r in CO.corpus_summary(docs, "2024-01-01T00:00:00").collect()}
    assert set(got) == {"a", "no-host"} and got["a"].store_name == "stores/a"
    file = got["no-host"].uploaded_files[0]
    assert (file.name, file.path, file.size, file.imported_at) == ("d2", "no-host/d2", 3, "2024-01-01T00:00:00")


def test_append_smallest_page_and_null_urls(spark):
    existing = spark.createDataFrame([(None, "a")], "url string, content string")
    incoming = spark.createDataFrame([(9, None, "a"), (5, "u", "b"), (3, "u", "b")], "page_id long, url string, content string")
    assert [(r.page_id, r.url) for r in CO.append_new_pages(existing, incoming).collect()] == [(3, "u")]


def test_four_statuses(spark):
    targets = spark.createDataFrame([("t1",), ("t2",), ("t3",), ("t4",)], "target string")
    selected = spark.createDataFrame([("t1", 1), ("t2", 1), ("t3", 1), ("t3", 2)], "target string, rank int")
    attempts = spark.createDataFrame([("t1", 1, "s", "ok", 2), ("t2", 1, "s", "failed", 0), ("t3", 1, "s", "ok", 0),
                                      ("t3", 2, "z", "ok", 1)],
                                     "target string, rank int, source_id string, status string, n_items long")
    items = spark.createDataFrame([("t1", 1, "x"), ("t1", 1, ""), ("t3", 2, None), ("t3", 1, "lost")],
                                  "target string, rank int, html string")
    got = {r.target: r.status for r in FB.target_status(targets, selected, attempts, items).collect()}
    assert got == {"t1": "ok", "t2": "all_failed", "t3": "no_content", "t4": "no_source"}
    plan = FB.target_status(targets, selected, attempts, items)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_doc_ordinals_unique_and_dense_per_corpus(spark):
    from pagesieve.sources.derive import scattered_items
    from pagesieve.sources.tables import read_pages
    items = CV.resolve_content(scattered_items(read_pages(spark, "/root/testdata/sf0.01/pages.parquet")))
    named = CV.doc_names(items.withColumnRenamed("target", "corpus"), "corpus", "page_id")
    per = named.groupBy("corpus").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("ordinal").alias("d"),
                                      F.min("ordinal").alias("lo"), F.max("ordinal").alias("hi"))
    # before the skip filter: 0..n-1 within every corpus
    assert per.filter((F.col("n") != F.col("d")) | (F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1)).count() == 0
    assert named.count() == 250


def test_custom_fields_and_iso_times(spark):
    import datetime as dt
    from pagesieve.functions.text import iso_timestamp
    items = spark.createDataFrame([(0, "https://e.org/x", "<title>B</title><p>b</p>", "<p>h</p>")],
                                  "page_id long, link string, body string, html string")
    d = CV.convert_pages(items, "2024-01-01T00:00:00", url_field="link", html_field="body").first()
    # the configured content field wins over html; the configured URL field is used
    assert (d.url, d.title, d.text, d.content_field) == ("https://e.org/x", "B", "B\nb", "body")
    ts = spark.createDataFrame([(dt.datetime(2024, 5, 6, 7, 8, 9),), (dt.datetime(2024, 5, 6, 7, 8, 9, 120),)],
                               "t timestamp")
    got = [r[0] for r in ts.select(iso_timestamp("t")).collect()]
    assert got == [dt.datetime(2024, 5, 6, 7, 8, 9).isoformat(), dt.datetime(2024, 5, 6, 7, 8, 9, 120).isoformat()]
