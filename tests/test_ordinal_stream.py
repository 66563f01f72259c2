"""Skew-safe ordinals, page caps and the streaming ingest."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pagesieve.operators.convert import cap_pages
from pagesieve.operators.ordinal import position_within
from pagesieve.streaming import ingest as ST


def test_position_within_hot_group(spark):
    # one group holds 60% of the rows
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 5 < 3, F.lit("hot")).otherwise((F.col("id") % 37).cast("string")).alias("g"),
        (F.col("id") * 7919 % 100003).alias("k")).repartition(16)
    got = position_within(df, "g", "k", "pos", ranges=16)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1)
    assert got.count() == 5000
    assert got.exceptAll(want.select("g", "k", F.col("pos").cast("long"))).count() == 0


def test_cap_pages_plan_uses_group_limit(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("target"), F.col("id").alias("page_id"))
    capped = cap_pages(df, 5)
    assert capped.count() == 15
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_stream_equals_batch_and_replay_adds_nothing(spark, tmp_path):
    as_of = "2024-01-01T00:00:00"
    src = "/root/testdata/sf0.001"
    corpus = str(tmp_path / "corpus")
    first = ST.run_ingest(spark, src, as_of, glob="pages.parquet", corpus_path=corpus)
    n = first.count()
    batch = spark.read.parquet(f"{src}/pages.parquet")
    assert n == batch.count()
    # a second stream over the same files (fresh checkpoint) must not add rows
    again = ST.run_ingest(spark, src, as_of, glob="pages.parquet", corpus_path=corpus)
    assert again.count() == n
    assert again.select("url").distinct().count() == n


def test_run_corpus_job_writes_outputs(spark, tmp_path):
    from pagesieve.plans import jobs as JB
    from pagesieve.plans import registry as R
    sf = "/root/testdata/sf0.001"
    attempts, items = R._attempts(spark, sf)
    runs = JB.run_corpus_job(R.pages(spark, sf), attempts, items, R.AS_OF, str(tmp_path / "out"))
    # a source the run's targets did not select does not count
    chosen = R.SE.select_sources(R.SE.targets_from_pages(R.pages(spark, sf))).select("target", "source_id")
    won = R.FB.winners(attempts.join(chosen, ["target", "source_id"], "left_semi"))
    assert runs.count() == won.count() > 0
    docs = spark.read.parquet(str(tmp_path / "out" / "documents"))
    filled = runs.where("record.documents_created > 0").count()
    assert docs.select("corpus").distinct().count() == filled
    corpora = spark.read.json(str(tmp_path / "out" / "corpora"))
    assert corpora.count() == filled
    assert corpora.agg(F.sum("files_indexed")).first()[0] == docs.count()


def test_run_corpus_job_guard(spark, tmp_path):
    import pytest
    from pagesieve.plans import jobs as JB
    from pagesieve.plans import registry as R
    sf = "/root/testdata/sf0.001"
    attempts, items = R._attempts(spark, sf)
    failed = attempts.withColumn("status", F.lit("failed"))
    with pytest.raises(RuntimeError):
        JB.run_corpus_job(R.pages(spark, sf), failed, items, R.AS_OF, str(tmp_path / "out2"))


def test_stream_second_crawl_appends_only_changes(spark, tmp_path):
    from pagesieve.sources.derive import second_crawl
    src, corpus, ckpt = str(tmp_path / "in"), str(tmp_path / "corpus"), str(tmp_path / "ckpt")
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    pages.write.parquet(f"{src}/crawl1")
    q = ST.stream_pages(spark, src + "/*", corpus, "2024-01-01T00:00:00", checkpoint=ckpt)
    q.awaitTermination()
    n1 = ST.read_corpus(spark, corpus).count()
    assert n1 == pages.count()
    later = second_crawl(pages)
    later.write.parquet(f"{src}/crawl2")
    q = ST.stream_pages(spark, src + "/*", corpus, "2024-01-01T00:00:00", checkpoint=ckpt)
    q.awaitTermination()
    changed = later.join(pages, ["page_id", "url", "html"], "left_anti").count()
    assert 0 < changed < pages.count()
    assert ST.read_corpus(spark, corpus).count() == n1 + changed


def test_read_items_json_with_missing_fields(spark, tmp_path):
    import json
    from pagesieve.operators.convert import convert_pages, skipped_items
    from pagesieve.sources.tables import read_items
    rows = [{"page_id": 0, "url": "https://e.org/a", "html": "<title>A</title><p>x</p>"},
            {"page_id": 1, "url": "https://e.org/b"},
            {"page_id": 2, "crawl": {"html": "<p>nested</p>"}},
            {"page_id": 3, "url": "https://e.org/d", "markdown": "# md", "extra": 1}]
    path = tmp_path / "items.json"
    path.write_text("\n".join(json.dumps(r) for r in rows))
    items = read_items(spark, str(path))
    docs = {r.page_id: r for r in convert_pages(items, "2024-01-01T00:00:00").collect()}
    assert sorted(docs) == [0, 2, 3]
    assert docs[2].url == "unknown-2" and docs[2].text == "nested" and docs[2].content_field == "crawl.html"
    assert docs[3].text == "# md" and docs[3].title == "D"
    assert [r.page_id for r in skipped_items(items).collect()] == [1]


def test_spread_only_when_asked(spark):
    from pagesieve.sources.tables import PARTITIONS_CONF, spread
    p = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    assert spread(p, "page_id") is p
    assert spread(p, "page_id", 8).rdd.getNumPartitions() == 8
    spark.conf.set(PARTITIONS_CONF, "5")
    try:
        assert spread(p, "page_id").rdd.getNumPartitions() == 5
    finally:
        spark.conf.unset(PARTITIONS_CONF)


def test_stream_json_items(spark, tmp_path):
    import json
    from pagesieve.sources.tables import ITEMS_SCHEMA
    src = tmp_path / "items"
    src.mkdir()
    rows = [{"page_id": 0, "url": "https://e.org/a", "markdown": "<p>m</p>"},
            {"page_id": 1, "url": "https://e.org/b"},
            {"page_id": 2, "url": "https://e.org/c", "crawl": {"html": "<p>c</p>"}},
            {"page_id": 3, "url": "https://e.org/c", "crawl": {"html": "<p>c</p>"}}]
    (src / "part-0.json").write_text("\n".join(json.dumps(r) for r in rows))
    q = ST.stream_pages(spark, str(src), str(tmp_path / "corpus"), "2024-01-01T00:00:00",
                        checkpoint=str(tmp_path / "ckpt"), glob="*.json", fmt="json", schema=ITEMS_SCHEMA)
    q.awaitTermination()
    got = sorted((r.url, r.text) for r in ST.read_corpus(spark, str(tmp_path / "corpus")).collect())
    assert got == [("https://e.org/a", "m"), ("https://e.org/c", "c")]


def test_command_line_run(spark, tmp_path, capsys):
    from pagesieve.__main__ import main
    out = str(tmp_path / "out")
    assert main(["--pages", "/root/testdata/sf0.001/pages.parquet", "--out", out, "--max-pages", "2",
                 "--as-of", "2024-01-01T00:00:00"]) == 0
    n_runs = int(capsys.readouterr().out.strip().splitlines()[-1])
    docs = spark.read.parquet(f"{out}/documents")
    assert n_runs == docs.select("corpus").distinct().count() > 0
    assert docs.groupBy("corpus").count().agg(F.max("count")).first()[0] <= 2
    assert spark.read.json(f"{out}/runs").count() == n_runs


def test_position_within_null_group(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2), ("a", 9), (None, 7)], "g string, k long")
    assert sorted((r.g or "", r.k, r.p) for r in position_within(df, "g", "k", "p").collect()) == \
        [("", 1, 0), ("", 3, 1), ("", 7, 2), ("a", 2, 0), ("a", 9, 1)]


def test_position_keeps_rows_with_null_or_equal_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("a", 7), ("a", 7), ("a", None)], "g string, k long")
    got = sorted(((r.p, r.k) for r in position_within(df, "g", "k", "p").collect()))
    assert got == [(0, 1), (1, 7), (2, 7), (3, None), (4, None)]


def test_position_of_sparse_ids_in_a_hot_group(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("g"), F.xxhash64("id").alias("k")).repartition(8)
    got = position_within(df, "g", "k", "p", ranges=64)
    want = df.withColumn("p", (F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1).cast("long"))
    assert got.exceptAll(want).count() == 0 and got.count() == 20_000
    # no window partition holds more than about one range, and the offsets' window a row per range at most
    parts = got.select(F.floor(F.col("p") / (20_000 / 64)).alias("r")).groupBy("r").count().agg(F.max("count")).first()[0]
    assert parts <= 400


def test_replay_of_nameless_pages_adds_nothing(spark, tmp_path):
    rows = [(4, "https://e.org/a", "<p>x</p>"), (2, "https://e.org/a", "<p>x</p>"), (5, "e.org/b", "<p>y</p>"),
            (6, None, "<p>z</p>"), (7, "", "<p>w</p>"), (8, None, None)]
    batch = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / "corpus")
    for _ in range(2):
        ST.ingest_batch(batch, path, "2024-01-01T00:00:00")
        got = sorted((r.page_id, r.corpus, r.url) for r in ST.read_corpus(spark, path).collect())
        assert got == [(2, "e.org", "https://e.org/a"), (5, "e.org", "e.org/b"), (6, "no-host", "unknown-6"),
                       (7, "no-host", "")]


def test_ingest_reads_only_its_buckets(spark, tmp_path):
    batch = spark.createDataFrame([(i, f"https://h{i}.org/", f"<p>{i}</p>") for i in range(60)],
                                  "page_id long, url string, html string")
    path = str(tmp_path / "corpus")
    ST.ingest_batch(batch, path, "2024-01-01T00:00:00")
    plan = ST.known_keys(spark, path, [3, 4])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_second_run_lists_only_its_own_corpora(spark, tmp_path, capsys):
    from pagesieve.__main__ import main
    for name, hosts in (("one", ["a.org", "b.org"]), ("two", ["c.org"])):
        rows = [(None, f"https://{h}/x", "<p>t</p>") for h in hosts] + [(7, None, "<p>u</p>"), (None, "d.org/x", "<p>v</p>")]
        spark.createDataFrame(rows, "page_id long, url string, html string").write.json(str(tmp_path / name))
        assert main(["--pages", str(tmp_path / name), "--format", "json", "--out", str(tmp_path / "out")]) == 0
        capsys.readouterr()
        manifest = spark.read.parquet(str(tmp_path / "out" / "manifest"))
        want = sorted([*hosts, "no-host", "d.org"])
        assert sorted(r.corpus for r in manifest.collect()) == want
        assert manifest.where("path IS NULL").count() == 0
        assert sorted(r.corpus_name for r in spark.read.json(str(tmp_path / "out" / "corpora")).collect()) == want


def test_scratch_folder_is_only_made_in_a_local_session(monkeypatch):
    import pytest
    from pagesieve import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    for master in ("local-cluster[2,1,1024]", "spark://h:7077", "yarn", "k8s://x"):
        Context.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(Session())
    assert session.is_local("local[4]") and session.is_local("local") and not session.is_local("local-cluster[1,1,1]")


def test_ingest_of_a_table_in_one_file_or_a_folder(spark, tmp_path):
    from pagesieve.plans import registry
    from pagesieve.sources.tables import PAGES_SCHEMA
    rows = [(i, f"http://h{i % 3}.com/{i}", f"<p>text {i}</p>") for i in range(40)] + [(40, "http://h0.com/x", "")]
    df = spark.createDataFrame(rows, PAGES_SCHEMA)
    df.repartition(4).write.parquet(str(tmp_path / "many" / "pages.parquet"))
    df.repartition(2).write.parquet(str(tmp_path / "many" / "xpages.parquet"))
    df.coalesce(1).write.parquet(str(tmp_path / "out"))
    (tmp_path / "one").mkdir()
    next((tmp_path / "out").glob("part-*.parquet")).rename(tmp_path / "one" / "pages.parquet")
    for folder in ("many", "one"):
        got = registry.QUERIES["stream_ingest"](spark, str(tmp_path / folder)).collect()
        assert sorted(r.page_id for r in got) == list(range(40))
