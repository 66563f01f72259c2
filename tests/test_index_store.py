"""The kept index against a search over the final corpus."""

import pytest
from pyspark.sql import functions as F

from pagesieve.operators import index_store
from pagesieve.operators import retrieval as RT
from pagesieve.operators import versions
from pagesieve.operators.index_store import IndexStore

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text")


@pytest.fixture(scope="module")
def questions(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


def hits(df):
    return sorted(map(tuple, df.collect()))


def direct(corpus, questions):
    return hits(RT.bm25_search(corpus, ["doc_id"], "text", questions, "item_id", "text"))


def test_appends_replacements_drops_and_merges(spark, docs, questions, tmp_path):
    store = IndexStore(spark, str(tmp_path / "ix"), ["doc_id"], ["source"], buckets=2, fan_in=2)
    for k in range(3):
        store.append(docs.where(f"doc_id % 3 = {k}"))
    assert [s["level"] for s in store.state["segments"]] == [1, 0]  # two of a level are merged
    edited = docs.where("doc_id % 7 = 2").withColumn("text", F.concat(F.reverse("text"), F.lit(" new words")))
    store.append(edited)
    now = docs.join(edited, "doc_id", "left_anti").unionByName(edited)
    assert [s["level"] for s in store.state["segments"]] == [2] and store.state["n_docs"] == docs.count()
    gone = docs.where("doc_id % 3 = 1").select("doc_id")
    assert store.drop(gone) == gone.count() and store.drop(gone) == 0
    left = now.join(gone, "doc_id", "left_anti")
    assert store.drop_where("source", spark.createDataFrame([("src2",), ("none",)], "s string")) == left.where(
        "source = 'src2'").count()
    left = left.where("source <> 'src2'")
    # a dropped document comes back, another session opens the index
    store.append(docs.where("doc_id = 1"))
    left = left.unionByName(docs.where("doc_id = 1"))
    store.close()
    again = IndexStore(spark, str(tmp_path / "ix"), ["doc_id"], ["source"])
    assert again.state == store.state and again.state["buckets"] == 2
    want = direct(left, questions)
    assert hits(again.search(questions, "item_id", "text")) == want
    again.compact()
    assert len(again.state["segments"]) == 1 and again.state["deletes"] == []
    assert hits(again.search(questions, "item_id", "text")) == want
    assert again.documents().count() == again.state["n_docs"] == left.count()
    assert again.documents().agg(F.sum("doc_len")).first()[0] == again.state["total_len"]
    again.close()


def test_no_exchange_under_the_term_joins(spark, docs, questions, tmp_path):
    store = IndexStore(spark, str(tmp_path / "ix"), ["doc_id"], buckets=4)
    store.append(docs.where("doc_id % 2 = 0"))
    store.append(docs.where("doc_id % 2 = 1"))
    found = store.found_postings(RT.question_terms(questions, "item_id", "text"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") == 2 and "Exchange" not in plan
    store.close()


def test_a_lost_writer_changes_nothing(spark, docs, tmp_path):
    store = IndexStore(spark, str(tmp_path / "ix"), ["doc_id"], buckets=2)
    store.append(docs)
    store._hide(docs.select("doc_id"))  # written, and lost before the commit
    again = IndexStore(spark, str(tmp_path / "ix"), ["doc_id"])
    assert again.documents().count() == docs.count()
    # two writers of one version: the second is told
    again.drop(docs.where("doc_id = 0").select("doc_id"))
    with pytest.raises(RuntimeError, match="another writer"):
        versions.commit(spark, str(tmp_path / "ix"), store.number, store.state)
    store.close()
    again.close()


def test_empty_and_odd(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "ix"), ["a", "b"], buckets=2)
    rows = [(1, "x", "one two"), (1, None, "two"), (None, "y", ""), (2, "x", None)]
    odd = spark.createDataFrame(rows, "a long, b string, text string")
    asked = spark.createDataFrame([(1, "two three")], "q long, text string")
    store.append(odd.limit(0))
    assert store.state["segments"] == [] and store.drop(odd) == 0
    store.append(odd)
    assert [(r.a, r.b) for r in store.search(asked, "q", "text").orderBy("rank").collect()] == [(1, None), (1, "x")]
    assert store.drop(odd.where("b is null").select("a", "b")) == 1
    assert [(r.a, r.b) for r in store.search(asked, "q", "text").collect()] == [(1, "x")]
    store.close()


def test_writing_sorts_by_one_number_and_deletes_are_sent_to_the_postings(spark, docs, tmp_path, monkeypatch):
    store = IndexStore(spark, str(tmp_path / "ix"), ["doc_id"], ["source"], buckets=2)
    store.append(docs)
    assert store.drop(docs.where("doc_id % 4 = 1").select("doc_id")) > 0
    postings = store._postings(store.state["segments"][0])
    table = spark.sql(f"DESCRIBE EXTENDED {next(iter(store.tables.values()))}").collect()
    assert [r.data_type for r in table if r.col_name == "Sort Columns"] in ([], ["[]"])
    # rows of a term and part still lie together in their file
    placed = postings.select("term", "part", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i")).selectExpr(
        "term", "part", "row_number() over (partition by f order by i) - row_number() over (partition by f, term, part order by i) as run")
    pairs = postings.select("term", "part").distinct().count()
    assert placed.distinct().count() == pairs < postings.count()
    # the delete list meets the postings without dealing them out anew, unless it is long
    rows = postings.withColumn("seq", F.lit(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sent = store._live(rows)
        plan = sent._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        monkeypatch.setattr(index_store, "HIDDEN_SENT", 0)
        dealt = store._live(rows)
        assert "SortMergeJoin" in dealt._jdf.queryExecution().executedPlan().toString()
        assert 0 < sent.count() == dealt.count() == postings.where("doc_id % 4 <> 1").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    store.close()
