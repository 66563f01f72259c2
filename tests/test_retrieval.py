"""Retrieval: BM25 against a brute-force loop, cosine inline vs blocked path."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pagesieve.operators import retrieval as RT

TERM = re.compile(r"[^\W_]+", re.UNICODE)


def brute_bm25(docs, questions, k=5, k1=1.2, b=0.75):
    toks = {d: TERM.findall(t.lower()) for d, t in docs}
    n = len(toks)
    avg = sum(len(v) for v in toks.values()) / n
    df = Counter(t for v in toks.values() for t in set(v))
    tf = {d: Counter(v) for d, v in toks.items()}
    out = {}
    for q, text in questions:
        scores = {}
        for t in set(TERM.findall(text.lower())):
            if t not in df:
                continue
            idf = math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5))
            for d in toks:
                if tf[d][t]:
                    f = tf[d][t]
                    scores[d] = scores.get(d, 0.0) + idf * f * (k1 + 1) / (f + k1 * (1 - b + b * len(toks[d]) / avg))
        ranked = sorted(((round(s, 6), d) for d, s in scores.items()), key=lambda x: (-x[0], x[1]))[:k]
        out[q] = ranked
    return out


def test_bm25_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    qs = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {}
    for r in RT.bm25_search(docs, ["doc_id"], "text", qs, "item_id", "text", k=5).collect():
        got.setdefault(r.item_id, []).append((r.rank, r.score, r.doc_id))
    want = brute_bm25([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in qs.collect()])
    for q, ranked in want.items():
        mine = [(s, d) for _, s, d in sorted(got.get(q, []))]
        assert [d for _, d in mine] == [d for _, d in ranked]
        assert [s for s, _ in mine] == pytest.approx([s for s, _ in ranked], abs=2e-6)


def test_a_stop_word_in_every_question_makes_few_pairs(spark):
    """Each document holds one word many times, each question asks for it."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").where(
        "text <> ''").withColumn("text", F.concat("text", F.lit(" stopword stopword")))
    own = docs.select(F.col("doc_id").alias("qid"), RT.terms("text").alias("t"))
    asked = own.select("qid", F.concat_ws(" ", F.lit("stopword"), F.slice("t", 1, 4)).alias("q"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    questions = [(r.qid, r.q) for r in asked.collect()]
    got = {}
    for r in RT.bm25_search(docs, ["doc_id"], "text", asked, "qid", "q", k=3).collect():
        got.setdefault(r.qid, []).append((r.rank, r.doc_id, r.score))
    want = brute_bm25(rows, questions, k=3)
    for q, ranked in want.items():
        assert [(d, pytest.approx(s, abs=2e-6)) for s, d in ranked] == [(d, s) for _, d, s in sorted(got[q])]
    index = RT.search_index(docs, ["doc_id"], "text")
    n, total = len(rows), index.where("term is null").agg(F.sum("doc_len")).first()[0]
    post = RT.weighted_postings(index.where("term is not null"), n, total)
    qterms = RT.question_terms(asked, "qid", "q")
    bounds = RT.question_bounds(RT.term_bounds(post, ["doc_id"]), ["doc_id"], qterms, "qid", 3, 6)
    assert RT.scored_pairs(post.where("term = 'stopword'"), bounds).count() * 10 < n * len(questions)


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "two"), (2, ""), (3, None), (4, "seven")], "qid long, q string")
    assert RT.bm25_search(none, ["doc_id"], "text", asked, "qid", "q").count() == 0
    hits = RT.bm25_search(some, ["doc_id"], "text", asked, "qid", "q").collect()
    assert [(r.qid, r.rank, r.doc_id) for r in hits] == [(1, 1, 1)]


def test_term_frequencies_in_row(spark):
    df = spark.createDataFrame([(1, "b a b c b a"), (2, ""), (3, "x")], "id int, t string")
    got = {r.id: sorted((p.term, p.tf) for p in r.p) for r in
           df.select("id", RT.term_frequencies(RT.terms("t")).alias("p")).collect()}
    assert got == {1: [("a", 2), ("b", 3), ("c", 1)], 2: [], 3: [("x", 1)]}


def test_cosine_blocks_of_queries(spark):
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").repartition(5)
    queries = emb.select(F.col("vec_id").alias("qid"), "embedding").filter(F.col("label") == 3)
    one = RT.cosine_search(emb, "vec_id", "embedding", queries, "qid", "embedding", k=3)
    many = RT.cosine_search(emb, "vec_id", "embedding", queries, "qid", "embedding", k=3, block=7)
    a, b = (sorted(tuple(r) for r in x.collect()) for x in (one, many))
    assert a == b and len(a) == 3 * queries.count()
    # every vector is its own best match
    assert all(r.vec_id == r.qid for r in one.filter(F.col("rank") == 1).collect())
    none = RT.cosine_search(emb, "vec_id", "embedding", queries.limit(0), "qid", "embedding")
    assert none.count() == 0


def test_stored_index_gives_the_same_hits(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionAll(spark.createDataFrame([(-1, ""), (-2, None)], "doc_id long, text string"))
    qs = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    RT.search_index(docs, ["doc_id"], "text").write.parquet(str(tmp_path / "index"))
    stored = RT.search(spark.read.parquet(str(tmp_path / "index")), ["doc_id"], qs, "item_id", "text")
    direct = RT.bm25_search(docs, ["doc_id"], "text", qs, "item_id", "text")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, direct.collect()))


def test_search_restricted_to_corpora(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    qs = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    hits = RT.bm25_search(docs, ["doc_id"], "text", qs, "item_id", "text", corpora=["src0", "src1"],
                          corpus_col="source")
    src = {r.doc_id: r.source for r in docs.collect()}
    got = hits.collect()
    assert got and all(src[r.doc_id] in ("src0", "src1") for r in got)
    # same answer as searching the filtered table, and the DataFrame form agrees
    alone = RT.bm25_search(docs.filter(F.col("source").isin("src0", "src1")), ["doc_id"], "text", qs, "item_id",
                           "text")
    names = spark.createDataFrame([("src0",), ("src1",)], "n string")
    as_df = RT.bm25_search(docs, ["doc_id"], "text", qs, "item_id", "text", corpora=names, corpus_col="source")
    assert sorted(map(tuple, got)) == sorted(map(tuple, alone.collect())) == sorted(map(tuple, as_df.collect()))


def test_term_stats_and_title_api(spark):
    from pagesieve.functions.html import extract_title
    df = spark.createDataFrame([(1, "a b a"), (2, "b c")], "id int, t string")
    st = {r.term: (r.df, r.cf) for r in RT.term_stats(RT.build_term_index(df, ["id"], "t")).collect()}
    assert st == {"a": (1, 2), "b": (2, 2), "c": (1, 1)}
    h = spark.createDataFrame([("<h1>x</h1>", "https://e.org/")], "h string, u string")
    assert h.select(extract_title("h", "u")).first()[0] == "x"


def test_scores_added_by_document_equal_those_of_pairs(spark, monkeypatch):
    """Copies, rows that share a key, a null key and a null question; few cells at a time."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionAll(docs.where("doc_id % 3 = 0").withColumn("doc_id", F.col("doc_id") + 100000))
    docs = docs.unionAll(spark.createDataFrame([(None, "one two"), (-1, None), (-2, "")], "doc_id long, text string"))
    asked = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    asked = asked.unionAll(spark.createDataFrame([(None, "two one two"), (-1, ""), (-2, "qqqq zzzz")], asked.schema))

    def hits():
        return sorted(map(str, RT.bm25_search(docs.repartition(3), ["doc_id"], "text", asked, "item_id", "text").collect()))

    at_once = hits()
    with monkeypatch.context() as m:
        m.setattr(RT, "CELLS", 1)
        m.setattr(RT, "PAIRS", 1)
        assert hits() == at_once
    monkeypatch.setattr(RT, "QUESTION_BLOCK", 0)
    assert hits() == at_once and len(at_once) > 5


def test_terms_are_the_runs_of_letters_and_digits(spark):
    texts = ["", " ", None, "a", " a", "a ", "--A1b--c_d", "\u0130x \u00c9\u0301t", "\U00020000\U0001F600z \u6f22\u5b57\u0663", "\n\nx\t\ty"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select(RT.terms("t").alias("a"), F.regexp_extract_all(F.lower("t"), F.lit(RT.TERM_RE), 0).alias("b"))
    assert all(r.a == r.b for r in found.collect())


def test_terms_are_counted_in_tasks_by_number(spark, monkeypatch):
    """Rows that share a key, null keys, null and empty texts; few words at a time."""
    rows = [(1, "b", "b a b c b a"), (1, "b", "a"), (None, "x", "İx a a"), (2, None, ""), (3, "y", None), (4, "z", "--")]
    df = spark.createDataFrame(rows, "a long, b string, t string").coalesce(1)
    monkeypatch.setattr(RT, "WORDS", 2)
    index = RT.build_term_index(df, ["a", "b"], "t")
    assert "MapInArrow" in index._jdf.queryExecution().executedPlan().toString()
    want = [(1, "b", "a", 2, 6), (1, "b", "b", 3, 6), (1, "b", "c", 1, 6), (1, "b", "a", 1, 1), (None, "x", "i", 1, 4),
            (None, "x", "x", 1, 4), (None, "x", "a", 2, 4)]
    assert sorted(map(str, map(tuple, index.collect()))) == sorted(map(str, want))
