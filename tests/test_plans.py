"""Scale properties of the physical plans (guards against regressions)."""

import pytest
from pyspark.sql import functions as F

from pagesieve import constants as K
from pagesieve.operators import chunking as CH
from pagesieve.operators import convert as CV
from pagesieve.operators import policy as PO
from pagesieve.operators import retrieval as RT


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def split_pages(spark, tmp_path_factory):
    """Pages stored as many files, as a large input would be."""
    path = str(tmp_path_factory.mktemp("pages16") / "t")
    spark.read.parquet("/root/testdata/sf0.01/pages.parquet").repartition(16).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def split_docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs16") / "t")
    spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(16).write.parquet(path)
    return spark.read.parquet(path)


def test_conversion_adds_no_shuffle(split_pages):
    p = plan(CV.convert_pages(split_pages, "2024-01-01T00:00:00"))
    assert "Exchange" not in p
    assert "ReadSchema: struct<page_id:bigint,url:string,html:string>" in p


def test_cleaning_reads_two_columns_and_no_shuffle(split_pages):
    p = plan(CV.clean_pages(split_pages))
    assert "Exchange" not in p and "ReadSchema: struct<page_id:bigint,html:string>" in p


def test_chunking_and_term_index_add_no_shuffle(split_docs):
    chunks = CH.chunk_documents(split_docs, "doc_id", "text", 60, 15, "\n")
    assert "Exchange" not in plan(chunks)
    assert "Exchange" not in plan(RT.build_term_index(chunks, ["doc_id", "chunk_no"], "chunk"))


def test_policy_is_a_filter_not_a_join(split_pages):
    p = plan(PO.apply_policy(split_pages, ("url",), K.BANNED_PATTERNS + K.PAGE_POLICY_EXTRA))
    assert "Join" not in p and "Exchange" not in p


def test_bm25_joins_terms_by_broadcast(spark, split_docs):
    qs = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    p = plan(RT.bm25_search(split_docs, ["doc_id"], "text", qs, "item_id", "text"))
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" in p
    assert "WindowGroupLimit" in p


def test_cosine_search_has_no_join(spark):
    emb = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    cen = RT.centroids(emb.select("label", "embedding"), "label", "embedding")
    p = plan(RT.cosine_search(emb, "vec_id", "embedding", cen, "label", "embedding"))
    assert "Join" not in p and "Generate" not in p and "WindowGroupLimit" in p and "MapInArrow" in p


def test_ordinal_windows_by_group_and_bucket(spark):
    from pagesieve.operators.ordinal import position_within
    df = spark.range(0, 1000).select((F.col("id") % 2).cast("string").alias("g"), F.col("id").alias("k"))
    p = plan(position_within(df, "g", "k", "pos"))
    # the row-number window never partitions by the group alone
    import re
    windows = re.findall(r"Window \[row_number\(\).*?\], \[([^\]]*)\]", p)
    assert windows and all("_b" in w for w in windows)


def test_a_table_of_few_files_is_dealt_out(spark, split_pages):
    from pagesieve.sources.tables import dealt, read_pages
    one = read_pages(spark, "/root/testdata/sf0.001/pages.parquet")
    out = dealt(one, "page_id")
    assert "hashpartitioning(page_id" in plan(CV.convert_pages(out, "2024-01-01T00:00:00"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, one.collect()))
    assert "Exchange" not in plan(dealt(split_pages, "page_id"))  # as many files as cores: read as they are


def test_passage_citations_deals_out_its_pages(spark, monkeypatch):
    from pagesieve.plans import registry
    seen = []
    monkeypatch.setattr(registry, "materialize", lambda df: seen.append(plan(df)) or df)
    registry.q_passage_citations(spark, "/root/testdata/sf0.001")
    assert "hashpartitioning(page_id" in seen[0]


def test_the_kept_index_deals_out_its_documents(spark, monkeypatch):
    from pagesieve.plans import registry
    seen = []

    class Store:
        def __init__(self, *a, **b): pass
        def append(self, df): seen.append(plan(df))
        def drop_where(self, *a): pass

    monkeypatch.setattr(registry.IX, "IndexStore", Store)
    registry._kept_index(spark, "/root/testdata/sf0.001")
    assert len(seen) == 3 and all("hashpartitioning(doc_id" in p for p in seen)
