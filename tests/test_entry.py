"""Driver contract: entry smoke, registry shape and oracle parity on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from pagesieve.plans import registry

FAST = ["scan_pages", "clean_pages", "convert_pages", "classify_urls", "policy_audit", "select_sources",
        "source_failures", "doc_names", "chunk_documents", "keyword_search", "vector_search", "corpus_summary",
        "tier_pricing", "incremental_append"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "document" in df.columns


def test_every_query_has_an_oracle_or_is_listed():
    assert set(E.oracle_sql()) <= set(E.queries())
    q, o = registry.queries(), registry.oracle_sql()
    assert len(q) >= 45
    assert set(q) == set(o)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["pages", "documents", "benchmark", "embeddings"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    return c


def _rows(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", FAST)
def test_oracle_parity_small(spark, con, name):
    sp = E.queries()[name](spark, "/root/testdata/sf0.001").toPandas()
    dd = con.execute(E.oracle_sql()[name]).fetchdf()
    cols = sorted(sp.columns)
    assert cols == sorted(dd.columns)
    assert _rows(sp[cols]) == _rows(dd[cols])
