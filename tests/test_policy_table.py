"""Pattern tables of any length against plain containment."""

import random

from pyspark.sql import functions as F

from pagesieve.operators import policy as PO
from pagesieve.operators import policy_table as PT

PATTERNS = ["ab", "b", "abc", "bcab", "é", "漢字", "a b", "", None, "ab", "zz-top"]


def test_hits_of_all_blocks(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("abc é漢字A") for _ in range(rng.randint(0, 30))), rng.choice([None, "x", "ZZ-Top"]))
            for i in range(300)]
    df = spark.createDataFrame(rows, "id long, title string, _hits_ string").repartition(3)
    table = spark.createDataFrame([(p,) for p in PATTERNS], "pattern string")
    files = PT.build_automata(table, block_chars=4)
    assert len(files) > 2
    want = {i: sorted({p for p in PATTERNS if p and p in f"{t} {h or ''}".lower()}) for i, t, h in rows}
    for kw in ({}, {"group_bytes": 1}):
        found = PT.find_patterns(df, ("title", "_hits_", "absent"), files, **kw)
        assert {r.id: r._hits for r in found.collect()} == want
        assert found.columns == ["id", "title", "_hits_", "_hits"]
    kept = PT.apply_table(df, ("title", "_hits_"), table)
    assert {r.id for r in kept.collect()} == {i for i, x in want.items() if not x} and kept.columns == df.columns


def test_same_as_the_fixed_list(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url")
    patterns = ["example", "/en/", "page", "net"]
    table = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    audit = PT.audit_table(pages, ("url",), table).withColumn("patterns", F.array_join("patterns", ","))
    assert sorted(map(tuple, audit.collect())) == sorted(
        map(tuple, PO.policy_audit(pages, ("url",), patterns).select(audit.columns).collect()))


def test_no_pattern_and_no_row(spark):
    none = spark.createDataFrame([], "pattern string")
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id long, title string")
    assert PT.apply_table(rows, ("title",), none).count() == 2 and PT.audit_table(rows, ("title",), none).count() == 0
    some = spark.createDataFrame([("a",)], "pattern string")
    assert PT.audit_table(rows.limit(0), ("title",), some).count() == 0
