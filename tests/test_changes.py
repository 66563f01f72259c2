"""Changes of crawls: statuses, expiry, restart from the checkpoint."""

import datetime as dt

from pagesieve.streaming import changes as SC

DAY = dt.datetime(2024, 1, 1)


def at(n):
    return DAY + dt.timedelta(days=n)


def crawl(spark, rows):
    return spark.createDataFrame(rows, SC.CRAWL_SCHEMA)


def test_statuses_and_restart(spark, tmp_path):
    crawls = [
        [(1, "a", "x", at(0)), (2, "b", "x", at(0)), (3, None, None, at(0)), (9, "a", "other", at(0)), (4, "c", "", at(0))],
        [(1, "a", "x", at(2)), (2, "b", "y", at(2)), (5, "d", "z", at(2))],
        [(2, "b", "y", at(9)), (1, "a", "x", at(9)), (7, "c", "", at(9))],
    ]
    for i, rows in enumerate(crawls):
        crawl(spark, rows).coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
        for _ in range(2):  # again over the same files: nothing is added
            q = SC.follow_crawls(spark, str(tmp_path / "in"), str(tmp_path / "out"), dt.timedelta(days=5),
                                 str(tmp_path / "checkpoint"))
            q.awaitTermination()
            assert q.exception() is None
    out = spark.read.schema(SC.CHANGES).parquet(str(tmp_path / "out"))
    got = sorted((r.url, r.crawled_at, r.status, r.page_id) for r in out.collect())
    assert got == sorted([
        ("a", at(0), "new", 1), ("b", at(0), "new", 2), ("unknown-3", at(0), "new", 3), ("c", at(0), "new", 4),
        ("a", at(2), "unchanged", 1), ("b", at(2), "changed", 2), ("d", at(2), "new", 5),
        ("a", at(9), "unchanged", 1), ("b", at(9), "unchanged", 2), ("c", at(9), "unchanged", 7),
        ("unknown-3", at(0), "gone", 3), ("d", at(2), "gone", 5)])
