"""Fallback over a stream: early winners, any arrival order, closing by event time."""

import datetime as dt
import itertools

from pagesieve.operators import fallback as FB
from pagesieve.streaming import attempts as SA

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def frame(spark, rows):
    return spark.createDataFrame(rows, SA.ATTEMPT_SCHEMA).coalesce(1)


def clock(minutes):
    return (None, None, None, None, None, None, at(minutes))


def test_certain_winner():
    assert SA.certain_winner({}) is None
    assert SA.certain_winner({"2": ["b", True, None]}) is None
    assert SA.certain_winner({"1": ["a", False, "x"], "2": ["b", True, None]}) == 2
    assert SA.certain_winner({"1": ["a", True, None], "2": ["b", True, None]}) == 1
    assert SA.certain_winner({"1": ["a", False, "x"], "3": ["c", True, None]}) is None


def test_outcomes_leave_when_certain_and_survive_a_restart(spark, tmp_path):
    batches = [
        [("t1", 2, "b", "ok", 3, None, at(1)), ("t2", 1, "a", "ok", 1, None, at(1)),
         ("t3", 1, "a", "failed", 0, "down", at(1)), ("t4", 3, "c", "ok", 2, None, at(1)),
         ("t5", 1, "a", None, None, None, at(1))],
        [("t1", 1, "a", "ok", 0, None, at(2)), ("t2", 1, "z", "ok", 9, None, at(2)), ("t3", 2, "b", "ok", 0, None, at(2))],
        [clock(600)],
        [("t2", 1, "again", "ok", 1, None, at(700)), ("t3", 3, "late", "ok", 1, None, at(3))],
    ]
    seen = []
    for i, rows in enumerate(batches):
        frame(spark, rows).write.parquet(str(tmp_path / "in" / str(i)))
        for _ in range(2):  # again over the same files: nothing is added
            q = SA.follow_attempts(spark, str(tmp_path / "in"), str(tmp_path / "out"), dt.timedelta(hours=1), "1 hour",
                                   str(tmp_path / "checkpoint"))
            q.awaitTermination()
            assert q.exception() is None
        out = spark.read.schema(SA.OUTCOMES).parquet(str(tmp_path / "out"))
        seen.append(sorted(tuple(r) for r in out.collect()))
    t2, t1 = ("t2", "won", 1, "a", 1, None), ("t1", "won", 2, "b", 2, None)
    assert seen[0] == [t2]
    assert seen[1] == [t1, t2]
    closed = sorted([t1, t2, ("t3", "failed", 2, "b", 2, "No data returned from b"), ("t4", "won", 3, "c", 1, None),
                     ("t5", "failed", 1, "a", 1, FB.ALL_FAILED)])
    assert seen[2] == closed
    assert seen[3] == sorted([*closed, ("t2", "won", 1, "again", 1, None)])  # a new run; the late row is left out


def test_any_arrival_order_gives_the_batch_result(spark):
    ok = {1: (False, True, True), 2: (False, False, True), 3: (True, False, False), 4: (False, False, False)}
    rows = [(f"t{t}", r + 1, f"s{r}", "ok" if won else "failed", 1, None if won else f"e{r}", at(r))
            for t, results in ok.items() for r, won in enumerate(results)]
    whole = frame(spark, rows)
    wanted = sorted([(r.target, "won", r.rank, r.source_id, None) for r in FB.winners(whole).collect()]
                    + [(r.target, "failed", 3, "s2", r.error) for r in FB.source_failures(whole).collect()])
    for order in itertools.islice(itertools.permutations(range(3)), 0, 6, 2):
        arrivals = [frame(spark, [r for r in rows if r[1] == k + 1]) for k in order]
        got = SA.run_attempts(spark, [*arrivals, frame(spark, [clock(900)])], dt.timedelta(hours=1))
        assert sorted((r.target, r.outcome, r.rank, r.source_id, r.error) for r in got.collect()) == wanted
