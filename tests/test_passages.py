"""Best passages against a brute-force search of all windows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pagesieve.operators import passages as PS


def brute(text, terms):
    words = [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[^\W_]+", text)]
    have = {w for w, _, _ in words} & set(terms)
    best = None
    for a in range(len(words)):
        seen = set()
        for b in range(a, len(words)):
            seen.add(words[b][0])
            if have <= seen:
                if best is None or b - a < best[1] - best[0]:
                    best = (a, b)
                break
    a, b = best
    return a, b, words[a][1], words[b][2], text[words[a][1]:words[b][2]]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(8)
    words = ["ab", "cd", "Ef", "gh", "é", "漢", "x1", "yy", "zz"]
    docs = [(i, "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(rng.randint(1, 60))))
            for i in range(60)]
    docs += [(100, "; ab! cd"), (101, "ab"), (102, "ab cd ab cd")]
    asked = [(i, " ".join(rng.sample(words, rng.randint(1, 4)))) for i in range(12)]
    hits = [(q, d) for q, text in asked for d, t in docs if set(text.lower().split()) & set(
        re.findall(r"[^\W_]+", t.lower()))]
    return docs, asked, hits


def test_against_all_windows(spark, tables):
    docs, asked, hits = tables
    frames = (spark.createDataFrame(docs, "d long, body string"), spark.createDataFrame(asked, "q long, t string"),
              spark.createDataFrame([(q, d, 1) for q, d in hits], "q long, d long, rank int"))
    out = PS.best_passages(frames[2], frames[0], ["d"], "body", frames[1], "q", "t")
    assert out.columns == ["q", "d", "rank", "first_word", "last_word", "start", "passage", "end"]
    got = {(r.q, r.d): (r.first_word, r.last_word, r.start, r.end, r.passage) for r in out.collect()}
    texts, terms = dict(docs), {q: t.lower().split() for q, t in asked}
    assert got == {(q, d): brute(texts[d], terms[q]) for q, d in hits}
    assert got and all(v[4] == texts[d][v[2]:v[3]] for (_, d), v in got.items())


def test_positions(spark):
    df = spark.createDataFrame([(1, "b A, b"), (2, ""), (3, None)], "k long, t string")
    got = {(r.k, r.term): r.positions for r in PS.positional_postings(df, ["k"], "t").collect()}
    assert got == {(1, "a"): [1], (1, "b"): [0, 2]}
    none = PS.best_passages(df.select(F.lit(1).alias("q"), "k").limit(0), df, ["k"], "t", spark.createDataFrame(
        [(1, "a")], "q int, t string"), "q", "t")
    assert none.count() == 0


def test_positions_are_found_in_the_row_of_a_document(spark):
    """Words leave their row only where rows share a key."""
    rows = [(1, "b a B"), (2, "x a"), (2, "a y a"), (None, "n"), (None, "n m"), (3, ""), (4, None), (5, "é 漢 É")]
    df = spark.createDataFrame(rows, "id int, t string")
    want = {}
    for i, t in rows:
        for place, term in enumerate((t or "").lower().split()):
            want.setdefault((i, term), []).append(place)
    got = {(r.id, r.term): r.positions for r in PS.positional_postings(df, ["id"], "t").collect()}
    assert got == {x: sorted(places) for x, places in want.items()}
    one = df.select(PS.term_positions(PS.word_list(F.col("t"))).alias("p")).first().p
    assert [(x.term, x.positions) for x in one] == [("a", [1]), ("b", [0, 2])]
