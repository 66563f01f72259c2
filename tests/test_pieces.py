"""The piece store: cuts depend on content, edits stay local, appends add what is new."""

import random

import pytest
from pyspark.sql import functions as F

from pagesieve.operators import pieces as PC
from pagesieve.operators import versions


def brute_ends(raw):
    hits = []
    for end in range(PC.WINDOW, len(raw) + 1):
        total = sum(raw[end - 1 - j] * PC.MULTIPLIER ** j for j in range(PC.WINDOW))
        if total * PC.SPREAD % 2 ** 32 < 2 ** 32 // PC.SHARE:
            hits.append(end)
    cuts = [e for i, e in enumerate(hits) if i == 0 or e - hits[i - 1] >= PC.MIN_BYTES]
    ends, last = [], 0
    for cut in sorted({*cuts, len(raw)}):
        while cut - last > PC.MAX_BYTES:
            last += PC.MAX_BYTES
            ends.append(last)
        ends.append(cut)
        last = cut
    return ends


def noise(n, seed=1):
    r = random.Random(seed)
    return "".join(r.choice("abcdefghij klmn\né") for _ in range(n))


@pytest.mark.parametrize("text", ["a", "x" * 15, "x" * 16, "x" * 17, "y" * 30_000, noise(20_000), noise(900, 2) * 30, "é" * 9_000])
def test_cuts_against_brute_force(text):
    raw = text.encode()
    got = PC.cut_ends(raw).tolist()
    assert got == brute_ends(raw)
    assert got[-1] == len(raw) and all(0 < b - a <= PC.MAX_BYTES for a, b in zip([0, *got], got))


def test_an_edit_changes_the_pieces_around_it():
    raw = noise(60_000).encode()
    edited = raw[:30_000] + b"edit" + raw[30_000:]

    def pieces(data):
        ends = PC.cut_ends(data).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    assert len(pieces(raw)) > 20
    assert len(set(pieces(edited)) - set(pieces(raw))) <= 3


def docs(spark, rows):
    return spark.createDataFrame(rows, "id long, text string")


def test_store(spark, tmp_path):
    long = noise(40_000)
    first = {1: long, 2: long, 3: "", 4: None, 5: "short", 6: noise(9_000, 3) + long}
    second = {1: long[:20_000] + "new words" + long[20_000:], 2: long, 5: "short", 7: "other", 8: None}
    store = PC.PieceStore(spark, str(tmp_path / "store"))
    assert store.pieces().count() == 0
    assert store.append(docs(spark, list(first.items())).withColumn("seq", F.lit("clash")), "one", "id")
    held = {r.sha256 for r in store.pieces().collect()}
    assert store.pieces().count() == len(held)
    assert store.append(docs(spark, list(second.items())), "two", "id")
    after = [r.sha256 for r in store.pieces().collect()]
    assert len(after) == len(set(after)) and len(set(after) - held) <= 4  # the edit and "other"
    assert not store.append(docs(spark, list(second.items())), "two", "id")
    assert store.pieces().count() == len(after)
    for name, texts in (("one", first), ("two", second)):
        got = {int(r.key): (r.text, r.n_pieces) for r in store.texts(name).collect()}
        assert {k: t for k, (t, _) in got.items()} == {k: t or "" for k, t in texts.items()}
        assert all((n == 0) == (not texts[k]) for k, (_, n) in got.items())
    assert store.append(docs(spark, []), "empty", "id") and store.texts("empty").count() == 0


def test_a_lost_append_leaves_nothing(spark, tmp_path, monkeypatch):
    store = PC.PieceStore(spark, str(tmp_path / "store"))
    store.append(docs(spark, [(1, "one")]), "one", "id")
    with monkeypatch.context() as m:
        m.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.append(docs(spark, [(2, "two")]), "two", "id")
    assert store.pieces().count() == 1 and store.texts("two").count() == 0
    store.append(docs(spark, [(2, "two")]), "two", "id")
    assert [r.text for r in store.texts("two").collect()] == ["two"]
