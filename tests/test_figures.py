import random
import shutil
from pathlib import Path

import pytest

from pagesieve.operators import versions
from pagesieve.operators.figures import FIRST, CorpusFigures
from pagesieve.sources.tables import NO_HOST

SCHEMA = "corpus string, ord long, name string, size long"


def figures_of(files):
    """(corpus -> files, bytes, first) computed anew from {(corpus, ord): (name, size)}."""
    out = {}
    for (corpus, order), (name, size) in sorted(files.items()):
        n, total, first = out.get(corpus, (0, 0, []))
        out[corpus] = (n + 1, total + size, [*first, (order, name, size)][:FIRST])
    return out


def held(kept):
    rows = kept.figures().collect()
    got = {r.corpus: (r.files, r.bytes, [tuple(e) for e in r["first"]]) for r in rows}
    assert len(rows) == len(got)
    return got


@pytest.fixture
def kept(spark, tmp_path):
    return CorpusFigures(spark, str(tmp_path / "figures"))


def test_changes_in_any_order(spark, kept):
    rng = random.Random(11)
    files = {}
    for step in range(7):
        if step in (3, 5):
            keys = rng.sample(sorted(files), len(files) // 3) + [("nowhere", 1)]
            assert kept.drop(spark.createDataFrame(keys, "corpus string, ord long")) == len(keys) - 1
            for key in keys:
                files.pop(key, None)
        elif step == 4:
            assert kept.drop_corpora(spark.createDataFrame([("c1",), ("nowhere",)], "corpus string")) == 1
            files = {k: v for k, v in files.items() if k[0] != "c1"}
        else:
            new = {(f"c{rng.choice([0, 0, 0, 1, 2])}", rng.randint(0, 60)): (f"f{step}", rng.randint(0, 99))
                   for _ in range(40)}
            assert kept.append(spark.createDataFrame([(*k, *v) for k, v in new.items()], SCHEMA)) == len(
                set(new) & set(files))
            files.update(new)
        assert held(kept) == figures_of(files), step


def test_first_files_are_taken_anew(spark, kept):
    kept.append(spark.createDataFrame([("a", i, f"f{i}", i) for i in range(2 * FIRST)], SCHEMA))
    # the dropped file makes room for a stored file, not for the later one that comes next
    kept.drop(spark.createDataFrame([("a", 0)], "corpus string, ord long"))
    kept.append(spark.createDataFrame([("a", 500, "late", 1)], SCHEMA))
    assert [e[0] for e in held(kept)["a"][2]] == list(range(1, FIRST + 1))


def test_odd_rows(spark, kept):
    assert held(kept) == {}
    assert kept.append(spark.createDataFrame([], SCHEMA)) == 0
    rows = [(None, 1, "x", 5), (NO_HOST, 2, "y", None), ("a", 1, "z", 7), ("a", 1, "z", 7), ("a", 1, "z", 3)]
    kept.append(spark.createDataFrame(rows, SCHEMA))
    assert held(kept) == {NO_HOST: (2, 5, [(1, "x", 5), (2, "y", 0)]), "a": (1, 3, [(1, "z", 3)])}
    assert kept.drop(spark.createDataFrame([(None, 1), ("a", 1)], "corpus string, ord long")) == 2
    assert held(kept) == {NO_HOST: (1, 0, [(2, "y", 0)])}


def test_only_touched_buckets_are_read_and_written(spark, kept):
    kept.append(spark.createDataFrame([(f"c{i}", 1, "f", 1) for i in range(20)], SCHEMA))
    before = versions.current(spark, kept.root)[1]["figures"]
    kept.append(spark.createDataFrame([("c3", 2, "g", 1)], SCHEMA))
    after = versions.current(spark, kept.root)[1]["figures"]
    assert len(before) > 5 and sum(before[b] != after[b] for b in before) == 1
    # files of the other buckets may be missing altogether
    changed = next(b for b in before if before[b] != after[b])
    for folder in (Path(kept.root) / "files").iterdir():
        for bucket in folder.glob("bucket=*"):
            if bucket.name != f"bucket={changed}":
                shutil.rmtree(bucket)
    assert kept.drop(spark.createDataFrame([("c3", 1)], "corpus string, ord long")) == 1
    assert held(kept)["c3"] == (1, 1, [(2, "g", 1)])


def test_a_lost_writer_changes_nothing(spark, kept, monkeypatch):
    rows = spark.createDataFrame([("a", 1, "f", 4)], SCHEMA)
    kept.append(rows)

    def lost(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", lost)
        with pytest.raises(RuntimeError):
            kept.append(spark.createDataFrame([("a", 2, "g", 9)], SCHEMA))
        with pytest.raises(RuntimeError):
            kept.drop_corpora(spark.createDataFrame([("a",)], "corpus string"))
    assert held(kept) == {"a": (1, 4, [(1, "f", 4)])}
    assert kept.append(rows) == 1 and held(kept) == {"a": (1, 4, [(1, "f", 4)])}
