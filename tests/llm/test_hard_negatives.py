import math

import numpy as np
import pytest

from pagesieve.llm import hard_negatives as X

SCHEMA = "vec_id long, embedding array<double>, label int, v string, norm string, angles int, score string"


def make(spark, rows):
    return spark.createDataFrame([(i, v, c, "x", None, 1, "s") for i, v, c in rows], SCHEMA)


def brute(rows, every=100, n_pos=5, n_neg=10):
    one = {}
    for i, v, c in rows:
        if i is None or c is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = (c, [math.floor(256 * x) for x in v])
        one[i] = min(one.get(i, q), q)
    out = []
    for a, (label, qa) in one.items():
        if a % every:
            continue
        found = []
        for i, (c, q) in one.items():
            s = sum(x * y for x, y in zip(qa, q, strict=False))
            found.append((-max(-(2 ** 63 - 1), min(s, 2 ** 63 - 1)), i, c))
        found.sort()
        for s, p, _ in [f for f in found if f[2] == label and f[1] != a][:n_pos]:
            near = [f for f in found if f[2] != label and -30 * s <= -100 * f[0] <= -90 * s][:n_neg]
            out += [(a, p, r, i, -s, -t) for r, (t, i, _) in enumerate(near, 1)]
    return sorted(out)


def run(df, **kw):
    return sorted(tuple(r) for r in X.mine_hard_negatives(df, **kw).collect())


@pytest.fixture
def rows(rng):
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    out = []
    for i in range(700):
        c = rng.choice(centres)
        out.append((i, [x + rng.gauss(0, .4) for x in c], rng.randint(0, 3)))
    out += [(1000 + i, [.5, .25, 0., -.5, 1., 2.], i % 4) for i in range(150)]  # one vector very often
    return out


def test_against_brute_force(spark, rows):
    want = brute(rows)
    assert len({r[0] for r in want}) >= 5 and len(want) > 100
    assert run(make(spark, rows)) == want
    assert run(make(spark, rows), chunk=40, block=2) == want


def test_small_pieces_and_steps(spark, rows, monkeypatch):
    """Floors and limits carried over pieces, in this process."""
    monkeypatch.setattr(X, "PIECE", 16)
    monkeypatch.setattr(X, "STEP", 2)
    plain = [(i, c, [math.floor(256 * x) for x in v]) for i, v, c in rows]
    refs = X.spread_directions(np.array([r[2] for r in plain], float))
    own = table(plain, refs)
    anchors = X.Rows(table([r for r in plain if r[0] % 100 == 0], refs))
    found = {}
    for ids, top in X.positives_of(anchors, X.Rows(own)):
        for g, i, s in zip(top.group, top.ids, top.score, strict=True):
            found.setdefault(int(ids[g]), []).append((int(i), int(s)))
    got = []
    for lists, top in X.negatives_of(anchors, [found.get(int(i), []) for i in anchors.ids], X.Rows(own)):
        got += [(*lists[g], int(i), int(s)) for g, i, s in zip(top.group, top.ids, top.score, strict=True)]
    assert sorted((a, p, n, t, s) for a, p, t, n, s in got) == sorted((a, p, n, t, s) for a, p, _, n, t, s in brute(rows))


def table(rows, refs):
    import pyarrow as pa

    v = np.array([r[2] for r in rows], float)
    norms = np.sqrt((v * v).sum(axis=1))
    return pa.table({"vec_id": [r[0] for r in rows], "label": [r[1] for r in rows],
                     "v": pa.array([x.astype("<f8").tobytes() for x in v], pa.binary()), "norm": norms,
                     "angles": pa.array([x.tobytes() for x in X.angles_to(v, norms, refs)], pa.binary())})


def test_bounds_hold_and_discard(rng):
    """Every score is inside its bounds; of clustered rows most are left out."""
    centres = np.random.default_rng(1).normal(size=(8, 16)) * 200
    near = np.random.default_rng(2).normal(size=(400, 16)) * 8
    v = np.floor(centres[np.arange(400) % 8] + near)
    refs = X.spread_directions(v)
    rows = X.Rows(table([(i, 0, list(x)) for i, x in enumerate(v)], refs))
    lower, upper = X.score_bounds(rows, rows)
    real = (rows.v @ rows.v.T)
    assert (lower <= real).all() and (real <= upper).all()
    fifth = np.sort(real, axis=1)[:, -6]
    assert (upper >= fifth[:, None]).mean() < 0.25


def test_odd_rows(spark):
    odd = [(0, [1., 2.], 1), (100, None, 1), (200, [], 1), (300, [0., 0.], 1), (None, [1., 2.], 1), (400, [1., None], 2),
           (500, [1., float("nan")], 2), (600, [float("inf"), 1.], 2), (700, [1., 2.], None), (1, [1., 2.], 1),
           (2, [.6, 1.], 2), (2, [.6, 1.], 2), (3, [.5, 1., 7.], 2), (4, [-1., 0.], 1), (5, [], 2), (800, [1e17, 1.], 1),
           (6, [1e17, 2.], 1), (7, [5e16, 0.], 2), (900, [3e4, 1.], 3), (901, [3e4, 5.], 3), (902, [2e4, 9.], 2)]
    want = brute(odd)
    assert want and run(make(spark, odd)) == want


def test_empty_table(spark):
    assert run(make(spark, [])) == []
    assert run(make(spark, [(1, [1.], 1)])) == []
