import re

import numpy as np

from pagesieve.llm import ngram_join as J
from pagesieve.llm import shingles as S
from pagesieve.llm.components import connected_components


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(pairs):
    sets = [shingle_set(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(pairs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    group = {}
    for k, (i, _) in enumerate(pairs):
        if i is not None:
            group[find(k)] = min(group.get(find(k), i), i)
    return sorted([(i, len(sets[k]), group.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(pairs)], key=str)


def run(df, **kw):
    return sorted([tuple(r) for r in J.similar_components(df, **kw).collect()], key=str)


def near_copies(rng, n_groups=12, size=8):
    words = [f"w{i}" for i in range(4000)]
    pairs = []
    for _ in range(n_groups):
        base = [rng.choice(words) for _ in range(rng.randint(3, 120))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 3, 6))):
                own[rng.randrange(len(own))] = rng.choice(words)
            pairs.append((len(pairs), " ".join(own)))
    rng.shuffle(pairs)
    return pairs


def test_shingles(rng):
    texts = ["", " ", "one", "a b c d", "a b c d e", "A b C d e f", "é è ê ñ ß é è ê ñ ß é", "x " * 40, "a\tb\nc\x0bd\x0ce\rf"]
    for text, found in zip(texts, S.text_shingles(texts), strict=True):
        assert len(found) == len(shingle_set(text))
    a, b = S.text_shingles(["p q r s t u", "P Q R S T U"])
    assert (a == b).all()


def test_against_brute_force(frame, rng):
    pairs = near_copies(rng)
    want = brute(pairs)
    assert len({r[2] for r in want}) < len(pairs)
    assert run(frame(pairs)) == want


def test_one_large_group_of_near_copies(frame, rng):
    base = [f"b{i}" for i in range(60)]
    pairs = []
    for i in range(250):
        own = list(base)
        for _ in range(rng.choice((0, 1, 1, 2, 2, 3))):
            own[rng.randrange(60)] = f"z{rng.randrange(9999)}"
        pairs.append((i, " ".join(own)))
    pairs += [(1000 + i, pairs[0][1]) for i in range(100)]  # copies
    assert run(frame(pairs)) == brute(pairs)


def test_small_parts_find_the_same(frame, rng, monkeypatch):
    pairs = near_copies(rng, 3, 40)
    monkeypatch.setattr(J, "LEADERS", 1)
    df = frame(pairs)
    points = J.document_points(df.select("doc_id", "text"))
    blocks = J.route(df.select("doc_id", "text"), np.zeros(0, np.uint64), J.THRESHOLD).selectExpr(
        "token", "node", "false AS salted")
    none = df.sparkSession.createDataFrame([], "node long, component long")
    one = {tuple(r) for r in J.open_pairs(blocks, points, none, J.THRESHOLD, 1024).collect()}
    many = {tuple(r) for r in J.open_pairs(blocks, points, none, J.THRESHOLD, 7).collect()}
    assert one == many and one


def test_tree_finds_all_that_the_bound_allows(rng):
    points = np.array([[rng.randint(0, 4) for _ in range(J.GROUPS)] for _ in range(200)], np.uint32)
    points[100:] = points[:100]
    points[100:, :3] += 1
    totals = points.sum(axis=1, dtype=np.int64)
    tree = J.CountTree(points, totals, leaf=4)
    for i in range(0, 200, 17):
        want = [k for k in range(200) if 7 * np.minimum(points[i], points[k]).sum() >= 3 * (totals[i] + totals[k])]
        assert sorted(tree.search(points[i], int(totals[i]), J.THRESHOLD).tolist()) == want


def test_tree_join_finds_each_pair_of_components_once(rng):
    points = np.array([[rng.randint(0, 3) for _ in range(J.GROUPS)] for _ in range(90)], np.uint32)
    points[30:] = points[np.array([rng.randrange(30) for _ in range(60)])]
    points[60:, rng.randrange(9)] += 1
    comps = np.array([rng.choice((1, 1, 1, 2, 3, 10 + i)) for i in range(90)])
    totals = points.sum(axis=1, dtype=np.int64)

    def fits(i, j):
        return comps[i] != comps[j] and 7 * np.minimum(points[i], points[j]).sum() >= 3 * (totals[i] + totals[j])

    one = np.zeros(90, int)
    got = [tuple(sorted(p)) for p in J.search_parts(one, comps, points, J.THRESHOLD)]
    want = {(i, j) for i in range(90) for j in range(i + 1, 90) if fits(i, j)}
    assert set(got) == want and len(got) == len(want)
    two = np.array([rng.randrange(2) for _ in range(90)])
    got = [tuple(sorted(p)) for p in J.search_parts(two, comps, points, J.THRESHOLD)]
    want = {(i, j) for i, j in want if two[i] != two[j]}
    assert set(got) == want and len(got) == len(want)


def test_threshold_is_exact(frame):
    # three of four shingles in common: 75 in 100 exactly; then one less
    a, b = "a b c d e f g", "a b c d e f g h"
    assert run(frame([(1, a), (2, b)])) == [(1, 3, 1), (2, 4, 1)]
    assert run(frame([(1, "a b c d e f"), (2, "a b c d e f g")])) == [(1, 2, 1), (2, 3, 2)]


def test_odd_rows(frame, odd_pairs):
    assert run(frame(odd_pairs)) == brute(odd_pairs)


def test_empty_tables(frame):
    assert run(frame([])) == []
    assert run(frame([(4, None), (5, "")])) == [(4, 0, 4), (5, 0, 5)]


def test_keep_one_of_each(frame, odd_pairs):
    df = frame(odd_pairs)
    kept = J.keep_one_of_each(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 6 not in ids and 4 not in ids and ids.count(None) == 2 and ids.count(7) == 2 and 0 in ids


def test_components(spark, rng):
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(64)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    got = dict(connected_components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {x: find(x) for e in edges for x in e if find(x) != x}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_the_number_of_frequent_tokens_is_bounded(frame):
    docs = frame([(i, f"the same words in all of them and {i % 7} of {i % 5}") for i in range(400)]).select("doc_id", "text")
    every, few = (J.frequent_tokens(docs, 400, most=n) for n in (1 << 20, 5))
    assert len(every) > 5 and len(few) == 5 and set(few) <= set(every)
