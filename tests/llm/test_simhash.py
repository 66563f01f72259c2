import re

import numpy as np
import pytest
import xxhash

from pagesieve.llm import simhash as X

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mark(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else \
        [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(marks):
    """Smallest reachable index by comparing all pairs."""
    marks = np.array(marks, np.uint64)
    comp = np.arange(len(marks))
    near = np.bitwise_count(marks[:, None] ^ marks[None, :]) <= 3 if len(marks) else np.zeros((0, 0), bool)
    while True:
        new = np.array([comp[row].min() for row in near], int)
        if (new == comp).all():
            return comp.tolist()
        comp = new


def brute(pairs):
    marks = [mark(t) for _, t in pairs]
    comp = components(marks)
    least = {}
    for (i, _), c in zip(pairs, comp, strict=True):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return sorted(((i, f"{m:016x}", least.get(c)) for (i, _), m, c in zip(pairs, marks, comp, strict=True)), key=str)


def run(df, **kw):
    return sorted((tuple(r) for r in X.near_duplicates(df, **kw).collect()), key=str)


@pytest.fixture
def pairs(rng):
    def text(n):
        return [rng.choice("ab cde fgh ij é ÀB Zz 漢".split()) + str(rng.randint(0, 99)) for _ in range(n)]

    base = [text(rng.randint(0, 120)) for _ in range(40)]
    out = []
    for i in range(400):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            if words:
                words[rng.randrange(len(words))] = "neu" + str(rng.randint(0, 5))
        out.append((i * 3 % 401, rng.choice([" ", "\n", "  \t"]).join(words)))
    return out


def test_against_brute_force(frame, pairs):
    want = brute(pairs)
    sizes = np.unique([r[2] for r in want], return_counts=True)[1]
    assert sizes.max() > 5 and len({r[1] for r in want}) > len(sizes)
    assert run(frame(pairs)) == want


def test_blocks_in_parts(frame, pairs):
    assert run(frame(pairs), part=4) == brute(pairs)


def test_odd_rows(frame, odd_pairs):
    odd = [*odd_pairs, (20, "one"), (21, "one two"), (22, "ONE  two"), (None, "one two")]
    assert run(frame(odd)) == brute(odd)


def test_empty_table(frame):
    assert run(frame([])) == []


def test_every_close_pair_shares_a_block(spark, rng):
    rows = []
    for i in range(200):
        fp = rng.getrandbits(64)
        other = fp
        for b in rng.sample(range(64), 3):
            other ^= 1 << b
        rows += [(i, fp - (fp >> 63 << 64)), (i, other - (other >> 63 << 64))]
    df = spark.createDataFrame(rows, "pair long, fp long")
    keys = df.select("pair", X.block_keys(df["fp"]).alias("keys")).collect()
    by_pair = {}
    for r in keys:
        by_pair.setdefault(r.pair, []).append(set(r.keys))
    assert all(a & b for a, b in by_pair.values()) and len(keys[0].keys) == 10


def test_block_links_connect_all(rng):
    """A ball of near fingerprints, chains and strangers in one block."""
    centre = rng.getrandbits(64)
    fps = {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(300)}
    fps |= {rng.getrandbits(64) for _ in range(100)}
    chain = rng.getrandbits(64)
    for b in range(0, 60, 3):
        chain ^= 7 << b
        fps.add(chain)
    fps = np.array(sorted(fps), np.uint64)
    group = np.zeros(len(fps), np.int64)
    a, b = X.block_links(group, fps)
    assert len(a) < len(fps) and (np.bitwise_count(fps[a] ^ fps[b]) <= 3).all()
    parent = list(range(len(fps)))
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = X.root_of(parent, x), X.root_of(parent, y)
        parent[max(p, q)] = min(p, q)
    assert [X.root_of(parent, x) for x in range(len(fps))] == components(fps)


def test_distances_bound_coordinates(rng):
    fps = np.array([rng.getrandbits(64) for _ in range(50)], np.uint64)
    table = X.distance_table(fps).astype(int)
    real = np.bitwise_count(fps[:, None] ^ fps[None, :])
    assert (np.abs(table[:, :, None] - table[:, None, :]).max(axis=0) <= real).all()
