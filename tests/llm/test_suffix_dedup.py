import numpy as np
import pytest

from pagesieve.llm import suffix_dedup as X


def brute(pairs, length=100):
    """Texts in ascending id; equal ids stand at one place."""
    first = {}
    for i, text in sorted(((i, t) for i, t in pairs if i is not None), key=lambda r: r[0]):
        raw = (text or "").encode()
        for p in range(len(raw) - length + 1):
            first.setdefault(raw[p:p + length], (i, p))
    out = []
    for i, text in pairs:
        raw = (text or "").encode()
        hit = bytearray(len(raw))
        if i is not None:
            for p in range(len(raw) - length + 1):
                if first[raw[p:p + length]] < (i, p):
                    hit[p:p + length] = b"\1" * length
        runs = sum(1 for p in range(len(raw)) if hit[p] and not (p and hit[p - 1]))
        out.append((i, len(raw), sum(hit), runs, bytes(c for c, h in zip(raw, hit, strict=True) if not h)))
    return sorted(out, key=str)


def run(df, **kw):
    out = X.dedup_substrings(df, **kw).collect()
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in out], key=str)


@pytest.fixture
def pairs(rng):
    pool = ["ab" * 80, "x" * 300, "é" * 130] + [
        "".join(rng.choice("abcd é") for _ in range(rng.randint(30, 260))) for _ in range(12)]
    return [(i, "".join(rng.choice(pool)[rng.randint(0, 20):] for _ in range(rng.randint(0, 5)))) for i in range(120)]


def test_against_brute_force(frame, pairs):
    want = brute(pairs)
    assert sum(r[2] > 0 for r in want) > 50
    assert run(frame(pairs)) == want
    assert run(frame(pairs), hot_group=3) == want
    assert run(frame(pairs), group_rows=5) == want
    assert run(frame(pairs), gram=16) == want


def test_hot_passage_and_copies(frame, rng):
    def noise(n):
        return "".join(rng.choice("abcdefghij ") for _ in range(n))

    passage, copied = noise(350), noise(700)
    pairs = [(i, noise(rng.randint(0, 160)) + passage + noise(rng.randint(0, 160))) for i in range(150)]
    pairs += [(1000 + i, copied) for i in range(60)]
    want = brute(pairs)
    assert run(frame(pairs)) == want
    assert run(frame(pairs), hot_group=50) == want


def test_length_limit(frame):
    text = "".join(chr(97 + i * i % 23) for i in range(99))
    assert [r[2] for r in run(frame([(1, text), (2, text)]))] == [0, 0]
    assert [r[2] for r in run(frame([(1, text + "!"), (2, text + "!")]))] == [0, 100]


def test_matches_never_cross_documents(frame):
    half = "".join(chr(97 + i * 7 % 26) for i in range(60))
    other = "".join(chr(97 + i * 11 % 26) for i in range(60))
    assert all(r[2] == 0 for r in run(frame([(1, half + other), (2, half), (3, other)])))


def test_odd_rows(frame, odd_pairs):
    assert run(frame(odd_pairs)) == brute(odd_pairs)


@pytest.mark.parametrize("size", [100, 300, 5000])
@pytest.mark.parametrize("hot_group", [2, 50_000])
def test_repeated_rows(frame, rng, size, hot_group):
    """Rows that repeat a document lose nothing to each other, and what other
    documents copy from them is removed there, in each of their rows."""
    text = "".join(rng.choice("abcdefgh é") for _ in range(size))
    other = text[:size // 2] + "#" + text[size // 2 - 60:]
    pairs = [(1, text), (1, text), (2, other), (2, other), (3, text), (4, "x" + text), (4, "x" + text)]
    want = brute(pairs)
    assert [r[2] for r in want if r[0] == 1] == [0, 0] and all(r[2] for r in want if r[0] == 3)
    assert run(frame(pairs), hot_group=hot_group) == want


def test_empty_table(frame):
    assert run(frame([])) == []


def test_columns_agree_with_comparison(rng):
    rows, width, length = 60, 40, 6
    symbols = np.array([[rng.choice(b"ab") for _ in range(width)] for _ in range(rows)], np.uint8)
    begin = np.array([rng.randint(0, 15) for _ in range(rows)])
    end = np.array([rng.randint(20, width) for _ in range(rows)])
    group = np.sort(np.array([rng.randint(0, 6) for _ in range(rows)]))
    rank = np.array(rng.sample(range(rows), rows))
    got = set(zip(*(x.tolist() for x in X.equal_strings(symbols, begin, end, group, rank, length)), strict=True))
    want = set()
    for i in range(rows):
        for c in range(begin[i], end[i] - length + 1):
            own = symbols[i, c:c + length].tobytes()
            if any(group[j] == group[i] and rank[j] < rank[i] and begin[j] <= c <= end[j] - length
                   and symbols[j, c:c + length].tobytes() == own for j in range(rows)):
                want.add((i, c))
    assert got == want and want


def test_merge_spans():
    starts, ends = X.merge_spans(np.array([5, 0, 20, 8]), np.array([9, 5, 30, 12]))
    assert starts.tolist() == [0, 20] and ends.tolist() == [12, 30]
