import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from pagesieve.llm import bpe
from pagesieve.llm import packing as K

WORD = "word_bpe_49k.json"


def check_plan(histogram, limit, **kw):
    plan = K.plan_packing(histogram, limit, **kw)
    found = Counter()
    for lengths, count in plan:
        assert 0 < sum(lengths) <= limit and count > 0
        for x in lengths:
            found[x] += count
    assert found == Counter(histogram)
    return sum(c for _, c in plan)


def best_fit(histogram, limit):
    room, used = Counter(), 0
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fit = min((r for r in room if r >= length and room[r]), default=None)
            used += fit is None
            if fit is not None:
                room[fit] -= 1
            room[(limit if fit is None else fit) - length] += 1
    return used


def test_plans_cover_the_histogram(rng):
    for limit in (16, 100, 4096):
        for n in (1, 5, 300):
            histogram = dict(Counter(rng.choice((rng.randint(1, limit), rng.randint(1, max(1, limit // 9))))
                                     for _ in range(n)))
            used = check_plan(histogram, limit)
            assert used >= -(-sum(k * v for k, v in histogram.items()) // limit)
            assert used <= best_fit(histogram, limit) * 1.05 + 2
    assert K.plan_packing({}, 64) == []
    assert check_plan({4096: 7}, 4096) == 7


def test_patterns_pack_tightly(rng):
    histogram = dict(Counter(min(4096, int(rng.lognormvariate(6.5, 1))) + 1 for _ in range(20_000)))
    histogram = {min(k, 4096): v for k, v in histogram.items()}
    assert check_plan(histogram, 4096) <= 1.005 * sum(k * v for k, v in histogram.items()) / 4096 + 1


def test_nnls_meets_the_optimality_conditions(rng):
    a = np.array([[rng.gauss(0, 1) for _ in range(12)] for _ in range(20)])
    b = np.array([rng.gauss(0, 1) for _ in range(20)])
    x = K.nnls(a, b)
    slope = a.T @ (b - a @ x)
    assert (x >= 0).all() and (slope <= 1e-8).all() and abs(slope[x > 0]).max() < 1e-8


def test_patterns_are_all_partitions():
    assert K.patterns(4, 3) == [(4,), (3, 1), (2, 2), (2, 1, 1)]
    assert len(set(K.patterns(128, 3))) == len(K.patterns(128, 3)) == 1 + 64 + 1365


def run(df, limit=64, **kw):
    rows = K.pack_documents(df, bpe.tokenizer_path(WORD), limit, **kw).collect()
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= limit
    return rows, len(places)


def pieces_of(pairs, limit):
    tokenizer = Tokenizer.from_file(bpe.tokenizer_path(WORD))
    out = []
    for doc_id, text in pairs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), limit):
            own = ids[k:k + limit]
            out.append((doc_id, k // limit, k, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    return sorted(out, key=str)


@pytest.mark.parametrize("buckets", [None, 5])
def test_pieces_and_places(frame, rng, buckets, monkeypatch):
    if buckets:
        monkeypatch.setattr(K, "ROWS_PER_BUCKET", buckets)
        monkeypatch.setattr(K.pack_pieces, "__defaults__", (*K.pack_pieces.__defaults__[:-1], buckets))
    pairs = [(i, "some words here " * rng.randint(0, 40)) for i in range(150)]
    rows, used = run(frame(pairs))
    assert sorted([tuple(r)[:5] for r in rows], key=str) == pieces_of(pairs, 64)
    assert used <= 1.05 * -(-sum(r.length for r in rows) // 64) + 1


def test_odd_rows_and_empty_table(frame, odd_pairs):
    rows, _ = run(frame(odd_pairs), 4096)
    assert sorted([tuple(r)[:5] for r in rows], key=str) == pieces_of(odd_pairs, 4096)
    assert run(frame([]))[0] == []


def test_sequences_hold_the_ids(frame):
    df = frame([(i, "a b c " * i) for i in range(30)])
    packed = K.pack_documents(df, bpe.tokenizer_path(WORD), 32, with_ids=True)
    rows = packed.collect()
    sequences = {r.sequence_id: r.ids for r in K.packed_sequences(packed).collect()}
    for r in rows:
        assert sequences[r.sequence_id][r.offset:r.offset + r.length] == r.ids
    assert sum(map(len, sequences.values())) == sum(r.length for r in rows)
