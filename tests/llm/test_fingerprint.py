import hashlib

from pagesieve.llm import fingerprint as P


def noise(rng, n):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz  .,é漢") for _ in range(n))


def brute(pairs):
    """Rows by the definition; equal ids ordered by text."""
    order = sorted(((i, t or "") for i, t in pairs), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        new = text[:len(text) - half] + following[:half]
        out.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), *P.fingerprints([text, new])))
    return sorted(out, key=str)


def run(df, **kw):
    out = P.neighbour_fingerprints(df, **kw).collect()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    return sorted([tuple(r)[:5] for r in out], key=str)


def test_neighbours_against_brute_force(frame, rng):
    pairs = [(i * 3, noise(rng, rng.randint(0, 400))) for i in range(120)] + [(7, None), (8, "")]
    want = brute(pairs)
    assert run(frame(pairs)) == want
    assert run(frame(pairs), rows_per_bucket=9) == want  # many ranges, rows carried over their borders


def test_odd_rows_and_empty_tables(frame, odd_pairs):
    distinct = [p for p in odd_pairs if p[0] is not None]
    assert run(frame(distinct)) == brute(distinct)
    assert len(run(frame(odd_pairs), rows_per_bucket=3)) == len(odd_pairs)
    assert run(frame([])) == []
    assert run(frame([(5, "alone")])) == brute([(5, "alone")])
    assert run(frame([(None, "alone")])) == brute([(None, "alone")])


def test_equal_texts_have_equal_fingerprints_in_any_company(rng):
    texts = [noise(rng, rng.choice((0, 1, 3, 20, 300, 3000))) for _ in range(40)]
    alone = [P.fingerprints([t])[0] for t in texts]
    assert P.fingerprints(texts + texts) == alone + alone


def test_likeness_follows_the_edit(rng):
    texts = [noise(rng, 3000) for _ in range(30)]
    marks = P.fingerprints(texts)
    halves = P.fingerprints([P.edited(a, b) for a, b in zip(texts, texts[1:] + texts[:1], strict=True)])
    tails = P.fingerprints([t[:2700] + noise(rng, 300) for t in texts])
    inserted = P.fingerprints([t[:1500] + "x" + t[1500:] for t in texts])

    def mean(values):
        return sum(values) / len(values)

    assert 0.35 < mean([P.likeness(a, b) for a, b in zip(marks, halves, strict=True)]) < 0.65
    assert mean([P.likeness(a, b) for a, b in zip(marks, tails, strict=True)]) > 0.8
    assert mean([P.likeness(a, b) for a, b in zip(marks, inserted, strict=True)]) > 0.7
    assert max(P.likeness(a, b) for a, b in zip(marks, marks[1:], strict=False)) < 0.1
    assert P.likeness(marks[0], P.fingerprints([""])[0]) == 0
    assert P.likeness(*P.fingerprints(["", ""])) == 1


def test_similar_documents(frame, rng):
    texts = [noise(rng, 800) for _ in range(20)]
    pairs = list(enumerate(texts)) + [(100 + i, t[:760] + noise(rng, 40)) for i, t in enumerate(texts)]
    pairs += [(200 + i, texts[0]) for i in range(5)]
    marked = P.fingerprint_documents(frame(pairs))
    found = {(r.doc_id, r.other_id): r.likeness for r in P.similar_documents(marked).collect()}
    assert sum((100 + i, i) in found for i in range(20)) >= 19
    assert all(found[200 + i, 0] == 1 for i in range(5))
    assert all(a % 100 == b % 100 or a >= 200 for a, b in found)


def linked(pairs):
    """The smallest id of every id's component."""
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {x: top(x) for x in list(root)}


def test_a_family_of_variants_against_brute_force(frame, rng):
    template = noise(rng, 900)
    kinds = [noise(rng, 500) for _ in range(12)]  # too unlike through their second halves
    texts = [template + k for k in kinds]
    texts += [template + k[:480 - i] + noise(rng, 20 + i) for i in range(3) for k in kinds]
    texts += [texts[5], "", ""]
    pairs = list(enumerate(texts))
    marks = P.fingerprints(texts)
    shared = [(a, b) for b in range(len(texts)) for a in range(b)
              if texts[a] == texts[b] or set(P.bands(marks[a])) & set(P.bands(marks[b]))]
    on_texts = dict(zip(shared, P.walk_likeness([(texts[a], texts[b]) for a, b in shared]), strict=True))
    by_marks = {(a, b): P.likeness(marks[a], marks[b]) for a, b in shared}
    marked = P.fingerprint_documents(frame(pairs))
    for likeness, args in ((by_marks, {}), (by_marks, {"block": 3}), (on_texts, {"texts": frame(pairs), "block": 7})):
        want = {p for p, v in likeness.items() if v >= 0.75}
        got = {(min(r.doc_id, r.other_id), max(r.doc_id, r.other_id)): r.likeness
               for r in P.similar_documents(marked, **args).collect()}
        assert set(got) <= want and all(abs(got[p] - likeness[p]) < 1e-9 for p in got)
        assert linked(got) == linked(want) and len(set(linked(want).values())) > 3


def test_variants_whose_bands_smaller_ids_head(spark, rng):
    """Half-alike documents of smaller ids head all bands of the variants."""
    symbols = P.ALPHABET.tobytes().decode()[:62]
    sizes = [P.samples_kept(k, 10) for k in range(10, P.FIRST_OCTAVE - 2, -1)]

    def changed(mark, where):
        return "10:" + "".join(rng.choice(symbols) if where(i) else c for i, c in enumerate(mark[3:]))

    marks = []
    for _ in range(3):
        base = changed("10:" + "0" * sum(sizes), lambda i: True)
        marks += [changed(base, lambda i, k=k: i // 16 % 2 == k) for k in range(2)]
        marks += [changed(base, lambda i: rng.random() < 0.05) for _ in range(6)]
    want = {(a, b): P.likeness(marks[a], marks[b]) for b in range(len(marks)) for a in range(b)
            if set(P.bands(marks[a])) & set(P.bands(marks[b])) and P.likeness(marks[a], marks[b]) >= 0.75}
    assert len(want) >= 40
    marked = spark.createDataFrame(list(enumerate(marks)), "doc_id long, fingerprint string")
    got = [(r.doc_id, r.other_id) for r in P.similar_documents(marked).collect()]
    assert linked(got) == linked(want)


def plain_likeness(a, b):
    classes = [list(P.character_classes(P.np.frombuffer(t.encode("utf-32-le"), P.np.uint32))) for t in (a, b)]
    places, same, either, step = [0, 0], 0, 0, 0
    while any(p < len(c) for p, c in zip(places, classes, strict=True)):
        one, two = (c[p:p + P.GRAM] for p, c in zip(places, classes, strict=True))
        either, same = either + 1, same + (one == two)
        for k, here in enumerate((one, two)):
            places[k] += int(P.MOVES[step % P.PERIOD][here[0]]) if here else 0
        step += 1
    return same / either if either else 1.0


def test_walk_likeness_against_single_steps(rng):
    texts = [noise(rng, rng.choice((0, 1, 5, 200))) for _ in range(8)]
    texts += [t[:150] + noise(rng, 30) for t in texts]
    pairs = [(a, b) for a in texts for b in texts]
    assert all(abs(x - plain_likeness(*p)) < 1e-12 for x, p in zip(P.walk_likeness(pairs), pairs, strict=True))
