import random
import re
import weakref

import pyarrow as pa
from pyspark.sql import functions as F

from pagesieve.llm import decontaminate as D


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=13):
    out = []
    windows = {}
    for name, text in items:
        words = words_of(text)
        if words and name is not None:
            size = min(window, len(words))
            for k in range(len(words) - size + 1):
                windows.setdefault(tuple(words[k:k + size]), set()).add(name)
    sizes = {len(w) for w in windows}
    for i, text in docs:
        words, hit, found = words_of(text), set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                names = windows.get(tuple(words[k:k + size]))
                if names:
                    hit.update(range(k, k + size))
                    found |= names
        out.append((i, len(words), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def run(spark, df, items, **kw):
    table = spark.createDataFrame(items, "item_id string, text string")
    out = D.find_contamination(df, table, **kw).collect()
    return sorted([(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in out], key=str)


def case(rng):
    vocabulary = [f"w{i}" for i in range(40)] + ["é1", "ÉA", "Don't"]
    items = [(f"i{k}", " ".join(rng.choice(vocabulary) for _ in range(rng.choice((1, 4, 12, 13, 14, 40)))))
             for k in range(25)]
    items += [("i0", items[5][1] + " again"), ("copy", items[7][1]), ("none", ""), ("null", None), ("marks", "... !!")]
    docs = []
    for i in range(150):
        parts = []
        for _ in range(rng.randint(0, 6)):
            words = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, 5)
            parts += words[a:] if rng.random() < 0.5 else [rng.choice(vocabulary) for _ in range(15)]
            parts += [f"other{rng.randint(0, 99)}"]
        docs.append((i, ", ".join(parts).upper() if rng.random() < 0.3 else " ".join(parts)))
    return docs, items


def test_against_brute_force(spark, frame, rng):
    docs, items = case(rng)
    want = brute(docs, items)
    assert any(r[2] for r in want)
    assert run(spark, frame(docs), items) == want


def test_blocks_of_items_find_the_same(spark, frame, rng):
    docs, items = case(rng)
    assert run(spark, frame(docs), items, block_words=20) == brute(docs, items)


def test_a_task_holds_one_block(spark, frame, rng, monkeypatch):
    docs, items = case(rng)
    df, table = frame(docs), spark.createDataFrame(items, "item_id string, text string")
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, function, schema: function)
    task = D.find_contamination(df, table, block_words=20)
    alive, most = weakref.WeakSet(), []
    build = D.Block.__init__

    def counted(self, *args):
        alive.add(self)
        most.append(len(alive))
        build(self, *args)

    monkeypatch.setattr(D.Block, "__init__", counted)
    batch = pa.RecordBatch.from_pydict({"doc_id": [d[0] for d in docs], "text": [d[1] for d in docs]})
    rows = [r for out in task(iter([batch, batch])) for r in out.to_pylist()]
    assert len(rows) == 2 * len(docs) and len(most) > 3 and max(most) == 1


def test_odd_rows_and_empty_tables(spark, frame, odd_pairs):
    items = [("a", "eins zwei drei"), ("b", "漢字"), (None, "text")]
    assert run(spark, frame(odd_pairs), items) == brute(odd_pairs, items)
    assert run(spark, frame(odd_pairs), []) == brute(odd_pairs, [])
    assert run(spark, frame([]), items) == []


def test_coverage_rule(spark):
    rows = spark.createDataFrame([(13, 260), (13, 261), (0, 0), (0, 5), (1, 20)], "h long, w long")
    got = [r[0] for r in rows.select(D.is_contaminated(F.col("h"), F.col("w"))).collect()]
    assert got == [True, False, False, False, True]


def test_drop_and_cut(spark, frame, odd_pairs):
    item = " ".join(f"q{i}" for i in range(20))
    docs = [*odd_pairs, (50, f"Before. {item.upper()}! After é."), (51, item + " filler" * 1000)]
    items = spark.createDataFrame([("a", item)], "item_id string, text string")
    kept = D.drop_contaminated(frame(docs), items)
    assert kept.columns == frame(docs).columns
    ids = [r.doc_id for r in kept.collect()]
    assert 50 not in ids and 51 in ids and len(ids) == len(docs) - 1
    cut = {r.doc_id: r.text for r in D.cut_contamination(frame(docs), items).where("doc_id >= 50").collect()}
    assert cut == {50: "Before. ! After é.", 51: " filler" * 1000}


def test_automaton_holds_exactly_the_substrings():
    rng = random.Random(4)
    items = [(k, [rng.randint(0, 2) for _ in range(rng.randint(1, 12))]) for k in range(6)]
    automaton = D.SuffixAutomaton(items, 3)
    held = {tuple(w[a:b]) for _, w in items for a in range(len(w)) for b in range(a + 1, len(w) + 1)}
    for length in range(1, 6):
        for code in range(3**length):
            words = [code // 3**k % 3 for k in range(length)]
            state = 0
            for word in words:
                state = automaton.step[state].get(word, -1) if state >= 0 else -1
            assert (state >= 0) == (tuple(words) in held)
