import math

import numpy as np

from pagesieve.llm import language as L

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in L.identify_documents(docs).collect() if r.held_out]
    assert len(held) > 150 and np.mean([want[r.doc_id] == r.lang_pred for r in held if want[r.doc_id]]) > 0.98


def test_predictions_do_not_depend_on_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    changed = docs.selectExpr("doc_id", "text", "if(crc32(string(doc_id)) % 4 = 2, 'xx', lang) AS lang", "1 AS score")
    first, second = ({tuple(r) for r in L.identify_documents(d).collect()} for d in (docs, changed))
    assert first == second


def counts_of(texts):
    data = "".join(texts).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    grams, n = np.unique(L.gram_codes(np.frombuffer(data, np.uint8), offsets), return_counts=True)
    return grams, n


def test_code_lengths_against_a_plain_model():
    """Probabilities from dictionaries of contexts, symbol by symbol."""
    learned = {"x": ["abracadabra", "cab"], "y": ["bbbb ccc", ""]}
    trees = L.Trees({k: counts_of(v) for k, v in learned.items()})
    texts = ["abra cab", "", "zzz", "bcbcbc", "é"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    got = trees.code_lengths(data, offsets)
    for k, lang in enumerate(trees.langs):
        table = {}
        for text in learned[lang]:
            symbols = [0] * L.ORDER + [int(L.SYMBOL[b]) for b in text.encode()]
            for i in range(L.ORDER, len(symbols)):
                for order in range(L.ORDER + 1):
                    context = tuple(symbols[i - order:i])
                    table.setdefault(context, {}).setdefault(symbols[i], 0)
                    table[context][symbols[i]] += 1

        def bits(context, symbol, table=table):
            seen = table.get(context, {})
            n, q = sum(seen.values()), len(seen)
            if symbol in seen:
                return math.log2((n + q) / seen[symbol])
            escape = math.log2((n + q) / q) if q else 0
            return escape + (bits(context[1:], symbol) if context else math.log2(L.SYMBOLS))

        for row, text in enumerate(texts):
            symbols = [0] * L.ORDER + [int(L.SYMBOL[b]) for b in text.encode()]
            want = sum(bits(tuple(symbols[i - L.ORDER:i]), symbols[i]) for i in range(L.ORDER, len(symbols)))
            assert abs(got[row, k] - want) < 1e-3


def test_rare_strings_count(spark):
    texts = ["the words of every day come again and again " * 60_000, "a rare word: Łódź, façade, qzx"]
    docs = spark.createDataFrame([(t, "x") for t in texts], "text string, lang string")
    [got], want = L.fit(docs), L.Trees({"x": counts_of(texts)})
    rare = np.frombuffer("Łódź façade qzx, unknown jkv".encode(), np.uint8)
    bits = [t.code_lengths(rare, np.array([0, len(rare)])) for t in (got, want)]
    assert (got.row_of == want.row_of).all() and bits[0][0, 0] == bits[1][0, 0]


def test_any_number_of_languages(spark, rng):
    rows = [(i, f"lang{i % 70:02d}", " ".join(f"{chr(97 + i % 70 % 26)}{chr(97 + i % 70 // 5)}{rng.choice('aeiou')}"
                                               for _ in range(30))) for i in range(420)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    found = [sorted(tuple(r) for r in L.identify_documents(docs, languages_per_block=n).collect()) for n in (100, 16, 7)]
    for other in found[1:]:
        assert [r[:3] for r in other] == [r[:3] for r in found[0]]
        assert np.allclose([r[3] for r in other], [r[3] for r in found[0]], atol=1e-9)
    assert len({r[2] for r in found[0]}) > 64
    assert len(L.identify_documents(docs).collect()) == 420


def test_odd_rows_and_empty_tables(frame, odd_pairs):
    out = L.identify_documents(frame(odd_pairs)).collect()
    assert len(out) == len(odd_pairs)
    for r in out:
        text = dict(odd_pairs).get(r.doc_id)
        if r.doc_id is not None:
            lettered = any(c.isalpha() for c in text or "")
            assert (r.lang_pred == "und") == (not lettered) and 0 <= r.score <= 1
    assert L.identify_documents(frame([])).count() == 0
    unlabelled = frame(odd_pairs).drop("lang").selectExpr("*", "cast(null AS string) AS lang")
    assert {r.lang_pred for r in L.identify_documents(unlabelled).collect()} == {"und"}


def test_letters_beyond_ascii():
    assert L.has_letter("漢") and L.has_letter("é") and not L.has_letter("— 12 !") and not L.has_letter(None)
