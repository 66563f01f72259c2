"""The registered queries on whole small tables against brute-force versions."""

import hashlib
import html
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
import test_decontaminate
import test_fill_in_middle
import test_fingerprint
import test_hard_negatives
import test_line_dedup
import test_ngram_join
import test_packing
import test_simhash
import test_suffix_dedup
from tokenizers import Tokenizer

import __spark_entry__ as entry
from pagesieve.llm import bpe, language

SF = "/root/testdata/sf0.001"


def table(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def docs():
    return [(r["doc_id"], r["text"]) for r in table("documents")]


@pytest.fixture(scope="module")
def items():
    return [(str(r["item_id"]), r["text"]) for r in table("benchmark")]


def run(spark, name):
    df = entry.queries()[name](spark, SF)
    return df, df.collect()


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def test_every_operator_has_one_query():
    numbers = [int(m[1]) for m in (re.match(r"op(\d+)_", n) for n in entry.queries()) if m]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_op1(spark, docs):
    df, rows = run(spark, "op1_ngram_join")
    assert df.columns[:3] == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r)[:3] for r in rows), key=str) == test_ngram_join.brute(docs)


def test_op2(spark, docs):
    df, rows = run(spark, "op2_fingerprints")
    assert df.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                          "near_next"]
    assert sorted((tuple(r)[:5] for r in rows), key=str) == test_fingerprint.brute(docs)
    assert np.median([r.near_edited for r in rows]) > 0.3 and np.median([r.near_next for r in rows]) < 0.05


def test_op3(spark, docs):
    _, rows = run(spark, "op3_suffix_dedup")
    want = sorted((i, n, cut, spans, sha(kept)) for i, n, cut, spans, kept in test_suffix_dedup.brute(docs))
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == want


def test_op4(spark):
    _, rows = run(spark, "op4_main_text")
    want = {}
    for r in table("pages"):
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        want[r["page_id"]] = (r["url"], "\n".join(x for x in blocks if x))
    assert {r.page_id: (r.url, r.text) for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)


def test_op5(spark, docs):
    df, rows = run(spark, "op5_quality")
    assert df.columns == ["doc_id", "held_out", "score", "predicted"] and len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_op6(spark, docs):
    _, rows = run(spark, "op6_language")
    texts = dict(docs)
    langs = {r["doc_id"]: r["lang"] for r in table("documents")}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not language.has_letter(texts[r.doc_id]))
    held = [langs[r.doc_id] == r.lang_pred for r in rows if r.held_out and langs[r.doc_id]]
    assert np.mean(held) > 0.95


def test_op7(spark, docs):
    df, rows = run(spark, "op7_token_records")
    assert df.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    tokenizer, want, start = Tokenizer.from_file(bpe.tokenizer_path("byte_bpe_50k.json")), [], 0
    for i, text in sorted(docs):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in rows) == want


def test_op8(spark, docs):
    _, rows = run(spark, "op8_best_fit_packing")
    assert sorted((tuple(r)[:5] for r in rows), key=str) == test_packing.pieces_of(docs, 4096)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        own.sort()
        ends = np.cumsum([n for _, n in own])
        assert [o for o, _ in own] == [0, *ends[:-1]] and ends[-1] <= 4096
    assert len(places) <= -(-sum(r.length for r in rows) // 4096) + 2


def test_op9(spark, docs, items):
    _, rows = run(spark, "op9_decontaminate")
    want = []
    for i, n, hit, found in test_decontaminate.brute(docs, items):
        want.append((i, n, hit, len(found), sha(",".join(found)), hit > 0 and 20 * hit >= n))
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows]
    assert sorted(got) == sorted(want) and any(r.contaminated for r in rows)


def test_op10(spark, docs):
    _, rows = run(spark, "op10_line_dedup")
    want = sorted((i, n, cut, sha(kept)) for i, n, cut, kept in test_line_dedup.brute(docs))
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in rows) == want


def test_op11(spark, docs):
    df, rows = run(spark, "op11_simhash")
    assert df.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in rows), key=str) == test_simhash.brute(docs)


def test_op12(spark, docs):
    df, rows = run(spark, "op12_fill_in_middle")
    assert df.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    want = sorted((*x[:5], sha(x[5]), sha(x[6])) for x in (test_fill_in_middle.brute(i, t) for i, t in docs))
    assert sorted(tuple(r) for r in rows) == want and {r.form for r in rows} >= {"psm", "spm"}


def test_op13(spark):
    _, rows = run(spark, "op13_hard_negatives")
    table_rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"])
                  for r in table("embeddings")]
    assert sorted(tuple(r) for r in rows) == test_hard_negatives.brute(table_rows) and rows


def test_pipeline(spark, docs, items):
    """Stage by stage; a stage's brute-force version works on the rows of the
    stage before it."""
    import corpus_pipeline
    from pagesieve.llm.tables import materialize

    names = ["quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names
    stages, before, frame = [], sorted(docs), spark.read.parquet(f"{SF}/documents.parquet")
    columns = frame.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        frame = materialize(stage(spark, frame, SF))
        if k < 4:
            assert frame.columns == columns
            stages.append((before, sorted((r.doc_id, r.text) for r in frame.collect())))
            before = stages[-1][1]
            assert all(r.n_chars == len(r.text) for r in frame.collect())
    good = {r.doc_id for r in entry.queries()["op5_quality"](spark, SF).where("predicted = 1").collect()}
    assert stages[0][1] == [d for d in stages[0][0] if d[0] in good]
    assert stages[1][1] == sorted((i, kept) for i, _, _, kept in test_line_dedup.brute(stages[1][0]))
    stay = {i for i, _, c in test_ngram_join.brute(stages[2][0]) if i == c}
    assert stages[2][1] == [d for d in stages[2][0] if d[0] in stay]
    bad = {i for i, n, hit, _ in test_decontaminate.brute(stages[3][0], items) if hit and 20 * hit >= n}
    assert bad and stages[3][1] == [d for d in stages[3][0] if d[0] not in bad]
    rows = frame.collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == test_packing.pieces_of(before, 4096)
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted(tuple(r)[:5] for r in whole) == sorted(tuple(r)[:5] for r in rows)
