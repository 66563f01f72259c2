"""Chunking: authored cases, and the stated properties over real documents."""

import itertools

import pytest
from pyspark.sql import functions as F

from pagesieve.functions.chunk import chunk_text
from pagesieve.operators.chunking import chunk_documents


def check_chunks(text, chunks, max_tokens, overlap, sep):
    """The stated properties, by prefix sums of paragraph tokens: a chunk ends
    where the next paragraph would pass the limit, the next one begins with the
    longest run of whole paragraphs before the cut that fits the overlap."""
    paragraphs = text.split(sep)
    total = [0, *itertools.accumulate(len(p) // 5 for p in paragraphs)]
    if len(text) // 5 <= max_tokens:
        assert chunks == [text]
        return
    start, last, want = 0, 0, []  # first paragraph of the chunk, first one that no chunk before it held
    while True:
        cut = next((i for i in range(last + 1, len(paragraphs)) if total[i + 1] - total[start] > max_tokens),
                   len(paragraphs))
        want.append(sep.join(paragraphs[start:cut]))
        if cut == len(paragraphs):
            break
        start = next((j for j in range(start, cut) if total[cut] - total[j] <= overlap), cut)
        last = cut
    assert chunks == want
    assert all(c in text for c in chunks)


def run(spark, text, max_tokens, overlap, sep="\n\n"):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(chunk_text("t", max_tokens, overlap, sep)).first()[0]


def test_authored_case(spark):
    paras = ["a" * 25, "b" * 20, "c" * 30, "d" * 15, "e" * 60]
    got = run(spark, "\n\n".join(paras), 10, 4)
    a, b, c, d, e = paras
    assert got == [f"{a}\n\n{b}", f"{b}\n\n{c}", d, f"{d}\n\n{e}"]


def test_short_text_unchanged(spark):
    assert run(spark, "x\n\ny", 10, 4) == ["x\n\ny"]


def test_big_paragraph_not_cut(spark):
    assert run(spark, "a" * 500 + "\n\nb", 10, 4) == ["a" * 500, "b"]


def test_zero_overlap_keeps_zero_token_paragraphs(spark):
    text = "\n\n".join(["a" * 30, "bb", "c" * 30])
    check_chunks(text, run(spark, text, 6, 0), 6, 0, "\n\n")


@pytest.mark.parametrize("max_tokens,overlap", [(60, 15), (30, 0), (200, 50)])
def test_properties_on_documents(spark, max_tokens, overlap):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {}
    for r in chunk_documents(docs, "doc_id", "text", max_tokens, overlap, "\n").collect():
        got.setdefault(r.doc_id, []).append((r.chunk_no, r.chunk))
    for r in docs.collect():
        check_chunks(r.text, [c for _, c in sorted(got[r.doc_id])], max_tokens, overlap, "\n")


def test_every_chunk_is_a_substring(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    chunks = chunk_documents(docs, "doc_id", "text", 60, 15, "\n")
    joined = chunks.join(docs, "doc_id")
    assert joined.filter(F.instr("text", F.col("chunk")) == 0).count() == 0


def test_zero_overlap_chunks_rejoin_to_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = {r.doc_id: r.text for r in docs.collect()}
    # documents whose every paragraph has at least one token: no paragraph can repeat
    whole = {d for d, t in rows.items() if all(len(p) >= 5 for p in t.split("\n"))}
    got = {}
    for r in chunk_documents(docs, "doc_id", "text", 60, 0, "\n").collect():
        got.setdefault(r.doc_id, []).append((r.chunk_no, r.chunk))
    assert whole
    for d in whole:
        assert "\n".join(c for _, c in sorted(got[d])) == rows[d]
