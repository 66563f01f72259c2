import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pagesieve.llm import bpe
from pagesieve.llm import records as R

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"


def plain(name):
    tokenizer = Tokenizer.from_file(bpe.tokenizer_path(name))
    tokenizer.encode_special_tokens = True
    return tokenizer


def odd_texts(rng, n=4000):
    letters = list("ab'  \n\t,1é́ ſİΣσς!.;_=×÷é") + [
        "'s", "'ll", " the", "\n", "é.", "the", "̸", chr(0x85), chr(0x2003), chr(0x3000), chr(0x1C), "漢", "…"]
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(n)] + [
        "", " ", "don't  we'll\n\n\n x", "<|endoftext|> a <|startoftext|>", "x" * 3000]


@pytest.mark.parametrize("name", [BYTE, WORD])
def test_ids_equal_the_librarys(name, rng):
    texts = odd_texts(rng)
    encoder = bpe.Encoder(bpe.tokenizer_path(name), max_parts=3000)  # it is emptied on the way
    want = [x.ids for x in plain(name).encode_batch(texts, add_special_tokens=False)]
    got = []
    for k in range(0, len(texts), 300):
        got += [x.tolist() for x in encoder.encode(pa.array(texts[k:k + 300]))]
    assert got == want


def run(df):
    manifest = R.write_records(df, bpe.tokenizer_path(BYTE))
    return manifest, R.read_records(manifest, with_ids=True, records_per_read=7).collect()


def test_round_trip(spark, frame, rng):
    tokenizer = plain(BYTE)
    pairs = [(i * 5 % 101, t) for i, t in enumerate(odd_texts(rng, 96))]
    manifest, rows = run(frame(pairs).repartition(5))
    start = 0
    for row, (doc_id, text) in zip(sorted(rows, key=lambda r: r.start), sorted(pairs), strict=True):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32, row.ids) == (doc_id, start, len(ids), crc, ids)
        start += len(ids)
    assert sum(r.n_tokens for r in manifest.collect()) == start


def test_odd_rows_and_empty_table(frame, odd_pairs):
    _, rows = run(frame(odd_pairs))
    assert len(rows) == len(odd_pairs)
    order = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted((p[0] for p in odd_pairs), key=lambda x: (x is not None, x or 0))
    assert [r.ids for r in rows if r.doc_id in (0, 1)] == [[0], [0]]
    assert run(frame([]))[1] == []


def test_damage_is_found(frame):
    record = R.frame(R.pack_payload(7, np.array([1, 2, 70], np.uint32), 2))
    doc_id, ids = R.unpack_payload(R.unframe(record, 0)[0])
    assert doc_id == 7 and ids.tolist() == [1, 2, 70]
    assert R.unpack_payload(R.pack_payload(None, np.array([1 << 20], np.uint32), 4))[1].tolist() == [1 << 20]
    for k in range(len(record)):
        broken = record[:k] + bytes([record[k] ^ 1]) + record[k + 1:]
        with pytest.raises(R.CorruptRecord):
            R.unframe(broken, 0)
    with pytest.raises(R.CorruptRecord):
        R.unframe(record[:-1], 0)


def test_a_range_is_read_by_the_index(frame):
    manifest, rows = run(frame([(i, "word " * i) for i in range(40)]).coalesce(1))
    file = manifest.orderBy("shard").first()
    first = list(R.read_range(file["file"], 0, file["n_records"]))
    assert [x[0] for x in R.read_range(file["file"], 3, 6)] == [x[0] for x in first[3:6]]
