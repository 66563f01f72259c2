import hashlib
import re

import numpy as np
import pytest

from pagesieve.llm import fill_in_middle as X


def brute(i, text, fim=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= fim:
        return i, len(units), "plain", None, None, text, text
    form = "spm" if h[3] % 100 < spm else "psm"
    out = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    return i, len(units), form, len(prefix), len(middle), out, text


def run(df, **kw):
    return sorted((tuple(r) for r in X.restore_text(X.fill_in_middle(df, **kw)).collect()), key=str)


@pytest.fixture
def pairs(rng):
    parts = ["\n", "eins zwei", "é漢字", "<", ">", "<P", "S>", "M", "\n\n", "😀", "P>x"]
    return [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for i in range(400)]


@pytest.mark.parametrize("rates", [{}, {"fim_percent": 50}, {"spm_percent": 0}])
def test_against_brute_force(frame, pairs, rates):
    pairs = [*pairs, (900, "a <P> in it\nb\n"), (901, "<M>"), (902, "x<S>")]
    want = sorted((brute(i, t, rates.get("fim_percent", 100), rates.get("spm_percent", 50)) for i, t in pairs), key=str)
    assert run(frame(pairs), **rates) == want
    assert {r[2] for r in want} >= {"plain", "psm"}


def test_small_pieces(frame, pairs, monkeypatch):
    """Shifts carried over the borders of pieces, as in very long texts."""
    ids = [i for i, _ in pairs]
    raw = [t.encode() for _, t in pairs]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    monkeypatch.setattr(X, "PIECE", 7)
    _, form, one, two = X.cut_places(data, offsets, ids, 7, (100, 50))
    out, out_offsets = X.scatter(data, offsets, form, one, two)
    texts = [out[a:b].tobytes().decode() for a, b in zip(out_offsets[:-1], out_offsets[1:], strict=True)]
    assert texts == [brute(i, t)[5] for i, t in pairs]
    back, back_offsets = X.gather(out, out_offsets, form)
    assert back.tobytes() == data.tobytes() and back_offsets.tolist() == offsets.tolist()


def test_odd_rows(frame, odd_pairs):
    assert run(frame(odd_pairs)) == sorted((brute(i, t) for i, t in odd_pairs), key=str)


def test_empty_table(frame):
    assert run(frame([])) == []


def test_output_without_markers():
    with pytest.raises(ValueError, match="markers"):
        X.gather(np.frombuffer(b"<P>only", np.uint8), np.array([0, 7]), np.array([1]))
