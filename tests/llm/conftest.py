import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "a string, b string, token string, node string, carry string, spans string, score string")


def rows_of(pairs):
    """(id, text) pairs as documents with extra columns whose names the
    operators use inside."""
    return [(i, t, "en" if i is None or i % 2 else None, None, len(t or ""), "x", None, "y", "z", "c", "s", "1")
            for i, t in pairs]


@pytest.fixture(scope="session")
def frame(spark):
    return lambda pairs: spark.createDataFrame(rows_of(pairs), SCHEMA)


@pytest.fixture(scope="session")
def odd_pairs():
    """Null, empty, blank, very long, repeated and non-ASCII texts."""
    long_text = " ".join(f"wort{i % 977} und" for i in range(40_000))
    return [(0, None), (1, ""), (2, "   \n\t "), (3, long_text), (4, long_text + " ende"), (5, "Eins zwei drei"),
            (6, "eins ZWEI drei"), (7, "é è ê ñ ß 　   漢字"), (7, "é è ê ñ ß 　   漢字"),
            (8, "\x00\x01 control"), (9, "a" * 5000), (10, "12345 !!! ???"), (None, "no id at all here, still a text"),
            (None, None), (11, "\n\n\n")]


@pytest.fixture
def rng():
    return random.Random(11)
