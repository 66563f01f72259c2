"""Paragraph chunking as a column expression (a fold over the paragraphs).

Rules (token = characters // 5):
  * a text of at most ``max_tokens`` tokens is one chunk, unchanged;
  * otherwise paragraphs are appended in order; before appending one that
    would push the running total past the limit (and the chunk is not
    empty), the chunk is emitted and the next one starts with the longest
    suffix of whole paragraphs whose tokens sum to at most ``overlap`` (the
    backward scan stops at the first paragraph that does not fit);
  * the paragraph is always appended, so a chunk may exceed the limit by the
    overlap or by one large paragraph; paragraphs are never cut.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagesieve import constants as K
from pagesieve.functions.text import let


def _tok(s: Column) -> Column:
    return F.floor(F.length(s) / K.CHARS_PER_TOKEN).cast("long")


def _suffix_fit(counts: Column, overlap: int) -> Column:
    """struct(n, t): how many trailing paragraphs (token ``counts``, in order)
    fit in ``overlap`` when taken from the end, stopping at the first one
    that does not fit; and their token sum."""
    init = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("t"), F.lit(False).alias("stop"))

    def merge(acc, c):
        fits = (~acc["stop"]) & (acc["t"] + c <= overlap)
        return F.struct(F.when(fits, acc["n"] + 1).otherwise(acc["n"]).alias("n"),
                        F.when(fits, acc["t"] + c).otherwise(acc["t"]).alias("t"), (~fits).alias("stop"))

    return F.aggregate(F.reverse(counts), init, merge, lambda acc: F.struct(acc["n"].alias("n"), acc["t"].alias("t")))


def chunk_text(text, max_tokens: int = K.DEFAULT_CHUNK_MAX_TOKENS, overlap: int = K.DEFAULT_CHUNK_OVERLAP,
               sep: str = "\n\n") -> Column:
    """array<string> of chunks of ``text``.

    The fold walks paragraph indices with scalar state only (chunk start,
    running total) and records each emitted chunk as "start:end;" in a
    string, so its cost is linear in the number of paragraphs; the chunk
    texts are cut afterwards with ``slice`` + ``array_join``."""
    t = F.col(text) if isinstance(text, str) else text
    paras = F.split(t, re.escape(sep), -1)

    def with_paras(ps):
        def with_counts(cnt):
            n = F.size(cnt)
            init = F.struct(F.lit("").alias("b"), F.lit(1).alias("s"), F.lit(0).cast("long").alias("tot"))

            def merge(acc, j):
                c = F.element_at(cnt, j)
                cut = (acc["tot"] + c > max_tokens) & (j > acc["s"])

                def after(fit):
                    start = F.when(cut, j - fit["n"]).otherwise(acc["s"])
                    tot = F.when(cut, fit["t"]).otherwise(acc["tot"]) + c
                    b = F.when(cut, F.concat(acc["b"], acc["s"].cast("string"), F.lit(":"),
                                             (j - 1).cast("string"), F.lit(";"))).otherwise(acc["b"])
                    return F.struct(b.alias("b"), start.alias("s"), tot.alias("tot"))

                suffix = F.when(cut, _suffix_fit(F.slice(cnt, acc["s"], j - acc["s"]), overlap))
                return let(suffix, after)

            def finish(acc):
                return F.concat(acc["b"], acc["s"].cast("string"), F.lit(":"), n.cast("string"))

            bounds = F.aggregate(F.sequence(F.lit(1), n), init, merge, finish)
            spans = F.filter(F.split(bounds, ";"), lambda x: x != "")

            def piece(span):
                se = F.split(span, ":")
                s0, e0 = se[0].cast("int"), se[1].cast("int")
                return F.array_join(F.slice(ps, s0, e0 - s0 + 1), sep)

            return F.transform(spans, piece)

        return let(F.transform(ps, _tok), with_counts)

    folded = let(paras, with_paras)
    return F.when(_tok(t) <= max_tokens, F.array(t)).otherwise(folded)
