"""Positional postings and the best passage of a hit.

A document's words are numbered; a posting holds a term's positions. The best
passage of a (question, document) hit is the smallest run of words that holds
every term of the question that the document has; of equal ones the first. It is found
by one fold over the terms' positions in order, which keeps the last position of
each term: the run ends here and begins at the smallest of them (the two
pointers). Positions of a hit's terms meet in one row, bounded by the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesieve.functions.text import let
from pagesieve.operators.retrieval import TERM_RE, question_terms, same_keys
from pagesieve.session import materialize

#: words and what stands between them, so that a text is the sum of its tokens
TOKEN_RE = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN_RE), 0)


def word_list(text: Column) -> Column:
    """The words of a text as they stand in it, lower-cased one by one."""
    return F.transform(F.regexp_extract_all(text, F.lit(TERM_RE), 0), F.lower)


def term_positions(words: Column) -> Column:
    """array<struct<term, positions>> of one document, made inside its row: the
    (term, place) pairs in order, cut where the term changes."""
    placed = F.sort_array(F.transform(words, lambda w, i: F.struct(w.alias("term"), i.alias("place"))))

    def runs(names, places):
        n = F.size(names)
        idx = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(idx, lambda i: (i == 1) | (F.element_at(names, i) != F.element_at(names, i - 1)))
        return let(starts, lambda st: F.transform(st, lambda s, j: F.struct(
            F.element_at(names, s).alias("term"),
            F.slice(places, s, F.coalesce(F.try_element_at(st, j + 2), n + 1) - s).alias("positions"))))

    return let(placed, lambda srt: let(srt["term"], lambda names: let(
        srt["place"], lambda places: runs(names, places))))


def positional_postings(corpus: DataFrame, keys, text_col: str) -> DataFrame:
    """(keys..., term, positions): the places of each term, from 0, ascending.

    A document's words stay in its row. Only rows that share their key are taken
    apart and grouped, since the places of all of them belong to one posting; the
    keys alone are counted to find them."""
    keys = list(keys)
    many = materialize(corpus.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(
        *[F.col(c).alias(f"_{c}") for c in keys]))
    same = same_keys(keys)
    own = corpus.join(many, same, "left_anti").select(
        *keys, F.explode(term_positions(word_list(F.col(text_col)))).alias("_p"))
    shared = corpus.join(many, same, "left_semi").select(
        *keys, F.posexplode(word_list(F.col(text_col))).alias("place", "term"))
    return own.select(*keys, "_p.term", "_p.positions").unionAll(
        shared.groupBy(*keys, "term").agg(F.array_sort(F.collect_list("place")).alias("positions")))


def smallest_window(places: Column, n_terms: Column) -> Column:
    """struct(first, last) of the smallest run of positions that holds all terms,
    of an ascending array of (place, term number from 0)."""
    nothing = F.lit(-1)
    start = F.struct(F.array_repeat(nothing, n_terms).alias("seen"), F.lit(0).alias("first"),
                     F.lit(2 ** 31 - 1).alias("last"))

    def step(state: Column, x: Column) -> Column:
        seen = F.transform(state["seen"], lambda p, i: F.when(i == x["t"], x["place"]).otherwise(p))
        return let(seen, lambda s: let(F.array_min(s), lambda low: F.when(
            (low >= 0) & (x["place"] - low < state["last"] - state["first"]),
            F.struct(s.alias("seen"), low.alias("first"), x["place"].alias("last"))).otherwise(
            F.struct(s.alias("seen"), state["first"].alias("first"), state["last"].alias("last")))))

    return F.aggregate(places, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def best_passages(hits: DataFrame, corpus: DataFrame, keys, text_col: str, questions: DataFrame, qkey: str,
                  qtext: str) -> DataFrame:
    """``hits`` (qkey, keys..., ...) with first_word, last_word (word numbers),
    start, end (characters of the text, end excluded) and passage."""
    keys = list(keys)
    docs = materialize(hits.select(*keys).distinct().join(corpus.select(*keys, text_col), keys))
    asked = question_terms(questions, qkey, qtext)
    places = positional_postings(docs, keys, text_col)
    pairs = hits.select(qkey, *keys).distinct().join(asked, qkey).join(places, [*keys, "term"])
    # the terms that the document has, numbered; at most a question's terms
    own = pairs.groupBy(qkey, *keys).agg(F.array_sort(F.collect_list(F.struct("term", "positions"))).alias("_terms"))
    each = F.flatten(F.transform("_terms", lambda x, i: F.transform(
        x["positions"], lambda p: F.struct(p.alias("place"), i.alias("t")))))
    run = smallest_window(F.array_sort(each), F.size("_terms"))
    found = own.select(qkey, *keys, run.alias("_w"))
    token_of = F.when(F.regexp_like(F.col("_tokens")[0], F.lit(r"^[\p{L}\p{N}]")), 0).otherwise(1)
    cut = (hits.join(found, [qkey, *keys]).join(docs, keys).withColumn("_tokens", tokens(F.col(text_col)))
           .withColumn("_a", 2 * F.col("_w.first") + token_of).withColumn("_n", 2 * (F.col("_w.last") - F.col("_w.first")) + 1))
    passage = F.array_join(F.slice("_tokens", F.col("_a") + 1, F.col("_n")), "")
    start = F.length(F.array_join(F.slice("_tokens", F.lit(1), F.col("_a")), "")).cast("long")
    out = cut.select(*hits.columns, F.col("_w.first").alias("first_word"), F.col("_w.last").alias("last_word"),
                     start.alias("start"), passage.alias("passage"))
    return out.withColumn("end", F.col("start") + F.length("passage"))
