"""Batch retrieval over a corpus: term index, BM25 and cosine top-k.

Plan shape (BM25), exact top-k. Up to 4,096 questions: the postings of the question
terms are grouped by document, and each task adds up its documents' scores with the
questions' terms at hand and passes on k documents per question. More questions:
pairs with score bounds:
  corpus -> terms counted inside each document's row (sorted terms -> run
  lengths) -> explode -> postings; no (doc, term) shuffle. Every document also
  gets one row without a term, so the index alone knows the number of documents
  and their lengths. An index can be stored and searched again; one that is
  kept up to date is in ``index_store``.
  postings of the question terms only -> written once with their idf at hand
  1. bounds: the largest contribution per (term, block) and the document that has
     it; documents of like length are a block, since length is what contributions
     of a term differ by
  2. floor: those documents' contributions, summed per (question, document);
     contributions are positive, so the k-th sum bounds the question's k-th score
     from below
  3. per (question, block) the terms are taken by ascending bound: while their sum
     stays below a share of the floor, a document that holds no other term of the
     question can't be among the first k. Only postings of the other, essential
     terms are paired with questions, so a stop word makes no pairs
  4. the k-th essential sum is a better floor; documents whose essential sum and
     the bounds of the rest reach it get the contributions of the rest added
  5. top-k per question (WindowGroupLimit trims each task's rows first)
Contributions are whole multiples of 2**-40, so their sums are exact in any order.
Frequent terms never gather in one task: the term joins are map-side when the
question side is broadcast, and split by adaptive execution otherwise; all
later keys are (question, doc).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from pagesieve import constants as K
from pagesieve.functions.text import let
from pagesieve.session import materialize
from pagesieve.sources.tables import spread

TERM_RE = r"[\p{L}\p{N}]+"
BETWEEN_RE = r"[^\p{L}\p{N}]+"


def terms(text) -> Column:
    """Lower-cased letter/digit runs: what is left when the text is cut at all
    else, which takes half the time of extracting them."""
    t = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(t), BETWEEN_RE, -1), "")


def term_frequencies(terms_col: Column) -> Column:
    """array<struct<term, tf>> of one document, computed inside the row:
    sort the terms, find where each run starts, take run lengths. All terms
    of a document are in its row, so no shuffle is needed to count them."""
    def runs(srt):
        n = F.size(srt)
        idx = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(idx, lambda i: (i == 1) | (F.element_at(srt, i) != F.element_at(srt, i - 1)))
        return let(starts, lambda st: F.transform(
            st, lambda s, j: F.struct(F.element_at(srt, s).alias("term"),
                                      (F.coalesce(F.try_element_at(st, j + 2), n + 1) - s).cast("long").alias("tf"))))
    # sort_array compares natively, array_sort by a lambda per comparison
    return let(F.sort_array(terms_col), runs)


#: words that a task counts at a time; a document with more is counted at once
WORDS = 1 << 18


def count_terms(tok: DataFrame, cols) -> DataFrame:
    """(cols..., term, tf, doc_len), one per row (cols..., _t) and different term.
    Rows are counted as batches of term numbers inside their task (no shuffle)."""
    cols = list(cols)
    schema = T.StructType([*[tok.schema[c] for c in cols], T.StructField("term", T.StringType()),
                           T.StructField("tf", T.LongType()), T.StructField("doc_len", T.IntegerType())])

    def count(batches):
        for batch in batches:
            own, lists = batch.select(list(range(len(cols)))), batch.column(len(cols))
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            words, ends = lists.flatten(), np.cumsum(n)
            at = 0
            while at < len(n):
                before = int(ends[at - 1]) if at else 0
                to = max(int(np.searchsorted(ends, before + WORDS, "right")), at + 1)
                part = words.slice(before, int(ends[to - 1]) - before).dictionary_encode()
                size = max(len(part.dictionary), 1)
                cell = np.repeat(np.arange(at, to), n[at:to]) * size + part.indices.to_numpy(zero_copy_only=False)
                cells, tf = np.unique(cell, return_counts=True)
                if len(cells):
                    row, code = np.divmod(cells, size)
                    place = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [*[c.take(place) for c in own.columns], part.dictionary.take(pa.array(code)),
                         pa.array(tf.astype(np.int64)), pa.array(n[row].astype(np.int32))], names=schema.names)
                at = to

    return tok.select(*cols, "_t").mapInArrow(count, schema)


def build_term_index(df: DataFrame, keys, text_col: str) -> DataFrame:
    """Postings (keys..., term, tf, doc_len), one row per (document, term)."""
    keys = list(keys)
    return count_terms(df.select(*keys, terms(text_col).alias("_t")), keys)


def restrict_to_corpora(df: DataFrame, corpora, corpus_col: str = "corpus") -> DataFrame:
    """Keep rows of the named corpora; ``corpora`` is a list of names or a
    one-column DataFrame (semi join, so its size never matters)."""
    if corpora is None:
        return df
    if isinstance(corpora, DataFrame):
        names = corpora.select(F.col(corpora.columns[0]).alias(corpus_col)).distinct()
        return df.join(names, corpus_col, "left_semi")
    return df.filter(F.col(corpus_col).isin(list(corpora)))


def term_stats(postings: DataFrame) -> DataFrame:
    """(term, df, cf) over a postings table."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def search_index(corpus: DataFrame, keys, text_col: str) -> DataFrame:
    """An index that ``search`` can use, now or from storage: the postings, and
    per document a row with a null term, zero tf and its length."""
    keys = list(keys)
    tok = corpus.select(*keys, terms(text_col).alias("_t"))
    mark = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("tf")))
    ex = tok.select(*keys, F.size("_t").alias("doc_len"),
                    F.explode(F.concat(mark, term_frequencies(F.col("_t")))).alias("_p"))
    return ex.select(*keys, F.col("_p.term").alias("term"), F.col("_p.tf").alias("tf"), "doc_len")


def question_terms(questions: DataFrame, qkey: str, qtext: str) -> DataFrame:
    """(qkey, term): the distinct terms of each question."""
    return questions.select(qkey, F.explode(F.array_distinct(terms(qtext))).alias("term")).distinct()


#: share of a floor that terms may add together to stay out of the pairs: a smaller one
#: makes more pairs, and fewer documents that need the rest
REST = 0.3
#: contributions are counted in units of this size
UNIT = 2.0 ** -40


def length_block(doc_len: Column) -> Column:
    """Documents whose lengths are within half an octave."""
    return F.floor(2 * F.log2(doc_len + 1)).cast("int")


def weighted_postings(postings: DataFrame, n_docs: int, total_len: int, k1: float = K.BM25_K1,
                      b: float = K.BM25_B) -> DataFrame:
    """``postings`` (keys, term, tf, doc_len) with each one's BM25 contribution
    ``w`` in units and its document's block; idf = ln(1 + (N-df+0.5)/(df+0.5))."""
    avgdl = total_len / n_docs if n_docs else 0.0
    idf = F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = materialize(postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select("term", idf.alias("idf")))
    w = F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("doc_len") / avgdl))
    return postings.join(weights, "term").withColumn("w", F.round(w / UNIT).cast("long")).withColumn(
        "block", length_block(F.col("doc_len")))


def kth_largest(sums: DataFrame, qkey: str, k: int, decimals: int, name: str) -> DataFrame:
    """(qkey, name): no document below it is among the question's first k, when
    ``sums`` holds no more than documents' scores ``s``."""
    order = Window.partitionBy(qkey).orderBy(F.desc("s"))
    kth = sums.select(qkey, "s").withColumn("_n", F.row_number().over(order)).where(F.col("_n") == k)
    # scores are rounded before they are ranked
    return kth.select(qkey, (F.col("s") - int(10.0 ** -decimals / UNIT) - 1).alias(name))


def term_bounds(post: DataFrame, keys) -> DataFrame:
    """(term, block, top): the largest contribution and a document that has it."""
    return post.groupBy("term", "block").agg(F.max(F.struct("w", *keys)).alias("top"))


def question_bounds(tops: DataFrame, keys, qterms: DataFrame, qkey: str, k: int, decimals: int) -> DataFrame:
    """(qkey, block, term, essential, rest, floor): whether the postings of a
    term are paired with the question for documents of the block, and the most
    that the terms that aren't add together, which is less than ``REST`` of the
    floor."""
    each = qterms.join(tops, "term")
    sums = each.groupBy(qkey, *[F.col(f"top.{c}").alias(c) for c in keys]).agg(F.sum("top.w").alias("s"))
    floors = kth_largest(sums, qkey, k, decimals, "floor")
    up_to = Window.partitionBy(qkey, "block").orderBy("top.w", "term").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    run = each.join(floors, qkey, "left").withColumn("_run", F.sum("top.w").over(up_to))
    small = F.coalesce(F.col("_run") < REST * F.col("floor"), F.lit(False))
    rest = F.max(F.when(small, F.col("_run"))).over(Window.partitionBy(qkey, "block"))
    return run.select(qkey, "block", "term", (~small).alias("essential"), F.coalesce(rest, F.lit(0)).alias("rest"),
                      F.coalesce("floor", F.lit(0)).alias("floor"))


def scored_pairs(post: DataFrame, bounds: DataFrame) -> DataFrame:
    """The (question, posting) pairs that the search looks at first."""
    return post.join(bounds.where("essential"), ["term", "block"])


def same_keys(keys) -> Column:
    """Equal keys on both sides of a join whose right side has them behind "_"."""
    equal = F.lit(True)
    for c in keys:
        equal = equal & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return equal


def paired_sums(post: DataFrame, keys, qterms: DataFrame, qkey: str, k: int, decimals: int) -> DataFrame:
    """(qkey, keys..., s): sums of contributions that hold each question's first
    ``k``, by pairs of questions and essential postings; for any number of questions."""
    # few rows beside the postings; written, so that the planner knows how few
    tops = materialize(term_bounds(post, keys))
    bounds = materialize(question_bounds(tops, keys, qterms, qkey, k, decimals))
    sums = materialize(scored_pairs(post, bounds).groupBy(qkey, "block", *keys).agg(
        F.sum("w").alias("s"), F.max("rest").alias("rest"), F.max("floor").alias("floor")))
    better = kth_largest(sums, qkey, k, decimals, "better")
    floor = F.greatest("floor", F.coalesce("better", F.lit(0)))
    able = materialize(sums.join(better, qkey, "left").where(F.col("s") + F.col("rest") >= floor).select(
        qkey, "block", *keys, "s"))
    others = bounds.where("not essential").select(qkey, "block", F.col("term").alias("_t"))
    wanted = materialize(able.join(others, [qkey, "block"]).select(
        qkey, "_t", *[F.col(c).alias(f"_{c}") for c in keys]))
    added = post.join(wanted, (F.col("term") == F.col("_t")) & same_keys(keys)).select(qkey, *keys, F.col("w").alias("s"))
    return able.select(qkey, *keys, "s").unionAll(added).groupBy(qkey, *keys).agg(F.sum("s").alias("s"))


#: questions whose terms are sent to all tasks
QUESTION_BLOCK = 4096
#: (question, document) sums, and contributions to them, that a task holds at a time
CELLS, PAIRS = 1 << 18, 1 << 20


def first_per_question(question: np.ndarray, rank_by: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest ``rank_by`` of each question, of equal ones the first."""
    order = np.lexsort((np.arange(len(question)), -rank_by, question))
    own = question[order]
    nth = np.arange(len(own)) - np.searchsorted(own, own)
    return np.sort(order[nth < k])


def block_sums(post: DataFrame, keys, asked: list, qkey: str, kind, k: int, decimals: int) -> DataFrame:
    """``paired_sums`` for the (question, term) rows of few questions, which are
    sent to all tasks. A document's postings meet in its row, bounded by the
    question terms it has; a task passes on k rows per question, never a row per pair."""
    names = sorted({q for q, _ in asked if q is not None}) + [None] * any(q is None for q, _ in asked)
    number = {q: i for i, q in enumerate(names)}
    by_term: dict[str, list[int]] = {}
    for q, term in asked:
        by_term.setdefault(term, []).append(number[q])
    ids = {term: i for i, term in enumerate(by_term)}
    n_asking = np.array([len(x) for x in by_term.values()] + [0])  # the last: terms no question has
    shared = post.sparkSession.sparkContext.broadcast(
        (names, ids, n_asking, np.cumsum(n_asking) - n_asking, np.array([q for x in by_term.values() for q in x], int)))
    # in the order of the keys, so that of equal scores the first to come is kept
    docs = post.groupBy(*keys).agg(F.collect_list(F.struct("term", "w")).alias("_p")).sortWithinPartitions(*keys)
    unit, scale = 40, 10 ** decimals

    def best(batches):
        names, ids, n_asking, starts, asking = shared.value
        least = np.zeros(len(names), np.int64)  # the k-th score so far
        held, q_held, s_held, r_held = None, *(np.zeros(0, np.int64) for _ in range(3))

        def rounded(s):  # as the scores are ranked, in whole units of the last decimal
            part = (s & ((1 << unit) - 1)).astype(object if decimals > 6 else np.int64)
            return ((s >> unit) * scale + ((part * scale + (1 << (unit - 1))) >> unit)).astype(np.int64)

        for batch in batches:
            if not batch.num_rows or not names:
                continue
            rows = batch.column(len(keys))
            term = rows.flatten().field(0).dictionary_encode()
            own = np.array([ids.get(t, -1) for t in term.dictionary.to_pylist()], int)[term.indices.to_numpy()]
            w = rows.flatten().field(1).to_numpy(zero_copy_only=False)
            ends = rows.offsets.to_numpy()[1:] - rows.offsets[0].as_py()
            pairs = np.cumsum(n_asking[own])[ends - 1]  # of each document and those before it
            doc = 0
            while doc < len(ends):
                before = pairs[doc - 1] if doc else 0
                to = min(int(np.searchsorted(pairs, before + PAIRS, "right")), doc + CELLS // len(names))
                to = max(to, doc + 1)
                of = slice(ends[doc - 1] if doc else 0, ends[to - 1])
                many = n_asking[own[of]]
                each = np.repeat(np.arange(len(many)), many)
                place = np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many) + starts[own[of]][each]
                lengths = np.diff(ends[doc:to], prepend=of.start)
                cell = np.repeat(np.arange(to - doc), lengths)[each] * len(names) + asking[place]
                size = (to - doc) * len(names)
                # in two parts, each of whose sums a double holds exactly
                high, low = (np.bincount(cell, x[each], size).astype(np.int64) for x in (w[of] >> 26, w[of] & ((1 << 26) - 1)))
                s = ((high << 26) + low).reshape(to - doc, len(names))
                r = rounded(s)
                d, q = np.nonzero((s > 0) & ((r > least) | (least == 0)))
                if len(d):
                    fresh = pa.Table.from_batches([batch.select(list(range(len(keys))))]).take(pa.array(d + doc))
                    held = pa.concat_tables([held, fresh]) if held else fresh
                    q_held, s_held, r_held = (np.concatenate(x) for x in (
                        (q_held, q), (s_held, s[d, q]), (r_held, r[d, q])))
                    keep = first_per_question(q_held, r_held, k)
                    held, q_held, s_held, r_held = held.take(pa.array(keep)), q_held[keep], s_held[keep], r_held[keep]
                    full = np.bincount(q_held, minlength=len(names)) >= k
                    lowest = np.full(len(names), np.iinfo(np.int64).max)
                    np.minimum.at(lowest, q_held, r_held)
                    least = np.where(full, lowest, 0)
                doc = to
        if held:
            questions = pa.array(names, to_arrow_type(kind)).take(pa.array(q_held))
            for part in pa.table([questions, *held.columns, pa.array(s_held)], names=[qkey, *keys, "s"]).to_batches():
                yield part

    schema = T.StructType([T.StructField(qkey, kind), *[post.schema[c] for c in keys], T.StructField("s", T.LongType())])
    return docs.mapInArrow(best, schema)


def rank_documents(post: DataFrame, keys, qterms: DataFrame, qkey: str, k: int, decimals: int = 6) -> DataFrame:
    """Top ``k`` documents per question over ``weighted_postings``: qkey, rank,
    keys..., score."""
    keys = list(keys)
    few = qterms.select(qkey).distinct().limit(QUESTION_BLOCK + 1).count() <= QUESTION_BLOCK
    if few:
        asked = [(r[0], r[1]) for r in qterms.select(qkey, "term").collect()]
        total = block_sums(post, keys, asked, qkey, qterms.schema[qkey].dataType, k, decimals)
    else:
        total = paired_sums(post, keys, qterms, qkey, k, decimals)
    scored = total.withColumn("score", F.round(F.col("s") * UNIT, decimals))
    w = Window.partitionBy(qkey).orderBy(F.desc("score"), *[F.asc(c) for c in keys])
    return (scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select(qkey, "rank", *keys, "score"))


def search(index: DataFrame, keys, questions: DataFrame, qkey: str, qtext: str, k: int = 5, k1: float = K.BM25_K1,
           b: float = K.BM25_B, decimals: int = 6) -> DataFrame:
    """Top ``k`` documents per question by BM25 over a ``search_index``, score
    rounded to ``decimals`` before ranking, ties broken by the keys, which name a
    document. Output: qkey, rank, keys..., score. An empty index gives no row."""
    keys = list(keys)
    qterms = question_terms(questions, qkey, qtext)
    # written, so that the planner knows how few they are and the index is not dealt out to meet them
    vocab = materialize(qterms.select("term").distinct().unionAll(qterms.sparkSession.sql("SELECT CAST(NULL AS STRING)")))
    # postings of question terms and the documents' own rows: what is written does not hold the corpus's other terms
    wanted = vocab.withColumnRenamed("term", "_v")
    found = materialize(index.join(wanted, F.col("term").eqNullSafe(F.col("_v")), "left_semi"))
    n_docs, total = found.where("term is null").agg(F.count(F.lit(1)), F.sum("doc_len")).first()
    post = weighted_postings(found.where("term is not null"), n_docs, total or 0, k1, b)
    return rank_documents(post, keys, qterms, qkey, k, decimals)


def bm25_search(corpus: DataFrame, keys, text_col: str, questions: DataFrame, qkey: str, qtext: str,
                k: int = 5, k1: float = K.BM25_K1, b: float = K.BM25_B, decimals: int = 6,
                corpora=None, corpus_col: str = "corpus") -> DataFrame:
    """``search`` over a corpus without a stored index. ``corpora`` restricts
    it to the named corpora (column ``corpus_col``), as a question asked of
    chosen stores."""
    keys = list(keys)
    source = restrict_to_corpora(corpus, corpora, corpus_col).select(*keys, text_col)
    index = search_index(spread(source, keys[0]), keys, text_col)
    return search(index, keys, questions, qkey, qtext, k, k1, b, decimals)


# --------------------------------------------------------------------------
# Cosine top-k
# --------------------------------------------------------------------------

def _as_double(vec: Column) -> Column:
    return F.transform(vec, lambda x: x.cast("double"))


def centroids(df: DataFrame, group: str, vec: str) -> DataFrame:
    """Mean vector per group (dimension-wise average)."""
    ex = df.select(group, F.posexplode(_as_double(F.col(vec))).alias("pos", "x"))
    per_dim = ex.groupBy(group, "pos").agg(F.avg("x").alias("x"))
    return per_dim.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias(vec))


QUERY_BLOCK = 4096


def cosine_search(vectors: DataFrame, key: str, vec: str, queries: DataFrame, qkey: str, qvec: str,
                  k: int = 5, decimals: int = 6, block: int = QUERY_BLOCK,
                  corpora=None, corpus_col: str = "corpus") -> DataFrame:
    """Top ``k`` vectors per query by cosine similarity (rounded, ties by key).

    The queries are taken in blocks of ``block`` vectors, each sent to all
    tasks, which multiply it with their vectors batch by batch and keep the
    best ``k`` per query: a task passes on k rows per query, never a row per
    pair. One query set of any size makes the same plan once per block. Keys
    must be integers.
    """
    source = restrict_to_corpora(vectors, corpora, corpus_col).select(
        F.col(key).cast("long").alias("key"), _as_double(F.col(vec)).alias("v"))
    spark = vectors.sparkSession
    q = queries.select(F.col(qkey).alias("qid"), _as_double(F.col(qvec)).alias("qv"))
    kind = q.schema["qid"].dataType
    best, held = [], []

    def add() -> None:
        if held:
            best.append(_block_top(source, spark, list(held), kind, k, decimals))
            held.clear()

    for row in q.toLocalIterator():
        held.append((row[0], row[1]))
        if len(held) == block:
            add()
    add()
    if not best:
        best = [_block_top(source, spark, [], kind, k, decimals)]
    w = Window.partitionBy("qid").orderBy(F.desc("score"), F.asc("key"))
    top = reduce(DataFrame.unionAll, best).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top.select(F.col("qid").alias(qkey), "rank", F.col("key").cast(vectors.schema[key].dataType).alias(key),
                      "score")


def _block_top(source: DataFrame, spark, block: list, kind, k: int, decimals: int) -> DataFrame:
    """(qid, key, score): per task the best ``k`` vectors of each query of a
    block."""
    matrix = np.array([v for _, v in block], float) if block else np.zeros((0, 1))
    norms = np.sqrt((matrix * matrix).sum(axis=1))
    shared = spark.sparkContext.broadcast(([q for q, _ in block], matrix / np.where(norms, norms, 1)[:, None]))

    def best(batches):
        ids, unit = shared.value
        keys = np.zeros((len(ids), 0), np.int64)
        scores = np.zeros((len(ids), 0))
        for batch in batches:
            if not batch.num_rows or not ids:
                continue
            own = batch.column(0).to_numpy(zero_copy_only=False)
            rows = batch.column(1)
            v = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
            size = np.sqrt((v * v).sum(axis=1))
            sims = np.round(unit @ (v / np.where(size, size, 1)[:, None]).T, decimals)
            scores = np.concatenate([scores, sims], axis=1)
            keys = np.concatenate([keys, np.broadcast_to(own, sims.shape)], axis=1)
            order = np.lexsort((keys, -scores), axis=1)[:, :k]
            scores, keys = np.take_along_axis(scores, order, 1), np.take_along_axis(keys, order, 1)
        if keys.size:
            names = pa.array(ids, to_arrow_type(kind)).take(pa.array(np.repeat(np.arange(len(ids)), keys.shape[1])))
            yield pa.RecordBatch.from_arrays([names, pa.array(keys.ravel()), pa.array(scores.ravel())],
                                             names=["qid", "key", "score"])

    return source.mapInArrow(best, f"qid {kind.simpleString()}, key long, score double")


def citations(hits: DataFrame, docs: DataFrame, keys, cols=("url", "title")) -> DataFrame:
    """Attach source fields (url, title) to ranked hits."""
    return hits.join(docs.select(*keys, *cols), list(keys))
