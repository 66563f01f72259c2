"""Document fingerprints by a randomised edit embedding.

All texts share one random walk: at step j the walk stands on a character and
stays or moves on by a random bit drawn for (j, that character). Reading the
character at every step embeds the text so that a small edit distance gives a
small Hamming distance: after an edit the walks of both texts meet again and
read the same characters at the same steps.

The fingerprint keeps a sample of the steps. Steps are sampled by octave
([2^k, 2^(k+1))): ``SAMPLES`` in the octave where the walk ends, half as many
in the one before and so on, nested, so texts of any lengths share samples. A
sample is six bits of a hash of the ``GRAM`` characters at the walk's place, or
``-`` beyond the text's end.

``likeness`` estimates the share of steps at which two walks read the same,
``walk_likeness`` counts it over the whole texts. ``similar_documents`` bands
sampled bits, and verifies the pairs that share a band on their texts, or by
their likeness where it is given none.

The walks of many texts step together in vector operations; texts of similar
length are walked in one group, whose size in characters is bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesieve.llm import arrowtext as A
from pagesieve.llm.components import connected_components
from pagesieve.llm.tables import id_text, materialize

SAMPLES = 64
GRAM = 4
FIRST_OCTAVE = 4  # steps before 2^FIRST_OCTAVE are one octave
OCTAVES = 32
PERIOD = 1 << 12  # the walk's random bits repeat after so many steps
GROUP_CHARS = 1 << 21
CHECK_EVERY = 256
ALPHABET = np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/-", np.uint8)
ENDED = 64

_rng = np.random.default_rng(2)
MOVES = _rng.integers(0, 2, (PERIOD, 256), dtype=np.uint8)
MOVES[:, 0] = 0  # class 0 stands behind a text: the walk stays


def octave_bounds(k: int) -> tuple[int, int]:
    return (0 if k == FIRST_OCTAVE - 1 else 1 << k), 1 << (k + 1)


def sampled_steps(k: int) -> np.ndarray:
    """The sampled steps of octave ``k`` in order of importance."""
    low, high = octave_bounds(k)
    rng = np.random.default_rng([7, k])
    if high - low <= SAMPLES:
        return low + rng.permutation(high - low)
    picked = np.unique(rng.integers(low, high, 4 * SAMPLES))
    return rng.permutation(picked)[:SAMPLES]


STEPS = {k: sampled_steps(k) for k in range(FIRST_OCTAVE - 1, OCTAVES)}
_ORDER = sorted((int(step), k, at) for k, steps in STEPS.items() for at, step in enumerate(steps))


def samples_kept(k: int, last: int) -> int:
    """Samples of octave ``k`` in a fingerprint whose walk ends in ``last``."""
    return min(len(STEPS[k]), SAMPLES >> (last - k))


def character_classes(points: np.ndarray) -> np.ndarray:
    """Code points to 1..255."""
    mixed = A.mix64(points.astype(np.uint64) + np.uint64(11))
    return (mixed % np.uint64(255) + np.uint64(1)).astype(np.uint8)


def walk(texts: list[np.ndarray]) -> list[str]:
    """Fingerprints of texts given as arrays of character classes."""
    n = len(texts)
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + GRAM)])[:-1]
    flat = np.zeros(int(lengths.sum()) + GRAM * n + GRAM, np.uint8)
    for start, text in zip(starts, texts, strict=True):
        flat[start:start + len(text)] = text
    place, active = starts.copy(), np.flatnonzero(lengths > 0)
    place = place[active]
    read: dict[int, np.ndarray] = {}  # octave -> samples of all texts
    ends = np.zeros(n, np.int64)  # an upper bound of the step at which a walk ends
    here = np.empty(len(active), np.uint8)
    move = np.empty(len(active), np.uint8)
    due, step = 0, 0
    while len(active):
        while due < len(_ORDER) and _ORDER[due][0] == step:
            _, k, at = _ORDER[due]
            if k not in read:
                read[k] = np.full((n, len(STEPS[k])), ENDED, np.uint8)
            gram = np.zeros(len(active), np.uint64)
            for g in range(GRAM):
                gram = gram << np.uint64(8) | flat[place + g]
            symbol = (A.mix64(gram) & np.uint64(63)).astype(np.uint8)
            symbol[flat[place] == 0] = ENDED
            read[k][active, at] = symbol
            due += 1
        np.take(flat, place, out=here)
        np.take(MOVES[step % PERIOD], here, out=move)
        np.add(place, move, out=place)
        step += 1
        if step % CHECK_EVERY == 0 or step & (step - 1) == 0:
            done = flat[place] == 0
            if done.any():
                ends[active[done]] = step
                place, active = place[~done], active[~done]
                here, move = np.empty(len(active), np.uint8), np.empty(len(active), np.uint8)
    return [encode(read, row, int(ends[row])) for row in range(n)]


def encode(read: dict[int, np.ndarray], row: int, end: int) -> str:
    """``octave:samples``, later octaves first; empty texts ``0:``."""
    last = max((k for k in read if (read[k][row] != ENDED).any()), default=None)
    if last is None:
        return "0:"
    parts = [read[k][row, :samples_kept(k, last)] for k in range(last, FIRST_OCTAVE - 2, -1) if samples_kept(k, last)]
    return f"{last}:" + ALPHABET[np.concatenate(parts)].tobytes().decode()


def decode(fingerprint: str) -> dict[int, np.ndarray]:
    head, _, body = fingerprint.partition(":")
    out, at, codes = {}, 0, np.frombuffer(body.encode(), np.uint8)
    last = int(head)
    for k in range(last, FIRST_OCTAVE - 2, -1):
        kept = samples_kept(k, last)
        if not kept or at >= len(codes):
            break
        out[k] = codes[at:at + kept]
        at += kept
    return out


def likeness(a: str, b: str) -> float:
    """Estimated share of the steps (of the longer walk) at which both walks
    read the same; two empty texts are alike."""
    if a == b:
        return 1.0
    one, two = decode(a), decode(b)
    same, either = 0.0, 0.0
    ended = ord("-")
    for k in set(one) | set(two):
        x, y = one.get(k), two.get(k)
        low, high = octave_bounds(k)
        if x is None or y is None:
            # one walk has no samples here: it ended, or the octave is too early to matter
            other, missing = (y, one) if x is None else (x, two)
            if not missing or k > max(missing):
                either += (high - low) * float((other != ended).mean())
            continue
        count = min(len(x), len(y))
        x, y = x[:count], y[:count]
        there = (x != ended) | (y != ended)
        same += (high - low) * float(((x == y) & there).mean())
        either += (high - low) * float(there.mean())
    if either <= 0:
        return 0.0
    share = same / either
    return float(min(1.0, max(0.0, (share - 1 / 64) * 64 / 63)))  # without chance hits of six bits


def fingerprints(texts: list[str]) -> list[str]:
    """Fingerprints of whole texts; equal texts are walked once."""
    classes, keys = [], []
    place: dict[str, int] = {}
    for text in texts:
        if text not in place:
            place[text] = len(classes)
            classes.append(character_classes(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)))
        keys.append(place[text])
    out = [""] * len(classes)
    order = sorted(range(len(classes)), key=lambda i: len(classes[i]))
    group, size = [], 0
    for i in [*order, -1]:
        if i < 0 or (group and size + len(classes[i]) > GROUP_CHARS):
            for j, found in zip(group, walk([classes[j] for j in group]), strict=True):
                out[j] = found
            group, size = [], 0
        if i >= 0:
            group.append(i)
            size += len(classes[i])
    return [out[k] for k in keys]


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars (code points), fingerprint; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in A.column(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [A.column(batch, "doc_id"), pa.array([len(x) for x in texts], pa.int64()),
                 pa.array(fingerprints(texts), pa.string())], names=["doc_id", "n_chars", "fingerprint"])

    base = id_text(docs, id_col, text_col)
    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(run, f"doc_id {kind}, n_chars long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the
    following text, or all of them."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


ROWS_PER_BUCKET = 5_000
MAX_RANGES = 65_536  # a task's range grows beyond that, not the list of ranges
ROWS_PER_STEP = 10_000


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Each document's fingerprint, that of its edited text (see ``edited``;
    the following document is the one with the next smaller id, after the
    smallest the largest), and the likeness of its fingerprint to the edited
    text's and to the following document's.

    Ids are cut into ranges of about ``rows_per_bucket`` rows, ``MAX_RANGES`` at
    most; a row's range is found by a binary search among the cuts. A range also
    gets a copy of the row before its first, so neighbours meet in one shuffle
    of the texts. Null ids count as smaller than all others; equal ids are
    ordered by text. A single document follows itself.
    """
    base = id_text(docs, id_col, text_col).select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    ids = base.select("doc_id")
    total = ids.count()
    n_cuts = min(total // rows_per_bucket, MAX_RANGES - 1)
    cuts = ids.agg(F.percentile_approx("doc_id", [(i + 1) / (n_cuts + 1) for i in range(n_cuts)], 100_000)
                   ).first()[0] if n_cuts else []
    cuts = np.array(sorted(set(cuts or [])), np.int64)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(np.int64)))

    found = range_of(F.coalesce("doc_id", F.lit(0))) if len(cuts) else F.lit(0)
    bucket = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(found)
    tops = {r["b"]: r["top"] for r in ids.groupBy(bucket.alias("b")).agg(F.max("doc_id").alias("top")).collect()}
    order = sorted(tops)  # a number per range
    # the largest row of each range also opens the next range, that of the last opens the first
    follows = [(tops[b], order[(i + 1) % len(order)]) for i, b in enumerate(order)]
    spark = docs.sparkSession
    borders = spark.createDataFrame(follows, "top long, b int")
    carried = base.join(F.broadcast(borders), base["doc_id"].eqNullSafe(borders["top"])).select("b", "doc_id", "text")
    last = carried.groupBy("b", "doc_id").agg(F.max("text").alias("text"))
    rows = base.select(bucket.alias("b"), F.lit(1).alias("own"), "doc_id", "text").unionByName(
        last.select("b", F.lit(0).alias("own"), "doc_id", "text"))
    rows = rows.repartition(max(1, len(order)), "b").sortWithinPartitions(
        "b", "own", F.col("doc_id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple[int, str, str] | None = None  # range, text, fingerprint
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS_PER_STEP):
                part = batch.slice(low, ROWS_PER_STEP)
                buckets = A.column(part, "b").to_pylist()
                own = A.column(part, "own").to_pylist()
                texts = A.column(part, "text").to_pylist()
                follow = []
                for i, (b, mine) in enumerate(zip(buckets, own, strict=True)):
                    at = (buckets[i - 1], texts[i - 1]) if i else before and before[:2]
                    assert not mine or (at and at[0] == b), "a range starts with a copied row"
                    follow.append(at[1] if mine else "")
                changed = [edited(t, f) if mine else "" for t, f, mine in zip(texts, follow, own, strict=True)]
                found = fingerprints(texts + changed)
                marks, marks_changed = found[:len(texts)], found[len(texts):]
                ids, out = A.column(part, "doc_id"), {k: [] for k in range(6)}
                keep = [i for i, mine in enumerate(own) if mine]
                for i in keep:
                    following = marks[i - 1] if i else before[2]
                    row = (len(texts[i]), hashlib.sha256(changed[i].encode()).hexdigest(), marks[i], marks_changed[i],
                           likeness(marks[i], marks_changed[i]), likeness(marks[i], following))
                    for k, value in enumerate(row):
                        out[k].append(value)
                if texts:
                    before = buckets[-1], texts[-1], marks[-1]
                kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(keep, pa.int64())), *(pa.array(out[k], kinds[k]) for k in range(6))],
                    names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                           "near_next"])

    return rows.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                "edited_fingerprint string, near_edited double, near_next double")


def bands(fingerprint: str, n_bands: int = 16, per_band: int = 4) -> list[str]:
    """Band keys: groups of samples of the walk's last two octaves."""
    marks = decode(fingerprint)
    if not marks:
        return []
    last = max(marks)
    keys = []
    for k in (last, last - 1):
        body = marks.get(k, np.zeros(0, np.uint8))
        for i in range(0, min(len(body), n_bands * per_band) - per_band + 1, per_band):
            part = body[i:i + per_band]
            if (part != ord("-")).any():
                keys.append(f"{k}:{i}:{part.tobytes().decode()}")
    return keys


def walk_likeness(pairs: list[tuple[str, str]]) -> list[float]:
    """The share of the steps (of the longer walk) at which the walks over both
    texts of a pair read the same ``GRAM`` characters."""
    out = [1.0] * len(pairs)
    order = sorted((i for i, (x, y) in enumerate(pairs) if x != y), key=lambda i: max(map(len, pairs[i])))
    group, size = [], 0
    for i in [*order, -1]:
        more = sum(map(len, pairs[i])) if i >= 0 else 0
        if group and (i < 0 or size + more > GROUP_CHARS):
            for j, share in zip(group, walk_pairs([pairs[j] for j in group]), strict=True):
                out[j] = share
            group, size = [], 0
        group.append(i)
        size += more
    return out


def walk_pairs(pairs: list[tuple[str, str]]) -> list[float]:
    texts = [character_classes(np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32))
             for pair in pairs for x in pair]
    starts = np.concatenate([[0], np.cumsum([len(t) + GRAM for t in texts])])
    flat = np.zeros(int(starts[-1]) + GRAM, np.uint8)
    for start, text in zip(starts, texts, strict=False):
        flat[start:start + len(text)] = text
    grams = np.zeros(len(flat), np.uint32)
    for g in range(GRAM):
        grams = grams << np.uint32(8) | np.concatenate([flat[g:], np.zeros(g, np.uint8)])
    one, two = starts[:-1:2].copy(), starts[1:-1:2].copy()
    active = np.arange(len(pairs))
    same, either = np.zeros(len(pairs)), np.zeros(len(pairs))
    step = 0
    while len(active):
        x, y = flat[one], flat[two]
        there = (x != 0) | (y != 0)
        either[active] += there
        same[active] += there & (grams[one] == grams[two])
        moves = MOVES[step % PERIOD]
        one, two = one + moves[x], two + moves[y]
        step += 1
        if step % CHECK_EVERY == 0 or not there.any():
            active, one, two = active[there], one[there], two[there]
    return (same / np.maximum(either, 1)).tolist()


PAIR_BLOCK = 256


def similar_documents(marked: DataFrame, threshold: float = 0.75, texts: DataFrame | None = None,
                      block: int = PAIR_BLOCK) -> DataFrame:
    """Pairs (doc_id, other_id, likeness) of documents whose fingerprints share
    a band and are at least ``threshold`` alike: any two such documents are
    linked, directly or over others. ``texts`` (doc_id, text) verifies on the
    whole texts; without it the likeness of the fingerprints decides.

    Equal texts (without ``texts``, equal fingerprints) meet once: pairs link
    class representatives (the smallest id of a class), and the members of a
    class (themselves excepted) are linked to theirs with likeness 1. In a band
    each class is first compared with the band's smallest id. Those of a band
    that are not connected then are compared with each other, in salted blocks
    of about ``block`` classes, every pair of blocks by itself."""
    rows = marked.select("doc_id", "fingerprint")
    same = "fingerprint"
    if texts is not None:
        rows = rows.join(texts.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id").withColumn(
            "same", F.sha2("text", 256))
        same = "same"
    classes = rows.groupBy(same).agg(F.min("doc_id").alias("doc_id"), F.min("fingerprint").alias("_f"))
    classes = materialize(classes.select("doc_id", same, F.col("_f").alias("_mark")))
    copies = rows.select("doc_id", same).join(
        classes.select(same, F.col("doc_id").alias("other_id")), same).where(F.col("doc_id") != F.col("other_id"))
    keys = F.udf(bands, "array<string>")
    banded = materialize(classes.select("doc_id", F.explode(keys("_mark")).alias("band")))
    if texts is None:
        bodies, alike = classes.select("doc_id", F.col("_mark").alias("_body")), F.udf(likeness, "double")
    else:
        bodies = rows.join(classes.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(
            F.min("text").alias("_body"))
        alike = F.pandas_udf(_walk_likeness_of, "double")

    def verified(pairs: DataFrame) -> DataFrame:
        one = bodies.select("doc_id", F.col("_body").alias("_a"))
        two = bodies.select(F.col("doc_id").alias("other_id"), F.col("_body").alias("_b"))
        return materialize(pairs.join(one, "doc_id").join(two, "other_id").select(
            "doc_id", "other_id", alike("_a", "_b").alias("likeness")).where(F.col("likeness") >= threshold))

    heads = banded.groupBy("band").agg(F.min("doc_id").alias("other_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    led = verified(banded.join(heads, "band").where(
        F.col("doc_id") != F.col("other_id")).select("doc_id", "other_id").distinct())
    comps = connected_components(led.select(F.col("doc_id").alias("u"), F.col("other_id").alias("v")))
    open_rows = banded.join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "band", "doc_id", F.coalesce("component", "doc_id").alias("comp"))
    mixed = open_rows.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                          F.count(F.lit(1)).alias("n")).where("n > 2 and lo != hi")
    open_rows = materialize(open_rows.join(mixed.select("band", F.ceil(F.col("n") / block).cast("int").alias("parts")),
                                           "band").withColumn("part", F.pmod(F.xxhash64("doc_id"), "parts").cast("int")))
    left = open_rows.select("band", F.col("part").alias("i"), F.explode(F.sequence("part", F.col("parts") - 1)).alias("j"),
                            "doc_id", "comp")
    right = open_rows.select("band", F.explode(F.sequence(F.lit(0), "part")).alias("i"), F.col("part").alias("j"),
                             F.col("doc_id").alias("other_id"), F.col("comp").alias("other_comp"))
    rest = left.join(right, ["band", "i", "j"]).where(
        "comp != other_comp and (i != j or doc_id > other_id)").select(
        F.greatest("doc_id", "other_id").alias("doc_id"), F.least("doc_id", "other_id").alias("other_id")).distinct()
    return led.unionByName(verified(rest)).unionByName(
        copies.select("doc_id", "other_id", F.lit(1.0).alias("likeness")))


def _walk_likeness_of(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(walk_likeness(list(zip(a, b, strict=True))))
