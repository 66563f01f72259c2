"""Registered queries of the operators in this subpackage, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesieve.llm import (
    bpe,
    decontaminate,
    fill_in_middle,
    fingerprint,
    hard_negatives,
    language,
    line_dedup,
    main_text,
    ngram_join,
    packing,
    quality,
    records,
    simhash,
    suffix_dedup,
)
from pagesieve.llm.tables import read

QueryFn = Callable[[SparkSession, str], DataFrame]


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3),
                                    lambda i: array_to_string(w[i:i + 4], ' '))
                                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
alike AS (SELECT s, min(doc_id) AS rep FROM (SELECT doc_id, list_sort(s) AS s FROM sets) GROUP BY s),
of_rep AS (SELECT doc_id, rep FROM (SELECT doc_id, list_sort(s) AS s FROM sets) JOIN alike USING (s)),
tokens AS (SELECT rep, unnest(s) AS t FROM alike),
common AS (
  SELECT a.rep AS u, b.rep AS v, count(*) AS shared FROM tokens a JOIN tokens b ON a.t = b.t AND a.rep < b.rep GROUP BY 1, 2),
links AS (
  SELECT u, v FROM common c JOIN sizes x ON x.doc_id = c.u JOIN sizes y ON y.doc_id = c.v
  WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
edges AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (SELECT rep AS node, rep AS least FROM alike UNION
          SELECT e.v, r.least FROM reach r JOIN edges e ON e.u = r.node WHERE r.least < e.v),
comp AS (SELECT node, min(least) AS component_id FROM reach GROUP BY 1)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, CASE WHEN s.n = 0 THEN s.doc_id ELSE c.component_id END AS component_id
FROM sizes s JOIN of_rep o ON o.doc_id = s.doc_id JOIN comp c ON c.node = o.rep"""


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(read(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.neighbour_fingerprints(read(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
cuts AS (SELECT doc_id, h, n, unnest(range(0, n, 100)) AS c FROM d),
pieces AS (SELECT doc_id, n, c, substr(h, 2 * c + 1, 398) AS piece FROM cuts),
pos AS (SELECT doc_id, n, c, piece, unnest(range(least(100, n - c))) AS i FROM pieces),
bytes AS (
  SELECT doc_id, c + i AS p, substr(piece, 2 * i + 1, 2) AS b,
         CASE WHEN c + i + 100 <= n THEN substr(piece, 2 * i + 1, 200) END AS s
  FROM pos),
first AS (SELECT s, min((doc_id, p)) AS f FROM bytes WHERE s IS NOT NULL GROUP BY s HAVING count(*) > 1),
marked AS (
  SELECT b.doc_id, b.p, b.b, max(CASE WHEN f.f <> (b.doc_id, b.p) THEN 1 ELSE 0 END)
           OVER (PARTITION BY b.doc_id ORDER BY b.p ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS cut
  FROM bytes b LEFT JOIN first f ON f.s = b.s),
runs AS (SELECT *, cut = 1 AND coalesce(lag(cut) OVER (PARTITION BY doc_id ORDER BY p), 0) = 0 AS opens FROM marked)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(sum(cut), 0) AS BIGINT) AS n_removed,
       CAST(count_if(opens) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(string_agg(b, '' ORDER BY p) FILTER (WHERE cut = 0), ''))) AS kept_sha256
FROM d LEFT JOIN runs r ON r.doc_id = d.doc_id GROUP BY d.doc_id, d.n"""


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.dedup_substrings(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_main_text(read(spark, sf_dir, "pages"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_documents(read(spark, sf_dir, "documents"))


def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = records.write_records(read(spark, sf_dir, "documents"), bpe.tokenizer_path("byte_bpe_50k.json"))
    return records.read_records(manifest)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), bpe.tokenizer_path("word_bpe_49k.json"))


OP9_SQL = r"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, size, g FROM (
    SELECT item_id, least(len(w), 13) AS size, unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2),
             lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' '))) AS g
    FROM items WHERE len(w) > 0)),
wanted AS (SELECT DISTINCT size, g FROM windows),
grams AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS p,
         unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS g
  FROM lowered, (SELECT DISTINCT size FROM wanted)),
hits AS (SELECT doc_id, p, size, g FROM grams JOIN wanted USING (size, g)),
hit_words AS (SELECT DISTINCT doc_id, unnest(range(p, p + size)) AS k FROM hits),
n_hits AS (SELECT doc_id, count(*) AS n_hit FROM hit_words GROUP BY 1),
found AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits JOIN windows USING (size, g)),
per_doc AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names FROM found GROUP BY 1)
SELECT l.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM lowered l LEFT JOIN n_hits USING (doc_id) LEFT JOIN per_doc USING (doc_id)"""


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


OP10_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT k.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE c.key IS NOT NULL AND c.keeper <> k.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos)
                       FILTER (WHERE c.key IS NULL OR c.keeper = k.doc_id), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c ON c.key = k.key
GROUP BY k.doc_id"""


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l FROM documents),
c AS (
  SELECT *, len(l) AS n, ('0x' || h[1:8])::BIGINT % (len(l) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(l) + 1) AS y,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT *, array_to_string(l[1:least(x, y)], '') AS prefix,
         array_to_string(l[least(x, y) + 1:greatest(x, y)], '') AS middle,
         array_to_string(l[greatest(x, y) + 1:], '') AS suffix
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p"""


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = fill_in_middle.fill_in_middle(read(spark, sf_dir, "documents"))
    restored = fill_in_middle.restore_text(outputs)
    return restored.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                           F.sha2("output", 256).alias("output_sha256"),
                           F.sha2("restored", 256).alias("restored_sha256"))


OP13_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, x.vec_id, x.label = a.label AS same,
         CAST(list_dot_product(a.v, x.v) AS BIGINT) AS score
  FROM rows a JOIN rows x ON x.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER)
         AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(read(spark, sf_dir, "embeddings").withColumn("label", label))


QUERIES: dict[str, QueryFn] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_fingerprints": op2_fingerprints,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_main_text": op4_main_text,
    "op5_quality": op5_quality,
    "op6_language": op6_language,
    "op7_token_records": op7_token_records,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_decontaminate": op9_decontaminate,
    "op10_line_dedup": op10_line_dedup,
    "op11_simhash": op11_simhash,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLES: dict[str, str] = {
    "op1_ngram_join": OP1_SQL,
    "op3_suffix_dedup": OP3_SQL,
    "op9_decontaminate": OP9_SQL,
    "op10_line_dedup": OP10_SQL,
    "op12_fill_in_middle": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
