"""The corpus pipeline: quality filter, line dedup, near-duplicate removal,
benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept; its output is written as Parquet and read again for the next one. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesieve.llm import bpe, decontaminate, line_dedup, ngram_join, packing, quality
from pagesieve.llm.tables import materialize, read, small_batches

LEAST_QUALITY = 0.3

#: The stages are models, automata and tokenizers, which SQL can't express;
#: tests/llm compares them with brute-force versions.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    small_batches(spark)
    return quality.keep_good_documents(docs, read(spark, sf_dir, "labels"), LEAST_QUALITY)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; ``text`` and ``n_chars`` are those of the lines that
    stay. No document goes, even if no line of it stays."""
    small_batches(spark)
    cut = line_dedup.dedup_lines(docs, carry=docs.columns)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast(docs.schema["n_chars"].dataType)}
    return cut.select(*[new.get(c, F.col("carry")[c]).alias(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of smallest id stays."""
    small_batches(spark)
    return ngram_join.keep_one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go."""
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in the sequences."""
    small_batches(spark)
    return packing.pack_documents(docs, bpe.tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
