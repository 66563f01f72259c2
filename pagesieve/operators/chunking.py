"""Split documents into overlapping paragraph chunks.

Each document is folded inside its own row (no shuffle); ``posexplode``
turns the chunk array into rows. Rows are hash-spread on the key first when
the scan yields too few partitions, because the fold is CPU bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesieve import constants as K
from pagesieve.functions.chunk import chunk_text
from pagesieve.sources.tables import spread


def chunk_documents(df: DataFrame, key: str = "doc_id", text_col: str = "text",
                    max_tokens: int = K.DEFAULT_CHUNK_MAX_TOKENS, overlap: int = K.DEFAULT_CHUNK_OVERLAP,
                    sep: str = "\n\n", keep=()) -> DataFrame:
    """(key, *keep, chunk_no, chunk, chunk_tokens)."""
    base = spread(df.select(key, text_col, *keep), key)
    chunks = base.select(key, *keep, F.posexplode(chunk_text(F.col(text_col), max_tokens, overlap, sep))
                         .alias("chunk_no", "chunk"))
    return chunks.withColumn("chunk_tokens", F.floor(F.length("chunk") / K.CHARS_PER_TOKEN).cast("long"))


def chunk_stats(chunks: DataFrame, by: str = "source", key: str = "doc_id") -> DataFrame:
    """Per group: documents, chunks, documents split in several chunks, and
    the largest chunk in tokens (two-level aggregate, partial at each level)."""
    per_doc = chunks.groupBy(by, key).agg(F.count(F.lit(1)).alias("n"), F.max("chunk_tokens").alias("mx"))
    return per_doc.groupBy(by).agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n").alias("chunks"),
        F.count_if(F.col("n") > 1).alias("multi_chunk_documents"), F.max("mx").alias("max_chunk_tokens"))
