"""Connected components of an edge table by alternating star contractions.

A large-star step links every larger neighbour of a node to the smallest
neighbour, a small-star step every smaller-or-equal neighbour; alternated, the
edges shrink to one star per component around its smallest node, in a number
of rounds that grows with the logarithm of the component size. Each step is an
aggregate that combines before the shuffle (smallest neighbour) and a join, so
a node with very many neighbours is never gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesieve.llm.tables import materialize

MAX_ROUNDS = 50


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(
        "u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v")
    smallest = down.groupBy("u").agg(F.min("v").alias("m"))
    rest = down.join(smallest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of edges (u, v) but the smallest of each
    component, which is its ``component``."""
    edges = edges.select("u", "v").where("u != v")
    for _ in range(MAX_ROUNDS):
        edges = materialize(_small_star(_large_star(edges)))
        if _is_stars(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    raise RuntimeError("the components did not settle")


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node, or only edges from
    larger ones."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(
        edges.select("v", F.lit(0), F.lit(1)))
    degrees = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return degrees.where("down > 1 or (down = 1 and up = 1)").isEmpty()
