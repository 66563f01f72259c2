"""Skew-safe position of a row within its group (a distributed row_number).

``row_number() over (partition by g order by k)`` sends a whole group to one
task; if one group holds a third of all rows, that task holds a third of the
data. Here the order key is cut at quantiles of the whole table into ranges of
about equal size, whatever the values (dense, sparse or hashed ids):

  * the window runs per (group, range), so no window partition holds more than
    about one range, however hot the group;
  * a combinable count per (group, range) plus a running sum over that small
    table (at most ``ranges`` rows a group) gives each range's offset;
  * position = offset of the range + row number inside the range.

Rows with a null order key come last. Equal keys are ordered by a hash of the
row, so every row has a position of its own and none is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_RANGES = 256


def order_cuts(df: DataFrame, order: str, ranges: int) -> list[int]:
    """Up to ``ranges`` - 1 distinct cut points of the order key."""
    shares = [i / ranges for i in range(1, ranges)]
    found = df.agg(F.percentile_approx(order, shares, 100 * ranges)).first()[0] if shares else []
    return sorted(set(found or []))


def position_within(df: DataFrame, group: str, order: str, out: str = "position",
                    ranges: int = DEFAULT_RANGES) -> DataFrame:
    """Add ``out`` = 0-based rank of ``order`` within ``group``. ``order``
    must be an integral column."""
    dtype = df.schema[order].dataType
    if not isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        raise TypeError(f"position_within needs an integral order column, got {dtype}")
    cuts = order_cuts(df, order, ranges)
    k = F.col(order).cast("long")
    literal = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    part = F.when(k.isNull(), F.lit(len(cuts) + 1)).otherwise(F.size(F.filter(literal, lambda c: c < k)))
    keyed = df.withColumn("_b", part)
    counts = keyed.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(group).alias("_g"), F.col("_b").alias("_ob"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(group, "_b").orderBy(F.col(order).asc_nulls_last(), F.xxhash64(*df.columns))
    ranked = keyed.withColumn("_r", F.row_number().over(inside) - 1)
    joined = ranked.join(offsets, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_b") == F.col("_ob")))
    return joined.select(*df.columns, (F.col("_off") + F.col("_r")).cast("long").alias(out))
