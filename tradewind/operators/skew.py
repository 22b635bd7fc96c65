"""Windows over keys of any size.

Rows are range-partitioned by (key, order), so that a partition holds a run of
the order and a key with very many rows spans several partitions. The
partitions are fixed by a reliable checkpoint, and every window works on a key
within a partition. What a key hands over a border, its last value or its sum,
is one row per partition that the key spans; at most one key spans a border.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed


def in_ranges(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``_part``, the number of its range of (key, order)."""
    return checkpointed(df.repartitionByRange(key, *order).withColumn("_part", F.spark_partition_id()))


def _across_borders(ranges: DataFrame, key: str) -> DataFrame:
    """Rows of the keys that lie in several ranges: the least or greatest key of each."""
    wrapped = F.struct(F.col(key).alias("_key"))
    edges = ranges.groupBy("_part").agg(F.min(wrapped).alias("first"), F.max(wrapped).alias("last"))
    edges = edges.select("_part", F.explode(F.array("first", "last")).alias("edge")).select("_part", "edge._key")
    spanning = edges.groupBy("_key").agg(F.countDistinct("_part").alias("n")).filter("n > 1").select("_key")
    return ranges.join(spanning, F.col(key).eqNullSafe(F.col("_key")), "left_semi")


def _carried(rows: DataFrame, carry: DataFrame, key: str) -> DataFrame:
    renamed = carry.withColumnsRenamed({key: "_carry_key", "_part": "_carry_part"})
    same = F.col(key).eqNullSafe(F.col("_carry_key")) & (F.col("_part") == F.col("_carry_part"))
    return rows.join(renamed, same, "left").drop("_carry_key", "_carry_part", "_part")


def previous_value(df: DataFrame, key: str, order: Sequence[str], value: str, into: str) -> DataFrame:
    """LAG of ``value`` per key; ``value`` is the first ordering column and not NULL."""
    if order[0] != value:
        raise ValueError("value must be the first ordering column")
    ranges = in_ranges(df, key, order)
    inside = ranges.withColumn(into, F.lag(value).over(Window.partitionBy(key, "_part").orderBy(*order)))
    ends = _across_borders(ranges, key).groupBy(key, "_part").agg(F.max(value).alias("_end"))
    before = Window.partitionBy(key).orderBy("_part")
    carry = ends.select(key, "_part", F.lag("_end").over(before).alias("_carry"))
    return _carried(inside, carry, key).withColumn(into, F.coalesce(into, "_carry")).drop("_carry")


def running_total(df: DataFrame, key: str, order: Sequence[str], value: str, into: str) -> DataFrame:
    """Sum of ``value`` per key up to and with the current row.

    ``order`` must be total on the rows whose ``value`` is not 0.
    """
    ranges = in_ranges(df, key, order)
    frame = Window.partitionBy(key, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = ranges.withColumn(into, F.sum(value).over(frame))
    sums = _across_borders(ranges, key).groupBy(key, "_part").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(key, "_part", F.sum("_sum").over(earlier).alias("_carry"))
    total = F.col(into) + F.coalesce("_carry", F.lit(0))
    return _carried(inside, carry, key).withColumn(into, total).drop("_carry")
