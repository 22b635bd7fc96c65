"""Key jobs: keep one row per identity, number rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from .gated import batch_folder, is_published, publish, published_batches, read_published


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one that comes last in ``order``.

    Rows with a NULL in the key equal nothing, so all of them stay. The rank
    filter is cut to one row per key and task before the shuffle, so a group
    of copies does not travel as a whole.
    """
    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    latest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    kept = (
        df.filter(~some_null)
        .withColumn("_rank", F.row_number().over(latest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )
    return kept.unionByName(df.filter(some_null))


def with_surrogate_key(
    df: DataFrame, name: str, order: Sequence[Column | str] = (), held: bool = False
) -> DataFrame:
    """Numbers the rows 1..n without a hole in the first column ``name``.

    With ``order`` the numbers follow that sort order, which should have no
    ties; without it they follow the partitions. The rows are checkpointed
    first, so the partitions numbered are the ones counted; ``held`` says that
    the frame already reads from a checkpoint or a written table without a
    shuffle behind it, which saves that copy. The number is the
    row's position in its partition plus the rows of all partitions before
    it; only one count per partition is broadcast.
    """
    fixed = df if held and not order else checkpointed(df.orderBy(*order) if order else df)
    position = F.monotonically_increasing_id()
    placed = fixed.withColumn("_partition", F.shiftright(position, 33)).withColumn(
        "_row", position.bitwiseAND(F.lit((1 << 33) - 1))
    )
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_partition")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_partition", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return placed.join(F.broadcast(offsets), "_partition").select(
        (F.col("_offset") + F.col("_row") + 1).alias(name), *df.columns
    )


def read_key_map(spark: SparkSession, root: str, name: str, value: str, key: str, kind: str = "string") -> DataFrame:
    """(key, value) of a map that `extend_key_map` keeps; empty before the first load."""
    if published_batches(spark, root).isEmpty():
        return spark.createDataFrame([], f"`{key}` bigint, `{value}` {kind}")
    return read_published(spark, root, name).select(key, value)


def extend_key_map(
    values: DataFrame, root: str, name: str, batch_id: str, value: str, key: str, same: Column | None = None
) -> DataFrame:
    """Numbers for the values of a load that no earlier one had; the whole map (key, value).

    Values keep the number they once got, over any number of loads: stored rows
    that hold it stay right. New ones follow the greatest number, in order of
    the value. ``same`` is an expression over ``value`` by which values count
    as one, spelled as first seen (in one load, the first in sort order); NULL
    gets no number. A load is published as a whole and only once: one that
    failed half-way is written anew, and a repeated ``batch_id`` adds nothing.
    One load at a time.
    """
    spark = values.sparkSession
    if not is_published(spark, root, batch_id):
        kind = values.schema[value].dataType.simpleString()
        known = read_key_map(spark, root, name, value, key, kind)
        mark = F.col(value) if same is None else same
        fresh = values.select(value).dropna().groupBy(mark.alias("_same")).agg(F.min(value).alias(value))
        fresh = fresh.join(known.select(mark.alias("_same")), "_same", "left_anti").select(value)
        # One number for the whole load; the stored keys are only read for it.
        greatest = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("n")).first()["n"]
        numbered = with_surrogate_key(fresh, key, [value]).withColumn(key, F.col(key) + F.lit(greatest).cast("bigint"))
        numbered.write.mode("overwrite").parquet(batch_folder(root, name, batch_id))
        publish(spark, root, batch_id)
    return read_key_map(spark, root, name, value, key)
