"""Data dictionary: declared columns and, when frames are given, measured facts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MEANINGS, TABLES
from ..session import checkpointed


def declared_dictionary(spark: SparkSession) -> DataFrame:
    """One row per column of the typed tables, by table name and column position."""
    rows = [
        (t.name, i, c.name, c.declared, "YES" if c.nullable else "NO", c.key, c.default, MEANINGS[t.name])
        for t in TABLES.values()
        for i, c in enumerate(t.columns, 1)
    ]
    schema = (
        "table_name string, position int, column_name string, column_type string, is_nullable string, "
        "column_key string, column_default string, business_meaning string"
    )
    return spark.createDataFrame(rows, schema).orderBy("table_name", "position")


def dictionary_export(spark: SparkSession) -> DataFrame:
    """The five columns of the exported CSV form."""
    return declared_dictionary(spark).select(
        F.col("table_name").alias("table"),
        F.col("column_name").alias("column"),
        F.col("column_type").alias("type"),
        F.col("is_nullable").alias("nullable"),
        F.col("column_key").alias("key"),
    )


# Fixed value: how names of raw tables start; the dictionary leaves them out.
RAW_PREFIX = "stg_"


def column_profile(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Type, rows, NULLs and exact distinct values of every column; one that is never NULL and never repeats is a key candidate."""
    profiles = []
    for name, df in frames.items():
        if name.startswith(RAW_PREFIX):
            continue
        places = range(len(df.columns))
        wide = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count(df.columns[i]).alias(f"_filled_{i}") for i in places],
            *[F.count_distinct(df.columns[i]).alias(f"_distinct_{i}") for i in places],
        )
        entries = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(i + 1).alias("position"),
                F.lit(df.columns[i]).alias("column_name"),
                F.lit(df.schema[i].dataType.simpleString()).alias("column_type"),
                F.col("_rows").alias("row_count"),
                (F.col("_rows") - F.col(f"_filled_{i}")).alias("null_count"),
                F.col(f"_distinct_{i}").alias("distinct_count"),
                (F.col(f"_distinct_{i}") == F.col("_rows")).alias("key_candidate"),
            )
            for i in places
        ]
        profiles.append(wide.select(F.inline(F.array(*entries))))
    return reduce(DataFrame.unionByName, profiles).orderBy("table_name", "position")


# Sketches of 2^12 registers: an estimate is off by more than three times this in 3 of 1,000 columns.
SKETCH_BITS = 12
RELATIVE_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def column_sketches(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, NULLs and a sketch of the distinct values of every column: table_name, position, column_name, column_type,
    row_count, null_count, sketch.

    One pass over each table, added up in every task; a row per task travels.
    Kept per load, these rows make the profile of all loads by `merged_sketches`."""
    profiles = []
    for name, df in frames.items():
        if name.startswith(RAW_PREFIX):
            continue
        kinds = [f.dataType for f in df.schema]

        def value(i: int, df: DataFrame = df, kinds: list = kinds) -> Column:
            plain = isinstance(kinds[i], (T.IntegerType, T.LongType, T.StringType, T.BinaryType))
            return F.col(df.columns[i]) if plain else F.col(df.columns[i]).cast("string")

        wide = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count(c).alias(f"_filled_{i}") for i, c in enumerate(df.columns)],
            *[F.hll_sketch_agg(value(i), F.lit(SKETCH_BITS)).alias(f"_sketch_{i}") for i in range(len(df.columns))],
        )
        entries = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(i + 1).alias("position"),
                F.lit(c).alias("column_name"),
                F.lit(kinds[i].simpleString()).alias("column_type"),
                F.col("_rows").alias("row_count"),
                (F.col("_rows") - F.col(f"_filled_{i}")).alias("null_count"),
                F.col(f"_sketch_{i}").alias("sketch"),
            )
            for i, c in enumerate(df.columns)
        ]
        profiles.append(wide.select(F.inline(F.array(*entries))))
    return reduce(DataFrame.unionByName, profiles)


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """The rows of several loads as those of all of them together."""
    return sketches.groupBy("table_name", "position", "column_name", "column_type").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.hll_union_agg("sketch").alias("sketch")
    )


def sketch_profile(frames: Mapping[str, DataFrame], sketches: DataFrame | None = None) -> DataFrame:
    """`column_profile` from sketches: distinct values are estimates, but exact for columns that may be keys.

    A column without NULLs whose estimate is within three errors of the rows is
    counted exactly, one column at a time; only such columns are shuffled.
    ``estimated`` tells the two apart; an estimate's relative error is RELATIVE_ERROR.
    """
    measured = checkpointed(merged_sketches(column_sketches(frames) if sketches is None else sketches))
    rows = F.col("row_count")
    estimate = F.least(F.hll_sketch_estimate("sketch"), rows - F.col("null_count"))
    near = (F.col("null_count") == 0) & (estimate >= rows * (1 - 3 * RELATIVE_ERROR))
    listed = measured.select("*", estimate.alias("estimate"), near.alias("near")).drop("sketch")
    # One row per column, of which the driver sees the names of possible keys.
    counts = [
        frames[r["table_name"]].select(r["column_name"]).distinct().agg(F.count(F.lit(1)).alias("exact")).select(
            F.lit(r["table_name"]).alias("table_name"), F.lit(r["column_name"]).alias("column_name"), "exact"
        )
        for r in listed.filter("near").select("table_name", "column_name").collect()
    ]
    none = measured.sparkSession.createDataFrame([], "table_name string, column_name string, exact bigint")
    exact = reduce(DataFrame.unionByName, counts, none)
    return listed.join(F.broadcast(exact), ["table_name", "column_name"], "left").select(
        "table_name", "position", "column_name", "column_type", "row_count", "null_count",
        F.coalesce("exact", "estimate").alias("distinct_count"),
        F.coalesce(F.col("exact") == rows, F.lit(False)).alias("key_candidate"),
        F.col("exact").isNull().alias("estimated"),
    ).orderBy("table_name", "position")


def data_dictionary(frames: Mapping[str, DataFrame]) -> DataFrame:
    """The declared dictionary of the typed tables with the measured counts.

    Tables and columns not in ``frames`` have no measured values.
    """
    spark = next(iter(frames.values())).sparkSession
    measured = column_profile(frames).select(
        "table_name", "column_name", "row_count", "null_count", "distinct_count", "key_candidate"
    )
    return (
        declared_dictionary(spark)
        .join(measured, ["table_name", "column_name"], "left")
        .orderBy("table_name", "position")
    )
