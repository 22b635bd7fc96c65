"""Reading and writing typed tables, CSV exports and clustered layouts."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

# The column orders the source database indexes for its three
# slowest queries.
LAYOUTS = {
    "items_product_price": ("product_id", "price"),
    "items_order_product": ("order_id", "product_id"),
    "orders_customer_purchase": ("customer_id", "order_purchase_timestamp"),
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def write_table(df: DataFrame, folder: str, name: str, mode: str = "append") -> None:
    df.write.mode(mode).parquet(f"{folder}/{name}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to a new folder in the place all executors share, and read back: its size is known."""
    path = f"{shared_dir(df.sparkSession)}/tradewind/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headered CSV with doubled quotes and unchanged blanks, the form `read_staging` reads."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("lineSep", "\n")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def row_counts(frames: Mapping[str, DataFrame], count_name: str = "rows_loaded") -> DataFrame:
    """One row per table with its number of rows."""
    counted = [
        df.agg(F.count(F.lit(1)).alias(count_name)).select(F.lit(name).alias("tbl"), count_name)
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def clustered(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ``columns``.

    Written to Parquet this gives files with narrow min/max ranges, so
    lookups on the leading columns skip most of them. Ranges are cut on all
    columns together: a leading key with many rows spreads over many files.
    """
    ranged = df.repartitionByRange(files, *columns) if files else df.repartitionByRange(*columns)
    return ranged.sortWithinPartitions(*columns)


def bucket_skew(df: DataFrame, key: str, buckets: int) -> float | None:
    """Rows of the fullest bucket as a multiple of the mean: a report for choosing a layout.

    One small aggregate: a row per bucket reaches the driver as one number.
    """
    sizes = df.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg((F.max("n") * buckets / F.sum("n")).alias("worst")).first()["worst"]


def write_bucketed(df: DataFrame, table: str, path: str, columns: Sequence[str], buckets: int | None = None) -> None:
    """Writes a table bucketed by the first of ``columns`` and sorted by all.

    Later joins and groupings on that column need no shuffle. All rows of a
    key lie in one bucket; where `bucket_skew` shows that this is too much,
    `write_clustered` is the layout to take. ``buckets`` defaults to the
    shuffle partitions.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartition(buckets, columns[0])
        .write.mode("overwrite")
        .bucketBy(buckets, columns[0])
        .sortBy(*columns)
        .option("path", path)
        .saveAsTable(table)
    )


def write_clustered(df: DataFrame, table: str, path: str, columns: Sequence[str]) -> None:
    """Writes a table in ranges of all ``columns``: lookups skip files, and a key with many rows spreads over several."""
    clustered(df, list(columns)).write.mode("overwrite").option("path", path).saveAsTable(table)
