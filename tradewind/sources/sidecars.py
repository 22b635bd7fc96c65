"""Which files of a table may hold a key: small tables beside the data, for look-ups on columns it is not laid out by.

A layout keeps like values of its first column together, so Parquet's ranges skip
files for that one only. A sidecar has, for each file and column, a bit map of the
hashes of its values, cut into parts of 4 KB and sorted by part. A batch of keys
reads the parts that its hashes fall into, and then only files with a bit set:
a file that holds a key is never left out, one that does not is read by chance.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bits for each row of the fullest file, and of a part (what Spark's bit map functions take).
BITS_PER_ROW = 16
PART = 1 << 15


def _hash(value: Column, parts: int) -> tuple[Column, Column]:
    """(part, bit) of a value."""
    place = F.pmod(F.xxhash64(value.cast("string")), F.lit(parts * PART))
    return F.floor(place / PART).cast("int"), (place % PART).cast("int")


def write_sidecar(spark: SparkSession, path: str, folder: str, columns: Sequence[str]) -> None:
    """Writes the sidecar of the Parquet files in ``path`` for some columns: column, parts, part, file, bits.

    Every file is read once, for these columns. The bits of a value are added up
    in each task; 2 bytes a row and column at most are stored."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), *columns)
    # One row per file; one number decides for all.
    fullest = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 1
    parts = 1 << max(0, math.ceil(math.log2(fullest * BITS_PER_ROW / PART)))
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    part, bit = _hash(F.col("of.value"), parts)
    bits = (
        rows.select("file", values.alias("of"))
        .filter(F.col("of.value").isNotNull())
        .groupBy(F.col("of.column").alias("column"), F.lit(parts).alias("parts"), part.alias("part"), "file")
        .agg(F.bitmap_construct_agg(bit).alias("bits"))
    )
    bits.repartitionByRange("column", "part", "file").sortWithinPartitions("column", "part").write.mode("overwrite").parquet(folder)


def matching_files(spark: SparkSession, folder: str, column: str, keys: DataFrame) -> list[str]:
    """Names of the files that may hold one of the ``keys`` (their first column): fewer than the table's listing has."""
    stored = spark.read.parquet(folder).filter(F.col("column") == column)
    first = stored.select("parts").head()
    if first is None:
        return []
    part, bit = _hash(F.col(keys.columns[0]), first["parts"])
    wanted = keys.filter(F.col(keys.columns[0]).isNotNull()).select(part.alias("part"), bit.alias("bit")).distinct()
    byte = F.conv(F.hex(F.expr("substring(bits, int(bit / 8) + 1, 1)")), 16, 10).cast("int")
    there = F.expr("(b >> (bit % 8)) & 1") == 1
    hits = stored.join(wanted, "part").withColumn("b", byte).filter(there)
    return [r["file"] for r in hits.select("file").distinct().collect()]


def read_matching(spark: SparkSession, path: str, folder: str, column: str, keys: DataFrame) -> DataFrame:
    """The rows of the table whose ``column`` is among the keys, from the files that may hold them."""
    files = matching_files(spark, folder, column, keys)
    rows = spark.read.parquet(path)
    rows = rows.filter(F.col("_metadata.file_path").isin(files))
    wanted = keys.select(F.col(keys.columns[0]).alias(column)).distinct()
    return rows.join(wanted, column, "left_semi").select(*rows.columns)
