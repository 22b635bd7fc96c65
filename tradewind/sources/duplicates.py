"""Input files that are copies of one another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import stored


def lines_of(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, bytes, block, row, line) of text files; ``line`` is not decoded.

    ``block`` is where the part of the file that one task reads begins, ``row``
    a number that grows by one with each line of it."""
    within_task = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_block_start").alias("block"),
        within_task.alias("row"),
        F.col("value").alias("line"),
    )


def empty_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file) of files without a byte: those in the listing, which the driver holds anyway, that no line comes from."""
    read = spark.read.text(paths)
    listed = spark.createDataFrame([(name,) for name in read.inputFiles()], "file string")

    def spelled(file: str) -> Column:
        """The two come with one or three slashes behind the scheme."""
        return F.regexp_replace(file, "^([a-z0-9]+):/+", "$1:/").alias("file")

    filled = read.select(spelled("_metadata.file_path")).distinct()
    return listed.select(spelled("file")).join(filled, "file", "left_anti")


def fingerprints(lines: DataFrame) -> DataFrame:
    """One row per file: size, lines, and digests of all lines in their order.

    A block's digest weighs every line with its distance from the block's first
    one: the sum of digest * row less the first row times the sum of digests, so
    partial sums are combined before the shuffle and a large file costs one row
    per task. Files of one size have the same blocks.
    """
    digest = F.shiftright(F.xxhash64("line"), 34)
    exact = "decimal(38,0)"
    blocks = lines.groupBy("file", "block").agg(
        F.max("bytes").alias("bytes"),
        F.count(F.lit(1)).alias("lines"),
        F.bit_xor(F.xxhash64(F.lit("second"), F.col("line"))).alias("xor"),
        F.min("row").alias("first"),
        F.sum(digest.cast(exact)).alias("total"),
        F.sum((digest * F.col("row")).cast(exact)).alias("weighed"),
    )
    ordered = F.col("weighed") - F.col("first").cast("decimal(12,0)") * F.col("total").cast("decimal(24,0)")
    return blocks.groupBy("file").agg(
        F.max("bytes").alias("bytes"),
        F.sum("lines").alias("lines"),
        F.bit_xor("xor").alias("xor_a"),
        F.bit_xor(F.xxhash64("block", "lines", ordered.cast("string"))).alias("xor_b"),
        F.sum("total").alias("total"),
    )


def duplicate_files(lines: DataFrame) -> DataFrame:
    """(keep, file, lines) of every file that repeats another one.

    ``keep`` is the first file name of the group. Files with the same lines in
    another order are not copies. Files with the same fingerprint are then compared line by line, when the job is built: a file whose count of any line
    differs from the kept file's is not reported.
    """
    same = Window.partitionBy("bytes", "lines", "xor_a", "xor_b", "total")
    grouped = fingerprints(lines).withColumn("keep", F.min("file").over(same))
    candidates = grouped.filter(F.col("file") != F.col("keep")).select("keep", "file", "lines")
    # Stored, so that the planner knows how few rows they are: lines then meet them where they are read, and no
    # task gets all lines of a file.
    candidates = stored(candidates.withColumn("_pair", F.monotonically_increasing_id()), "same_fingerprint")
    sides = [candidates.select("_pair", F.col(side).alias("_file"), F.lit(n).alias("_n")) for side, n in (("file", 1), ("keep", -1))]
    differing = (
        lines.select(F.col("file").alias("_file"), "line")
        .join(sides[0].unionByName(sides[1]), "_file")
        .groupBy("_pair", "line")
        .agg(F.sum("_n").alias("n"))
        .filter(F.col("n") != 0)
        .select("_pair")
        .distinct()
    )
    return candidates.join(differing, "_pair", "left_anti").drop("_pair")


def without_duplicate_files(lines: DataFrame) -> DataFrame:
    """Lines of one file of each group of copies, and of all other files."""
    return lines.join(duplicate_files(lines).select("file"), "file", "left_anti")
