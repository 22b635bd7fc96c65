"""All-or-nothing appends to several Parquet tables.

A batch is written to its own folder of every table and becomes visible only
through one entry in the list of published batches, which is written last and
only when no rule is broken. A job that dies half-way leaves folders that no
reader looks at.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..schemas import TABLES
from .constraints import validate_table

_PUBLISHED = "_published"
_RETIRED = "_retired"


def published_batches(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema("batch string").json(f"{root}/{_PUBLISHED}")
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "batch string")


def retired_folder(root: str, batch_id: str) -> str:
    """Where a batch lists (table, file) of the files that it replaces."""
    return f"{root}/{_RETIRED}/batch={_label(batch_id)}"


def _retired_files(spark: SparkSession, root: str, table: str) -> list[str]:
    """Names of the files that published batches have replaced; the driver holds the listing that they are in anyway."""
    try:
        listed = spark.read.schema("`table` string, file string, batch string").parquet(f"{root}/{_RETIRED}")
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    replaced = listed.filter(F.col("table") == table).join(published_batches(spark, root).distinct(), "batch", "left_semi")
    return [r["file"] for r in replaced.select("file").collect()]


def published_files(spark: SparkSession, root: str, table: str, files: Sequence[str] | None = None) -> DataFrame:
    """Rows of all published batches of a table, or of some of its files, with the file's name in ``_file``.

    Replaced files are left out of the listing, not read and filtered."""
    path = F.col("_metadata.file_path")
    rows = spark.read.option("basePath", f"{root}/{table}").parquet(f"{root}/{table}").withColumn("_file", path)
    if files is not None:
        return rows.filter(path.isin(list(files))).drop("batch")
    retired = _retired_files(spark, root, table)
    rows = rows.filter(~path.isin(retired)) if retired else rows
    return rows.join(published_batches(spark, root).distinct(), "batch", "left_semi").drop("batch")


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of all published batches of a table."""
    return published_files(spark, root, table).drop("_file")


def publish(spark: SparkSession, root: str, batch_id: str) -> None:
    """Makes a written batch visible."""
    row = spark.createDataFrame([(_label(batch_id),)], "batch string")
    row.coalesce(1).write.mode("append").json(f"{root}/{_PUBLISHED}")


def is_published(spark: SparkSession, root: str, batch_id: str) -> bool:
    return not published_batches(spark, root).filter(F.col("batch") == _label(batch_id)).isEmpty()


def batch_folder(root: str, table: str, batch_id: str) -> str:
    return f"{root}/{table}/batch={_label(batch_id)}"


def gated_append(
    batch: Mapping[str, DataFrame],
    existing: Mapping[str, DataFrame],
    root: str,
    batch_id: str,
) -> DataFrame:
    """Appends ``batch`` when it breaks no rule, else leaves every table as it is.

    Returns rows (table, rule, violations, accepted). The batch is written to
    its folders first, where no reader looks before it is published, and the
    written rows are checked: against the parents in ``existing`` and in the
    batch itself, and their keys against the ones already there. One number, the
    sum of violations, decides on the driver.
    """
    stored = {}
    for name, df in batch.items():
        folder = batch_folder(root, name, batch_id)
        df.write.mode("overwrite").parquet(folder)
        stored[name] = df.sparkSession.read.schema(df.schema).parquet(folder)
    batch = stored
    parents = dict(existing)
    for name, df in batch.items():
        parents[name] = existing[name].unionByName(df, allowMissingColumns=True) if name in existing else df
    results = []
    for name, df in batch.items():
        results.append(validate_table(df, name, parents))
        if name in existing:
            results.append(_already_there(df, existing[name], name))
    findings = reduce(DataFrame.unionByName, results)
    spark = findings.sparkSession
    # The findings are one row per rule; written down so that the decision and
    # the report come from the same run.
    report = f"{root}/_reports/{batch_id}"
    findings.write.mode("overwrite").parquet(report)
    findings = spark.read.parquet(report)
    total = findings.agg(F.sum("violations").alias("n")).first()["n"]
    accepted = total == 0
    if accepted:
        publish(spark, root, batch_id)
    return findings.withColumn("accepted", F.lit(accepted))


def _label(batch_id: str) -> str:
    """Folder value of a batch; the letters keep ids such as 01 from being read as numbers."""
    return f"id_{batch_id}"


def _already_there(df: DataFrame, existing: DataFrame, table: str) -> DataFrame:
    key = TABLES[table].primary_key
    # The stored table is cut down to the batch's keys first; a batch that is
    # small is broadcast for this and the stored rows do not move.
    stored = existing.select(*key).join(df.select(*key), key, "left_semi")
    clash = df.select(*key).join(stored, key, "left_semi").agg(F.count(F.lit(1)).alias("violations"))
    return clash.select(F.lit(table).alias("table"), F.lit("primary_key already stored").alias("rule"), "violations")
