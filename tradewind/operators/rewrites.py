"""Updates and deletes of published tables that write only the files they touch.

The rows to change are found with the file they lie in. Those files are read as a
whole, changed and written as a new batch, and their names go to a list beside
it. Publishing the batch shows the new files and hides the old ones at once, by
the same entry that shows an append; until then readers see the table as it was.
All other files stay as they are. A change that dies half-way is done anew under
its batch id, and one that is published is not done again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .gated import batch_folder, is_published, publish, published_files, retired_folder


def rewrite_files(
    spark: SparkSession,
    root: str,
    table: str,
    batch_id: str,
    touched: Callable[[DataFrame], DataFrame],
    change: Callable[[DataFrame], DataFrame],
) -> list[str]:
    """Applies ``change`` to the files of a published table that hold a row of ``touched``; their names.

    ``touched`` keeps the rows to be changed, ``change`` maps all rows of their
    files to what shall stand there. Only file names reach the driver, which
    holds the table's listing anyway.
    """
    if is_published(spark, root, batch_id):
        return []
    files = [r["_file"] for r in touched(published_files(spark, root, table)).select("_file").distinct().collect()]
    if files:
        old = published_files(spark, root, table, files).drop("_file")
        change(old).write.mode("overwrite").parquet(batch_folder(root, table, batch_id))
        names = spark.createDataFrame([(table, f) for f in files], "`table` string, file string")
        names.write.mode("overwrite").parquet(retired_folder(root, batch_id))
    publish(spark, root, batch_id)
    return files


def delete_published(
    spark: SparkSession, root: str, table: str, batch_id: str, column: str, keys: DataFrame, key_column: str | None = None
) -> list[str]:
    """Deletes the rows whose ``column`` is among the keys; NULL is none. The names of the files written anew."""
    gone = keys.select(F.col(key_column or column).alias(column))
    return rewrite_files(
        spark, root, table, batch_id,
        lambda df: df.join(gone, column, "left_semi"),
        lambda df: df.join(gone, column, "left_anti").select(*df.columns),
    )


def update_published(
    spark: SparkSession, root: str, table: str, batch_id: str, condition: Column, values: Mapping[str, Column]
) -> list[str]:
    """Sets columns where the condition is true; the new values may read the old ones. The names of the files written anew."""

    def change(df: DataFrame) -> DataFrame:
        here = F.coalesce(condition, F.lit(False))
        return df.withColumns({c: F.when(here, v.cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, v in values.items()})

    return rewrite_files(spark, root, table, batch_id, lambda df: df.filter(condition), change)
