"""Written intermediate tables and small helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.session import shared_dir, tune

ROW_KEY = "__tw_row_key"
#: Settings while a table is written: shuffle files go at the end, and texts reach Python some megabytes at a time.
WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses.

    Those of an application lie in one folder named by its id, which may go when the application has ended."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and still there when an executor is lost.

    The shuffles that made it go when it is written, so a job of many steps holds the files of one."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    before = {key: spark.conf.get(key, None) for key in WRITING}
    for key, value in WRITING.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def released(*tables: DataFrame) -> None:
    """Deletes tables of `written` that nothing reads any more."""
    for df in tables:
        folders = {name.rsplit("/", 1)[0] for name in df.inputFiles()}
        for folder in folders:
            if df.sparkSession.sparkContext.applicationId in folder:
                system, place = fs.FileSystem.from_uri(folder)
                system.delete_dir(place)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def row_key() -> Column:
    """64 bits of a document's id and text: tells rows that share an id apart."""
    return F.xxhash64("doc_id", "text")


def keyed(documents: DataFrame) -> DataFrame:
    """Only the id, the text and the row key, whatever else the table holds."""
    return documents.select("doc_id", "text", row_key().alias(ROW_KEY))


def without_rows(documents: DataFrame, rows: DataFrame) -> DataFrame:
    """The documents whose (doc_id, row key) is not in ``rows``, with their own columns."""
    gone = rows.select(F.col("doc_id").alias("__tw_id"), F.col(ROW_KEY).alias("__tw_gone")).distinct()
    # The key alone deals out the rows; the id, hashed into it, only rules out a clash.
    same = F.coalesce(F.col("doc_id") == F.col("__tw_id"), F.col("doc_id").isNull() & F.col("__tw_id").isNull())
    hit = (F.col(ROW_KEY) == F.col("__tw_gone")) & same
    return documents.withColumn(ROW_KEY, row_key()).join(gone, hit, "left_anti").select(*documents.columns)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.transform(F.array(value), then)[0]
