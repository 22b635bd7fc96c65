"""Raw CSV files to all-text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import raw_schema
from .duplicates import lines_of
from .records import read_records

_BAD = "_malformed"


def _parse(spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool, repair: bool) -> DataFrame:
    with_bad = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    if multi_line:
        # Spark's own reader would need whole files per task.
        return _parse_records(read_records(spark, path, repair), "record", with_bad)
    reader = (
        spark.read.schema(with_bad)
        .option("header", True)
        .option("escape", '"')
        .option("nullValue", "\\N")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD)
        # Lines with too many or too few fields are only noticed when the
        # parser looks at all of them.
        .option("columnPruning", False)
        .option("enforceSchema", True)
    )
    return reader.option("lineSep", "\n").csv(path)


def _parse_records(records: DataFrame, column: str, schema: T.StructType, *kept: str) -> DataFrame:
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    options = {"escape": '"', "nullValue": "\\N", "columnNameOfCorruptRecord": _BAD, "multiLine": "true"}
    text = F.regexp_replace(F.col(column), "\r\\z", "")
    return records.select(*kept, F.from_csv(text, ddl, options).alias("r")).select(*kept, "r.*")


def _split(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed, malformed) lines.

    Spark refuses a query that reads nothing but the malformed column, so the
    always-true condition keeps a data column in every query, `count` too.
    """
    first = F.length(parsed.columns[0])
    reads_data = F.coalesce(first >= 0, F.lit(True))
    bad = F.col(_BAD).isNotNull()
    return parsed.filter(~bad & reads_data), parsed.filter(bad & reads_data)


def header_mismatches(spark: SparkSession, path: str | list[str], table: str | T.StructType) -> DataFrame:
    """(file, header) of files whose first line does not name the declared columns in their order.

    `read_staging` goes by position, so such a file would load into the wrong
    columns. Only the first block of each file is looked at.
    """
    schema = raw_schema(table) if isinstance(table, str) else table
    first = lines_of(spark, path).filter("block = 0").groupBy("file").agg(F.min_by("line", "row").alias("header"))
    plain = F.regexp_replace("header", '^\ufeff|["\r]', "")
    return first.filter(plain != ",".join(schema.fieldNames()))


def read_staging(
    spark: SparkSession,
    path: str | list[str],
    table: str | T.StructType,
    multi_line: bool = False,
    repair: bool = False,
) -> DataFrame:
    """Text columns of a headered, comma-separated, optionally quoted CSV.

    Values are not changed, except that a carriage return before the line end
    is not part of the last column. Lines with a wrong number of fields are
    left to `read_malformed`. ``multi_line`` takes line ends inside quotes as
    part of a value, and ``repair`` then reads lines that are no UTF-8 as
    `encoding.repair_text` does; files stay splittable either way.
    """
    schema = raw_schema(table) if isinstance(table, str) else table
    parsed, _ = _split(_parse(spark, path, schema, multi_line, repair))
    last = schema.fieldNames()[-1]
    return parsed.select(*schema.fieldNames()[:-1], F.regexp_replace(last, "\r$", "").alias(last))


def read_malformed(
    spark: SparkSession,
    path: str | list[str],
    table: str | T.StructType,
    multi_line: bool = False,
    repair: bool = False,
) -> DataFrame:
    """The lines `read_staging` leaves out, as text, with a reason."""
    schema = raw_schema(table) if isinstance(table, str) else table
    _, bad = _split(_parse(spark, path, schema, multi_line, repair))
    return bad.select(F.col(_BAD).alias("line"), F.lit("wrong number of fields").alias("reject_reason"))


def parse_lines(lines: DataFrame, column: str, table: str | T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, malformed) of records that already are a column, such as repaired lines or `records.read_records`."""
    schema = raw_schema(table) if isinstance(table, str) else table
    parsed = _parse_records(lines, column, T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())]))
    good = parsed.filter(F.col(_BAD).isNull()).drop(_BAD)
    bad = parsed.filter(F.col(_BAD).isNotNull()).select(
        F.col(_BAD).alias("line"), F.lit("wrong number of fields").alias("reject_reason")
    )
    return good, bad
