"""Table changes as pure functions: each takes frames and returns new ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert_values(
    df: DataFrame, rows: Sequence[Mapping[str, object]], lookups: Mapping[str, Column] | None = None
) -> DataFrame:
    """Appends literal rows; columns they leave out are NULL.

    ``lookups`` gives columns computed by a one-row subquery (``frame.scalar()``).
    """
    names = [f for f in df.schema if any(f.name in r for r in rows)]
    literal = df.sparkSession.createDataFrame(
        [tuple(r.get(f.name) for f in names) for r in rows], _nullable(names)
    )
    for column, value in (lookups or {}).items():
        literal = literal.withColumn(column, value.cast(df.schema[column].dataType))
    return df.unionByName(literal, allowMissingColumns=True)


def _nullable(fields):
    from pyspark.sql.types import StructField, StructType

    return StructType([StructField(f.name, f.dataType, True) for f in fields])


def add_nullable_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    return df.withColumn(name, F.lit(None).cast(kind))


def fill_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Adds each column that the frame does not have, with its default."""
    return df.withColumns({c: v for c, v in defaults.items() if c not in df.columns})


def update_where_in(df: DataFrame, target: str, value: Column, match: str, names: Sequence[str]) -> DataFrame:
    """Sets ``target`` to a one-row subquery's value where ``match`` is in ``names``."""
    return df.withColumn(
        target, F.when(F.col(match).isin(list(names)), value.cast(df.schema[target].dataType)).otherwise(F.col(target))
    )


def delete_by_key(df: DataFrame, column: str, keys: DataFrame, key_column: str | None = None) -> DataFrame:
    gone = keys.select(F.col(key_column or column).alias(column))
    return df.join(gone, column, "left_anti").select(*df.columns)


def propagate_delete(child: DataFrame, column: str, deleted: DataFrame, key_column: str, action: str) -> DataFrame:
    """What a delete of parent keys leaves of a child table.

    ``cascade`` drops the child rows, ``set_null`` clears their key,
    ``restrict`` returns the child rows that stand in the way.
    """
    gone = deleted.select(F.col(key_column).alias(column))
    if action == "cascade":
        return child.join(gone, column, "left_anti").select(*child.columns)
    if action == "restrict":
        return child.join(gone, column, "left_semi").select(*child.columns)
    if action == "set_null":
        marked = gone.distinct().select(F.col(column).alias("_gone"))
        return (
            child.join(marked, F.col(column) == F.col("_gone"), "left")
            .withColumn(column, F.when(F.col("_gone").isNull(), F.col(column)))
            .select(*child.columns)
        )
    raise ValueError(f"unknown action {action!r}")
