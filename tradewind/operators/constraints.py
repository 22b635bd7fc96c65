"""Constraint checks as jobs. Each returns rows (table, rule, violations)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import TABLES


def violates(rule: Column) -> Column:
    """True where a rule is false; unknown passes."""
    return ~F.coalesce(rule, F.lit(True))


def row_rules(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """Violations of any number of row rules in one pass over the table.

    ``rules`` maps a name to the condition under which a row breaks it.
    """
    counts = [F.count_if(broken).alias(name) for name, broken in rules.items()]
    wide = df.agg(*counts)
    return wide.unpivot([], list(rules), "rule", "violations").select(F.lit(table).alias("table"), "rule", "violations")


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    return row_rules(df, table, {f"not_null {c}": F.col(c).isNull() for c in columns})


def check(df: DataFrame, table: str, rules: Mapping[str, str | Column]) -> DataFrame:
    broken = {n: violates(F.expr(r) if isinstance(r, str) else r) for n, r in rules.items()}
    return row_rules(df, table, {f"check {n}": c for n, c in broken.items()})


def max_length(df: DataFrame, table: str, lengths: Mapping[str, int]) -> DataFrame:
    return row_rules(
        df, table, {f"length {c}": violates(F.char_length(F.col(c)) <= n) for c, n in lengths.items()}
    )


def unique(df: DataFrame, table: str, columns: Sequence[str], rule: str = "unique") -> DataFrame:
    """Rows beyond the first of their key. Keys holding a NULL equal nothing.

    Counts are combined before the shuffle, so a key with many copies costs
    one row per task.
    """
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    extra = (
        df.filter(complete)
        .groupBy(*columns)
        .agg((F.count(F.lit(1)) - 1).alias("_extra"))
        .agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias("violations"))
    )
    return extra.select(F.lit(table).alias("table"), F.lit(f"{rule} {', '.join(columns)}").alias("rule"), "violations")


def foreign_key(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str, parent_name: str = ""
) -> DataFrame:
    """Child rows whose key has no parent; a NULL key passes.

    The child is reduced to one row per key before the join, so a key that
    many rows share does not make the join uneven.
    """
    orphans = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")
        .agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("violations"))
    )
    rule = f"foreign_key {column} -> {parent_name}".rstrip(" ->")
    return orphans.select(F.lit(table).alias("table"), F.lit(rule).alias("rule"), "violations")


def validate_table(df: DataFrame, table: str, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Every declared rule of a typed table that its columns and ``parents`` allow to check."""
    spec = TABLES[table]
    present = set(df.columns)
    row_level = {f"not_null {c}": F.col(c).isNull() for c in spec.required if c in present}
    row_level |= {
        f"length {c}": violates(F.char_length(F.col(c)) <= n) for c, n in spec.lengths.items() if c in present
    }
    row_level |= {f"check {name}": violates(F.expr(rule)) for name, rule in spec.checks.items()}
    results = [row_rules(df, table, row_level)]
    if set(spec.primary_key) <= present:
        results.append(unique(df, table, spec.primary_key, "primary_key"))
    results += [unique(df, table, [c]) for c in spec.unique]
    results += [
        foreign_key(df, table, column, parents[parent], parent_column, parent)
        for column, parent, parent_column, _ in spec.references
        if column in present and parent in parents
    ]
    return reduce(DataFrame.unionByName, results)
