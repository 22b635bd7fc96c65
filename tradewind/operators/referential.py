"""Deletes that follow the declared references through all tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import REFERENCES
from ..session import checkpointed

Reference = tuple[str, str, str, str]


@dataclass
class Deletion:
    """What a delete leaves of every table, and the rows that stand in its way: (table, column, parent, blocking_rows).

    A delete that is blocked leaves all tables as they were."""

    tables: dict[str, DataFrame]
    blockers: DataFrame
    blocked: bool


def _parents_first(names: Sequence[str], references: Mapping[str, Sequence[Reference]]) -> list[str]:
    """Tables so that each stands behind those whose deletes cascade to it; one may cascade to itself."""
    waits = {n: {r[1] for r in references.get(n, ()) if r[3] == "cascade" and r[1] in names and r[1] != n} for n in names}
    order: list[str] = []
    while waits:
        free = [n for n, parents in waits.items() if not parents - set(order)]
        if not free:
            raise ValueError(f"cascades in a circle: {sorted(waits)}")
        order += free
        for n in free:
            del waits[n]
    return order


def _hits(child: DataFrame, columns: Sequence[str], gone: Sequence[DataFrame]) -> DataFrame:
    """The child with one flag per reference, ``_hit0`` and so on: whether its key is among the deleted ones."""
    for n, (column, keys) in enumerate(zip(columns, gone, strict=True)):
        marked = keys.distinct().withColumnsRenamed({keys.columns[0]: f"_key{n}"})
        child = child.join(marked, F.col(column) == F.col(f"_key{n}"), "left")
        child = child.withColumn(f"_hit{n}", F.col(f"_key{n}").isNotNull()).drop(f"_key{n}")
    return child


def _with_descendants(rows: DataFrame, table: DataFrame, column: str, parent_column: str) -> DataFrame:
    """(parent_column) of the rows and of all rows below them in a table that cascades to itself."""
    found = frontier = checkpointed(rows.select(parent_column).distinct())
    while not frontier.isEmpty():
        below = _hits(table.select(parent_column, column), [column], [frontier]).filter("_hit0").select(parent_column)
        frontier = checkpointed(below.distinct().join(found, parent_column, "left_anti"))
        found = found.union(frontier)
    return found


def delete_over_references(
    tables: Mapping[str, DataFrame],
    table: str,
    keys: DataFrame,
    references: Mapping[str, Sequence[Reference]] | None = None,
) -> Deletion:
    """Deletes the rows of ``table`` whose columns of ``keys`` match, and what the references make of the others.

    Per child column: ``cascade`` deletes the referring rows, and what refers
    to those in turn; ``set_null`` clears the column; a row that a ``restrict``
    reference ties to a deleted row, at any depth, blocks the whole delete (also
    where another reference would delete it). NULL refers to nothing. Each table
    is read once for its flags; the number of blocking rows is all that the
    driver sees. References of tables or columns that are not given are left out.
    """
    references = REFERENCES if references is None else references
    known = {
        name: [r for r in references.get(name, ()) if r[0] in df.columns and r[1] in tables] for name, df in tables.items()
    }
    order = _parents_first(list(tables), known)
    if table not in tables:
        raise ValueError(f"unknown table {table!r}")
    doomed: dict[str, DataFrame] = {}
    left = dict(tables)
    blocking: list[DataFrame] = []
    flagged: dict[str, tuple[list[Reference], DataFrame]] = {}
    for name in order:
        df = tables[name]
        own = [r for r in known[name] if r[1] in doomed and r[3] == "cascade" and r[1] != name]
        marks = _hits(df, [r[0] for r in own], [doomed[r[1]].select(r[2]) for r in own])
        hit = [F.col(f"_hit{n}") for n in range(len(own))]
        gone = [marks.filter(reduce(lambda a, b: a | b, hit)).select(*df.columns)] if hit else []
        if name == table:
            gone.append(df.join(keys.distinct(), keys.columns, "left_semi"))
        if not gone:
            continue
        rows = reduce(DataFrame.union, gone)
        for column, _, parent_column, _ in [r for r in known[name] if r[1] == name and r[3] == "cascade"]:
            every = _with_descendants(rows, df, column, parent_column)
            rows = df.join(every, parent_column, "left_semi").select(*df.columns)
        doomed[name] = rows
    for name, df in tables.items():
        own = [r for r in known[name] if r[1] in doomed]
        if name in doomed and name == table and not any(r[3] == "cascade" for r in own):
            left[name] = df.join(keys.distinct(), keys.columns, "left_anti").select(*df.columns)
        if not own:
            continue
        marks = _hits(df, [r[0] for r in own], [doomed[r[1]].select(r[2]) for r in own])
        flagged[name] = own, marks
    for name, (own, marks) in flagged.items():
        counts = [F.count_if(f"_hit{n}").alias(f"n{n}") for n, r in enumerate(own) if r[3] == "restrict"]
        if counts:
            ties = [
                F.struct(F.lit(r[0]).alias("column"), F.lit(r[1]).alias("parent"), F.col(f"n{n}").alias("blocking_rows"))
                for n, r in enumerate(own)
                if r[3] == "restrict"
            ]
            blocking.append(marks.agg(*counts).select(F.lit(name).alias("table"), F.inline(F.array(*ties))))
        goes = [F.col(f"_hit{n}") for n, r in enumerate(own) if r[3] == "cascade"]
        kept = marks.filter(~reduce(lambda a, b: a | b, goes)) if goes else marks
        for n, r in enumerate(own):
            if r[3] == "set_null":
                kept = kept.withColumn(r[0], F.when(~F.col(f"_hit{n}"), F.col(r[0])))
        if name == table:
            kept = kept.join(keys.distinct(), keys.columns, "left_anti")
        left[name] = kept.select(*tables[name].columns)
    spark = keys.sparkSession
    none = spark.createDataFrame([], "`table` string, `column` string, parent string, blocking_rows bigint")
    blockers = checkpointed(reduce(DataFrame.unionByName, blocking, none).filter("blocking_rows > 0"))
    blocked = not blockers.isEmpty()
    return Deletion(dict(tables) if blocked else left, blockers, blocked)
