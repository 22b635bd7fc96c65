"""CSV records of any number of lines, read from files that stay splittable.

Spark cuts files into blocks of lines. Whether a block begins inside quotes
depends on all blocks before it, but each block tells on its own where it would
end from either beginning. One row per block carries that through the file; then
every block cuts its own records, and only the ends of records that lie on a
border travel to be put together.

A field is quoted when its first character is a quote. Quotes inside are doubled;
what follows the closing quote belongs to the field up to the next comma or line
end. A quote elsewhere is a plain character.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .encoding import repair_text

# A line's way from the beginning of a field, or from within quotes, to its end.
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_FIELDS = rf'(?:(?:"{_QUOTED}"[^,]*+|[^",][^,]*+|),)*+'
_OPENS = re.compile(rf'{_FIELDS}"{_QUOTED}\Z')
_STAYS_OPEN = re.compile(rf'{_QUOTED}(?:\Z|"[^,]*+,{_FIELDS}"{_QUOTED}\Z)')


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that begins at a record's start, or inside quotes, ends inside quotes."""
    return (_STAYS_OPEN if inside else _OPENS).match(line) is not None


def _lines(spark: SparkSession, path: str | list[str], repair: bool) -> DataFrame:
    """(file, block, line) in the order of the files within each block."""
    value = repair_text(F.col("value").cast("binary")) if repair else F.col("value")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), value.alias("line")
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict, pa.Array]]:
    """(whether a block begins, its columns, some of its lines)."""
    last = None
    for batch in batches:
        if not len(batch):
            continue
        file, block = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
        code = file.indices.to_numpy()
        cuts = np.flatnonzero((np.diff(code) != 0) | (np.diff(block) != 0)) + 1
        for low, high in zip([0, *cuts], [*cuts, len(batch)], strict=True):
            own = {x: batch.column(x)[low].as_py() for x in batch.schema.names if x != "line"}
            yield own != last, own, batch.column("line").slice(low, high - low)
            last = own


def _with_quotes(lines: pa.Array) -> Iterator[tuple[int, str]]:
    at = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    return zip(at.tolist(), lines.take(pa.array(at)).to_pylist(), strict=True)


def _block_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, from_start, from_inside): whether a block ends inside quotes, by how it begins."""

    def out(own: dict, state: list[bool]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{**own, "from_start": state[0], "from_inside": state[1]}], _BLOCK)

    held, state = None, [False, True]
    for begins, own, lines in _blocks(batches):
        if begins:
            if held is not None:
                yield out(held, state)
            held, state = own, [False, True]
        for _, line in _with_quotes(lines):
            state = [ends_inside(line, state[0])] * 2 if state[0] == state[1] else [ends_inside(line, x) for x in state]
    if held is not None:
        yield out(held, state)


_BLOCK = pa.schema([("file", pa.string()), ("block", pa.int64()), ("from_start", pa.bool_()), ("from_inside", pa.bool_())])
_PIECE = pa.schema([("file", pa.string()), ("block", pa.int64()), ("part", pa.int32()), ("first", pa.bool_()), ("record", pa.string())])
_WHOLE, _ENDS, _BEGINS = 0, 1, 2


def _block_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that lie in a block, and the parts of those that go over its borders.

    ``part``: _WHOLE, _ENDS (of a record begun in an earlier block; perhaps it goes on), _BEGINS."""

    def out(own: dict, part: list[int], first: list[bool], records: pa.Array) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays(
            [pa.array([own["file"]] * n, pa.string()), pa.array([own["block"]] * n, pa.int64()),
             pa.array(part, pa.int32()), pa.array(first, pa.bool_()), records.cast(pa.string())], schema=_PIECE
        )

    held, waiting, inside, came_inside, first = None, [], False, False, False

    def rest() -> pa.RecordBatch:
        return out(held, [_ENDS if came_inside else _BEGINS], [first], pa.array(["\n".join(waiting)]))

    for begins, own, lines in _blocks(batches):
        if begins:
            if waiting:
                yield rest()
            held, waiting, inside, first = own, [], own["inside"], own["block"] == 0
            came_inside = inside
        # The state after each line changes only at lines with quotes.
        after, low = np.empty(len(lines), bool), 0
        for k, line in _with_quotes(lines):
            after[low:k] = inside
            inside = ends_inside(line, inside)
            after[k], low = inside, k + 1
        after[low:] = inside
        closed = np.flatnonzero(~after) + 1
        if not len(closed):
            waiting += lines.to_pylist()
            continue
        if waiting:
            waiting += lines[: closed[0]].to_pylist()
            yield out(own, [_ENDS if came_inside else _WHOLE], [first], pa.array(["\n".join(waiting)]))
            first, came_inside, begin = False, False, 0
        else:
            begin = -1
        offsets = np.r_[0, closed] if begin < 0 else closed
        if len(offsets) > 1:
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), lines), "\n")
            part, firsts = np.zeros(len(joined), int), np.zeros(len(joined), bool)
            part[0], firsts[0] = (_ENDS if came_inside else _WHOLE), first
            yield out(own, part.tolist(), firsts.tolist(), joined)
            first, came_inside = False, False
        waiting = lines[closed[-1] :].to_pylist()
    if waiting:
        yield rest()


def read_records(spark: SparkSession, path: str | list[str], repair: bool = False) -> DataFrame:
    """(file, record) of CSV files, without their headers and empty lines; line ends inside quotes stay in the record.

    ``repair``: lines that are no UTF-8 are read as `encoding.repair_text` does, before records are cut."""
    lines = _lines(spark, path, repair)
    blocks = lines.mapInArrow(_block_ends, "file string, block long, from_start boolean, from_inside boolean")
    # One row for each block. Either beginning leads to the same end, or the end follows the beginning, or turns it around.
    fixed = F.col("from_start") == F.col("from_inside")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turned = blocks.withColumn("turns", F.sum(F.when(~fixed & F.col("from_start"), 1).otherwise(0)).over(order))
    reached = F.last(F.when(fixed, F.struct("from_start", "turns")), ignorenulls=True).over(before)
    turns = F.coalesce(F.lag("turns").over(order), F.lit(0)) - F.coalesce(reached["turns"], F.lit(0))
    starts = turned.select(
        F.col("file").alias("_file"), F.col("block").alias("_block"),
        (F.coalesce(reached["from_start"], F.lit(False)) != (turns % 2 == 1)).alias("inside"),
    ).filter("inside")
    here = (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block"))
    known = lines.join(F.broadcast(starts), here, "left").select(
        "file", "block", F.coalesce("inside", F.lit(False)).alias("inside"), "line"
    )
    pieces = known.mapInArrow(_block_records, "file string, block long, part int, first boolean, record string")
    whole = pieces.filter(F.col("part") == _WHOLE).select("file", "first", "record")
    # At most two parts of a block: the end of a record, then the beginning of another.
    number = F.sum((F.col("part") == _BEGINS).cast("int")).over(Window.partitionBy("file").orderBy("block", "part"))
    parts = pieces.filter(F.col("part") != _WHOLE).withColumn("number", number)
    texts = F.transform(F.array_sort(F.collect_list(F.struct("block", "part", "record"))), lambda x: x["record"])
    over = parts.groupBy("file", "number").agg(F.max("first").alias("first"), F.array_join(texts, "\n").alias("record"))
    records = whole.unionByName(over.drop("number")).filter(~F.col("first")).drop("first")
    return records.filter(~F.col("record").isin("", "\r"))
