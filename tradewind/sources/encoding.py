"""Repair of text whose lines mix UTF-8 and Windows-1252."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Windows-1252 bytes 0x80-0x9F and the characters they stand
# for; the five codes left out are undefined.
CP1252_CODES = (
    0x80, 0x82, 0x83, 0x84, 0x85, 0x86, 0x87, 0x88, 0x89, 0x8A, 0x8B, 0x8C, 0x8E, 0x91,
    0x92, 0x93, 0x94, 0x95, 0x96, 0x97, 0x98, 0x99, 0x9A, 0x9B, 0x9C, 0x9E, 0x9F,
)
CP1252_CHARS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
UNDEFINED_CODES = (0x81, 0x8D, 0x8F, 0x90, 0x9D)


def _chars(codes: tuple[int, ...]) -> str:
    return "".join(map(chr, codes))


def repair_text(raw: Column) -> Column:
    """Text of bytes that are UTF-8, else Windows-1252, else Latin-1."""
    as_text = raw.cast("string")
    latin1 = F.decode(raw, "ISO-8859-1")
    undefined = F.translate(latin1, _chars(UNDEFINED_CODES), "") != latin1
    cp1252 = F.translate(latin1, _chars(CP1252_CODES), CP1252_CHARS)
    return F.when(F.is_valid_utf8(as_text), as_text).when(undefined, latin1).otherwise(cp1252)


def needs_repair(raw: Column) -> Column:
    return ~F.is_valid_utf8(raw.cast("string"))


def read_repaired_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text files with their text repaired and a flag for the ones that needed it."""
    raw = F.col("value").cast("binary")
    return spark.read.text(path).select(repair_text(raw).alias("line"), needs_repair(raw).alias("repaired"))
