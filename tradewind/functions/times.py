"""Date and time expressions. All timestamps are without time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two formats the raw files use. Each is a pattern and the
# rearrangement that puts its parts into year-first order.
YEAR_FIRST = (r"^(\d{4})-(\d{1,2})-(\d{1,2}) (\d{1,2}):(\d{1,2}):(\d{1,2})$", None)
DAY_FIRST = (r"^(\d{1,2})-(\d{1,2})-(\d{4}) (\d{1,2}):(\d{1,2})$", "$3-$2-$1 $4:$5:00")

MASKS = {"yyyy-MM-dd HH:mm:ss": YEAR_FIRST, "dd-MM-yyyy HH:mm": DAY_FIRST}


def parse_timestamp(text: Column, mask: tuple[str, str | None], strict: bool = False) -> Column:
    """Timestamp of text written in ``mask``.

    Text in another format and dates that do not exist give NULL, or raise
    when ``strict``. Parsing does not depend on the session time zone.
    """
    pattern, reorder = mask
    trimmed = F.nullif(F.trim(text), F.lit(""))
    year_first = trimmed if reorder is None else F.regexp_replace(trimmed, pattern, reorder)
    if strict:
        wrong = F.raise_error(F.concat(F.lit("not in the expected format: "), trimmed))
        checked = F.when(trimmed.isNull() | trimmed.rlike(pattern), year_first).otherwise(wrong.cast("string"))
        return checked.cast("timestamp_ntz")
    return F.when(trimmed.rlike(pattern), year_first).try_cast("timestamp_ntz")


def day(ts: Column) -> Column:
    return F.to_date(ts)


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def month_start(ts: Column) -> Column:
    return F.trunc(ts, "MM")


def iso_yearweek(ts: Column) -> Column:
    """ISO year and week as one number, 2018-12-31 -> 201901."""
    return F.extract(F.lit("YEAROFWEEK"), ts) * 100 + F.weekofyear(ts)
