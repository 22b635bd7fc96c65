"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the collation closest to the source database's, which ignores
# case, accents and trailing blanks.
SOURCE_COLLATION = "UNICODE_CI_AI_RTRIM"


def blank_to_null(text: Column) -> Column:
    """Trimmed text; empty and blank-only text become NULL."""
    return F.nullif(F.trim(text), F.lit(""))


def lower_text(text: Column) -> Column:
    return F.lower(blank_to_null(text))


def upper_text(text: Column) -> Column:
    return F.upper(blank_to_null(text))


def fold(text: Column) -> Column:
    """The text under the source collation: compare, group and join with it."""
    return F.collate(text, SOURCE_COLLATION)


def has_text(text: Column) -> Column:
    return F.coalesce(F.trim(text) != "", F.lit(False))


def category_name(raw: Column) -> Column:
    """Trimmed lower-case category; a missing one is called ``unknown``."""
    return F.coalesce(lower_text(raw), F.lit("unknown"))
