"""Data-quality checks. Each returns rows (check, rows_affected)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_text
from ..functions.times import MASKS, parse_timestamp
from ..sources.duplicates import duplicate_files
from ..sources.encoding import needs_repair, repair_text
from .cleaning import clean_customers, south_west
from .joins import payment_mismatch

# The box valid points lie in, the filler text, and the state of
# a finished order.
BOX = {"lat": (-35, 6), "lng": (-75, -33)}
FILLER = "A"

# Texts that may be fillers have at most so many characters and fill this share
# of the rows with text; so many are counted, out of so many tracked.
SHORT = 3
FILLER_SHARE = 0.01
FILLERS = 100
TRACKED = 10_000
FINISHED = "delivered"


def _counts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """All checks of one table in one pass over it."""
    wide = df.agg(*[F.count_if(c).alias(name) for name, c in checks.items()])
    return wide.unpivot([], list(checks), "check", "rows_affected")


def missing_master(stg_orders: DataFrame) -> DataFrame:
    """How many customers a rebuilt customer list has."""
    return clean_customers(stg_orders).agg(F.count(F.lit(1)).alias("rows_affected")).select(
        F.lit("customers rebuilt from orders").alias("check"), "rows_affected"
    )


def repair_encoding(df: DataFrame, column: str) -> DataFrame:
    """The frame with a column of bytes turned into text."""
    return df.withColumn(column, repair_text(F.col(column)))


def encoding_report(df: DataFrame, column: str) -> DataFrame:
    return _counts(df, {f"{column} not valid UTF-8": needs_repair(F.col(column))})


def sign_inversion(geolocation: DataFrame, lat: str = "geolocation_lat", lng: str = "geolocation_lng") -> DataFrame:
    """Points inside the expected box, before and after both signs are made negative."""
    before = F.col(lat).between(*BOX["lat"]) & F.col(lng).between(*BOX["lng"])
    after = south_west(F.col(lat)).between(*BOX["lat"]) & south_west(F.col(lng)).between(*BOX["lng"])
    return _counts(geolocation, {"inside the box as read": before, "inside the box corrected": after})


def date_formats(df: DataFrame, column: str) -> DataFrame:
    """Rows per date format, blank and unreadable text included."""
    text = F.col(column)
    named = [F.when(parse_timestamp(text, mask).isNotNull(), F.lit(name)) for name, mask in MASKS.items()]
    blank = F.when(~has_text(text), F.lit("blank"))
    return (
        df.groupBy(F.coalesce(blank, *named, F.lit("unreadable")).alias("check"))
        .agg(F.count(F.lit(1)).alias("rows_affected"))
    )


def duplicated_files(lines: DataFrame) -> DataFrame:
    return duplicate_files(lines).select(F.col("file").alias("check"), F.col("lines").alias("rows_affected"))


def flag_filler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The frame with a flag per column for text that is only the filler; the text stays."""
    return df.withColumns({f"{c}_is_filler": F.coalesce(F.trim(F.col(c)) == FILLER, F.lit(False)) for c in columns})


def placeholder_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    flagged = flag_filler(df, columns)
    return _counts(flagged, {f"{c} is filler": F.col(f"{c}_is_filler") for c in columns})


def found_fillers(
    df: DataFrame, columns: Sequence[str], longest: int = SHORT, share: float = FILLER_SHARE, most: int = FILLERS
) -> DataFrame:
    """(check, value, rows_affected): short texts that fill a share of a column's rows with text, found in the data.

    One pass keeps the frequent short texts of every column in sketches of
    bounded size, which lose no text above the share as long as that is more
    than 1 / TRACKED; the ``most`` best of each column are then counted exactly.
    """
    texts = {c: F.trim(F.col(c)) for c in columns}
    seen = df.agg(
        *[
            F.call_function(
                "approx_top_k", F.when(F.length(t).between(1, longest), t), F.lit(most), F.lit(TRACKED)
            ).alias(f"_top_{i}")
            for i, t in enumerate(texts.values())
        ],
        *[F.count_if(t != "").alias(f"_n_{i}") for i, t in enumerate(texts.values())],
    )
    found = F.array(
        *[F.struct(F.lit(c).alias("check"), F.col(f"_n_{i}").alias("n"), F.col(f"_top_{i}").alias("top")) for i, c in enumerate(columns)]
    )
    likely = seen.select(F.inline(found)).select("check", "n", F.explode("top.item").alias("value")).dropna()
    unpivoted = F.array(*[F.struct(F.lit(c).alias("check"), t.alias("value")) for c, t in texts.items()])
    return (
        df.select(F.inline(unpivoted))
        .join(F.broadcast(likely), ["check", "value"])
        .groupBy("check", "value", "n")
        .agg(F.count(F.lit(1)).alias("rows_affected"))
        .filter(F.col("rows_affected") >= F.col("n") * share)
        .select("check", "value", "rows_affected")
    )


def missing_category(stg_products: DataFrame) -> DataFrame:
    return _counts(stg_products, {"category missing": ~has_text(F.col("product_category_name"))})


def missing_dimensions(products: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with no value, per dimension, and rows with any of them missing."""
    empty = {f"{c} missing": F.col(c).isNull() for c in columns}
    return _counts(products, empty | {"any missing": reduce(lambda a, b: a | b, empty.values())})


def payment_mismatches(orders: DataFrame, order_payments: DataFrame, order_items: DataFrame) -> DataFrame:
    found = payment_mismatch(orders, order_payments, order_items, n=None)
    return found.agg(F.count(F.lit(1)).alias("rows_affected")).select(
        F.lit("payments differ from items").alias("check"), "rows_affected"
    )


def orders_without(orders: DataFrame, other: DataFrame, check: str = "orders without payment") -> DataFrame:
    # Distinct first: an order with very many rows in ``other`` is one row per task.
    missing = orders.select("order_id").join(other.select("order_id").distinct(), "order_id", "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("rows_affected")).select(F.lit(check).alias("check"), "rows_affected")


def delivered_without_date(orders: DataFrame) -> DataFrame:
    broken = (F.col("order_status") == FINISHED) & F.col("order_delivered_customer_date").isNull()
    return _counts(orders, {"delivered without a date": broken})


def csv_quoting(read_back: DataFrame, original: DataFrame, column: str, key: str) -> DataFrame:
    """Rows whose text holds commas, quotes or line ends, and those that did not survive a CSV round trip."""
    special = F.col("_original").rlike('[,"\n]')
    both = original.select(key, F.col(column).alias("_original")).join(
        read_back.select(key, F.col(column).alias("_read")), key, "left"
    )
    lost = ~F.col("_original").eqNullSafe(F.col("_read"))
    return _counts(both, {"text with commas, quotes or line ends": special, "text changed by the round trip": lost})
