"""Raw text tables to typed tables.

Every job returns the accepted rows and, apart from them, the rejected ones
with a reason. A row is rejected when the source's own filters leave it out,
or when its strict load would refuse it: a required value is missing, text
cannot be read as the column's type or is too long, a row rule is broken, a
parent is unknown. With ``strict`` unreadable text fails the job instead; review
scores and coordinates are filtered by pattern before they are read, so bad ones
are set aside in either mode.

All reasons are worked out in one pass over the raw rows; only their keys are read
before, to find those that a parent lacks, so a raw table must not change
meanwhile. That search runs when the job is built. ``hold`` is applied to
the marked rows before they are split (`load_production` passes a reliable
checkpoint), so that accepted and rejected rows come from one reading.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import rounded_int, to_decimal, truncated_int
from ..functions.text import blank_to_null, category_name, fold, has_text, lower_text, upper_text
from ..functions.times import DAY_FIRST, YEAR_FIRST, parse_timestamp
from ..operators.changes import fill_defaults
from ..operators.constraints import violates
from ..operators.keys import extend_key_map, with_surrogate_key
from ..schemas import TABLES
from ..session import checkpointed
from ..sources.tables import stored, write_table

REASON = "reject_reason"

# Patterns and ranges a raw value must meet to be loaded.
WHOLE_NUMBER = "^[0-9]+$"
DECIMAL_NUMBER = r"^-?[0-9]+\.?[0-9]*$"
SCORES = (1, 5)
LATITUDES = (-90, 90)
LONGITUDES = (-180, 180)

# More unknown keys than this are never broadcast: the rows travel to them and meet a hash table, unsorted,
# unless they are to be written, which is smaller in the order of a key.
MANY_KEYS = 1_000_000


Hold = Callable[[DataFrame], DataFrame]


def _as_is(df: DataFrame) -> DataFrame:
    return df


class Cleaned(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


class Value(NamedTuple):
    """A typed value and the raw column it is read from."""

    raw: str
    value: Column


_TYPED = "_typed_"


def _sift(
    raw: DataFrame, table: str, values: Mapping[str, Value], reasons: Mapping[str, Column], strict: bool = False
) -> DataFrame:
    """Marks rows with the first reason that holds; unknown does not hold.

    After the given ``reasons`` come those the table declares: required
    values, text that could not be read, text that is too long, row rules.
    Rows carry the typed values next to the raw columns.
    """
    spec = TABLES[table]
    declared = {c.name: c for c in spec.columns}
    # A one-row generator instead of plain columns: the optimizer copies plain
    # expressions into every filter that uses them, and parsing is the main cost.
    row = F.struct(*[v.value.alias(_TYPED + name) for name, v in values.items()])
    typed = raw.select("*", F.inline(F.array(row)))
    found = [F.when(broken, F.lit(reason)) for reason, broken in reasons.items()]
    for name, v in values.items():
        value, column = F.col(_TYPED + name), declared[name]
        if isinstance(column.spark_type, T.StringType):
            if not column.nullable:
                found.append(F.when(value.isNull(), F.lit(f"no {name}")))
        else:
            missing = F.lit(None if column.nullable else f"no {name}").cast("string")
            unreadable = F.lit(None if strict else f"unreadable {name}").cast("string")
            found.append(F.when(value.isNull(), F.when(has_text(F.col(v.raw)), unreadable).otherwise(missing)))
        if column.max_length:
            found.append(F.when(F.char_length(value) > column.max_length, F.lit(f"too long {name}")))
    for rule, text in spec.checks.items():
        on_typed = re.sub(r"\b(" + "|".join(values) + r")\b", _TYPED + r"\1", text)
        found.append(F.when(violates(F.expr(on_typed)), F.lit(f"check {rule}")))
    return typed.withColumn(REASON, F.coalesce(*found))


def _with_parent(
    marked: DataFrame, raw: DataFrame, values: Mapping[str, Value], key: str, parent: DataFrame, reason: str,
    ordered: bool = False,
) -> DataFrame:
    """Marks rows whose typed key is not in the column of that name of ``parent``.

    Only the distinct keys meet the parent. Those it lacks are stored, so that the planner knows their size: the
    rows travel only where there are too many of them to broadcast. Keys are distinct, so a task's hash table holds
    an even share of them, and however many rows have one key, they only stream by it. With ``ordered`` rows that
    travel are sorted by the key, as files of them are smaller then.
    """
    keys = raw.select(values[key].value.alias("_unknown")).filter(F.col("_unknown").isNotNull()).distinct()
    known = parent.select(F.col(key).alias("_parent"))
    unknown = stored(keys.join(known, F.col("_unknown") == F.col("_parent"), "left_anti"), f"unknown_{key}")
    if not ordered and unknown.count() > MANY_KEYS:
        unknown = unknown.hint("shuffle_hash")
    joined = marked.join(unknown, F.col(_TYPED + key) == F.col("_unknown"), "left")
    orphan = F.when(F.col(_TYPED + key).isNull() | F.col("_unknown").isNotNull(), F.lit(reason))
    return joined.withColumn(REASON, F.coalesce(REASON, orphan)).drop("_unknown")


def _split(marked: DataFrame, raw: DataFrame, values: Mapping[str, Value], hold: Hold, *others: str) -> Cleaned:
    """Accepted rows with only the typed columns, in the order given; rejected ones as they came."""
    held = hold(marked)
    return Cleaned(
        held.filter(F.col(REASON).isNull()).select(*others, *[F.col(_TYPED + name).alias(name) for name in values]),
        held.filter(F.col(REASON).isNotNull()).select(*raw.columns, REASON),
    )


def _missing(text: str) -> Column:
    return ~has_text(F.col(text))


def _trimmed(name: str) -> Value:
    return Value(name, F.trim(name))


def _trimmed_or_empty(name: str, change: Callable[[Column], Column] = lambda c: c) -> Value:
    """Required text that may be empty: no text at all counts as empty text."""
    return Value(name, change(F.coalesce(F.trim(name), F.lit(""))))


def clean_customers(stg_orders: DataFrame) -> DataFrame:
    """Customer list rebuilt from the orders' customer ids."""
    ids = stg_orders.select(F.trim("customer_id").alias("customer_id")).filter(F.col("customer_id") != "").distinct()
    unknown = F.lit(None).cast("string")
    return ids.select(
        "customer_id",
        F.col("customer_id").alias("customer_unique_id"),
        unknown.alias("customer_zip_code_prefix"),
        unknown.alias("customer_city"),
        unknown.alias("customer_state"),
    )


def clean_category_lookup(stg_products: DataFrame) -> DataFrame:
    """Distinct category names, numbered by name.

    Names that differ only in case, accents or trailing blanks are one
    category, spelled as the first of them in sort order.
    """
    names = (
        _category_names(stg_products)
        .groupBy(fold(F.col("category_name")).alias("folded"))
        .agg(F.min("category_name").alias("category_name"))
        .select("category_name")
    )
    return with_surrogate_key(names, "category_id", ["category_name"]).withColumn(
        "category_id", F.col("category_id").cast("int")
    )


def _category_names(stg_products: DataFrame) -> DataFrame:
    return stg_products.select(category_name(F.col("product_category_name")).alias("category_name"))


def stored_category_lookup(stg_products: DataFrame, root: str, batch_id: str) -> DataFrame:
    """The lookup over all loads into ``root``: known categories keep their number, new ones follow.

    Names are told apart as in `clean_category_lookup`, which numbers one load on its own."""
    folded = fold(F.col("category_name"))
    every = extend_key_map(_category_names(stg_products), root, "product_category", batch_id, "category_name", "category_id", folded)
    return every.withColumn("category_id", F.col("category_id").cast("int"))


def clean_products(
    stg_products: DataFrame, product_category: DataFrame, strict: bool = False, hold: Hold = _as_is
) -> Cleaned:
    """Products with the number of their category; one whose category the lookup lacks is rejected."""
    values = {
        "product_id": _trimmed("product_id"),
        "product_name_length": Value("product_name_lenght", rounded_int(F.col("product_name_lenght"), strict)),
        "product_description_length": Value(
            "product_description_lenght", rounded_int(F.col("product_description_lenght"), strict)
        ),
        "product_photos_qty": Value("product_photos_qty", rounded_int(F.col("product_photos_qty"), strict)),
    }
    sizes = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
    values |= {c: Value(c, to_decimal(F.col(c), 10, 2, strict)) for c in sizes}
    sifted = _sift(stg_products, "products", values, {"no product_id": _missing("product_id")}, strict)
    categories = product_category.select("category_id", fold(F.col("category_name")).alias("_folded"))
    named = fold(category_name(F.col("product_category_name"))) == F.col("_folded")
    matched = sifted.join(categories, named, "left")
    unknown = F.when(F.col("category_id").isNull(), F.lit("unknown category"))
    matched = matched.withColumn(REASON, F.coalesce(REASON, unknown))
    accepted, rejected = _split(matched, stg_products, values, hold, "category_id")
    accepted = accepted.withColumn("product_photos_qty", F.coalesce("product_photos_qty", F.lit(0)))
    return Cleaned(accepted.select(*TABLES["products"].schema.names), rejected)


def clean_sellers(stg_sellers: DataFrame, hold: Hold = _as_is) -> Cleaned:
    values = {
        "seller_id": _trimmed("seller_id"),
        "seller_zip_code_prefix": Value("seller_zip_code_prefix", blank_to_null(F.col("seller_zip_code_prefix"))),
        "seller_city": Value("seller_city", lower_text(F.col("seller_city"))),
        "seller_state": Value("seller_state", upper_text(F.col("seller_state"))),
    }
    sifted = _sift(stg_sellers, "sellers", values, {"no seller_id": _missing("seller_id")})
    accepted, rejected = _split(sifted, stg_sellers, values, hold)
    return Cleaned(accepted.distinct(), rejected)


def clean_orders(
    stg_orders: DataFrame, customers: DataFrame, strict: bool = False, hold: Hold = _as_is, ordered: bool = False
) -> Cleaned:
    values = {
        "order_id": _trimmed("order_id"),
        "customer_id": _trimmed("customer_id"),
        "order_status": _trimmed_or_empty("order_status", F.lower),
    }
    times = [c.name for c in TABLES["orders"].columns if c.declared == "datetime"]
    values |= {c: Value(c, parse_timestamp(F.col(c), YEAR_FIRST, strict)) for c in times}
    sifted = _sift(stg_orders, "orders", values, {"no order_id": _missing("order_id")}, strict)
    sifted = _with_parent(sifted, stg_orders, values, "customer_id", customers, "unknown customer_id", ordered)
    return _split(sifted, stg_orders, values, hold)


def clean_order_items(
    stg_order_items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
    strict: bool = False,
    hold: Hold = _as_is,
    ordered: bool = False,
) -> Cleaned:
    values = {
        "order_id": _trimmed("order_id"),
        "order_item_id": Value("order_item_id", truncated_int(F.col("order_item_id"), strict)),
        "product_id": _trimmed("product_id"),
        "seller_id": _trimmed("seller_id"),
        "shipping_limit_date": Value(
            "shipping_limit_date", parse_timestamp(F.col("shipping_limit_date"), YEAR_FIRST, strict)
        ),
        "price": Value("price", to_decimal(F.col("price"), 10, 2, strict)),
        "freight_value": Value("freight_value", to_decimal(F.col("freight_value"), 10, 2, strict)),
    }
    sifted = _sift(stg_order_items, "order_items", values, {}, strict)
    sifted = _with_parent(sifted, stg_order_items, values, "order_id", orders, "unknown order_id", ordered)
    sifted = _with_parent(sifted, stg_order_items, values, "product_id", products, "unknown product_id", ordered)
    sifted = _with_parent(sifted, stg_order_items, values, "seller_id", sellers, "unknown seller_id", ordered)
    return _split(sifted, stg_order_items, values, hold)


def clean_order_payments(
    stg_order_payments: DataFrame, orders: DataFrame, strict: bool = False, hold: Hold = _as_is, ordered: bool = False
) -> Cleaned:
    values = {
        "order_id": _trimmed("order_id"),
        "payment_sequential": Value("payment_sequential", truncated_int(F.col("payment_sequential"), strict)),
        "payment_type": _trimmed_or_empty("payment_type", F.lower),
        "payment_installments": Value("payment_installments", truncated_int(F.col("payment_installments"), strict)),
        "payment_value": Value("payment_value", to_decimal(F.col("payment_value"), 10, 2, strict)),
    }
    sifted = _sift(stg_order_payments, "order_payments", values, {}, strict)
    sifted = _with_parent(sifted, stg_order_payments, values, "order_id", orders, "unknown order_id", ordered)
    return _split(sifted, stg_order_payments, values, hold)


def clean_order_reviews(
    stg_order_reviews: DataFrame, orders: DataFrame, strict: bool = False, hold: Hold = _as_is, ordered: bool = False
) -> Cleaned:
    score = F.when(F.col("review_score").rlike(WHOLE_NUMBER), F.col("review_score")).try_cast("int")
    values = {
        "review_id": _trimmed_or_empty("review_id"),
        "order_id": _trimmed("order_id"),
        "review_score": Value("review_score", score.try_cast("tinyint")),
        "review_comment_title": Value("review_comment_title", blank_to_null(F.col("review_comment_title"))),
        "review_comment_message": Value("review_comment_message", blank_to_null(F.col("review_comment_message"))),
    }
    times = ["review_creation_date", "review_answer_timestamp"]
    values |= {c: Value(c, parse_timestamp(F.col(c), DAY_FIRST, strict)) for c in times}
    reasons = {"score not 1 to 5": ~F.coalesce(score.between(*SCORES), F.lit(False))}
    sifted = _sift(stg_order_reviews, "order_reviews", values, reasons, strict)
    sifted = _with_parent(sifted, stg_order_reviews, values, "order_id", orders, "unknown order_id", ordered)
    return _split(sifted, stg_order_reviews, values, hold)


def south_west(value: Column) -> Column:
    """The point mirrored into the southern and western hemispheres."""
    return -F.abs(value)


def mirrored_into(value: Column, low: float, high: float) -> Column:
    """The point as it is when inside its box, else with the other sign."""
    return F.when(value.between(low, high), value).otherwise(-value)


def clean_geolocation(
    stg_geolocation: DataFrame, box: Mapping[str, tuple[float, float]] | None = None, hold: Hold = _as_is
) -> Cleaned:
    """Typed location samples without their number.

    Both signs are forced negative. With a ``box`` of expected ranges for
    ``lat`` and ``lng`` only points outside of it change sign, so that
    northern points stay.
    """
    lat_text, lng_text = F.col("geolocation_lat"), F.col("geolocation_lng")
    lat = F.when(lat_text.rlike(DECIMAL_NUMBER), lat_text).try_cast("decimal(10,6)")
    lng = F.when(lng_text.rlike(DECIMAL_NUMBER), lng_text).try_cast("decimal(10,6)")
    lat_fixed = south_west(lat) if box is None else mirrored_into(lat, *box["lat"])
    lng_fixed = south_west(lng) if box is None else mirrored_into(lng, *box["lng"])
    values = {
        "geolocation_zip_code_prefix": _trimmed_or_empty("geolocation_zip_code_prefix"),
        "geolocation_lat": Value("geolocation_lat", lat_fixed.cast("decimal(10,6)")),
        "geolocation_lng": Value("geolocation_lng", lng_fixed.cast("decimal(10,6)")),
        "geolocation_city": Value("geolocation_city", lower_text(F.col("geolocation_city"))),
        "geolocation_state": Value("geolocation_state", upper_text(F.col("geolocation_state"))),
    }
    reasons = {
        "latitude": ~F.coalesce(lat.between(*LATITUDES), F.lit(False)),
        "longitude": ~F.coalesce(lng.between(*LONGITUDES), F.lit(False)),
    }
    return _split(_sift(stg_geolocation, "geolocation", values, reasons), stg_geolocation, values, hold)


REJECTS = "_rejects"


def with_declared_columns(df: DataFrame, table: str) -> DataFrame:
    """Exactly the declared columns in their order; those not there get their declared default, or NULL."""
    spec = TABLES[table]
    values = {c.name: F.expr(spec.defaults.get(c.name, "NULL")).cast(c.spark_type) for c in spec.columns}
    return fill_defaults(df, values).select(*spec.schema.names)


def load_production(
    staging: Mapping[str, DataFrame], folder: str, strict: bool = False, keep_rejects: bool = True
) -> dict[str, DataFrame]:
    """Writes all typed tables to ``folder``, parents first, and returns them read back.

    Every raw table is read once, apart from its keys, and its marked rows are held by a
    reliable checkpoint; its children's keys join the written table. A load
    that is run again replaces what an earlier one wrote. Rejected rows go to
    ``folder/_rejects/<table>``. Customers are not deduplicated here (`keep_last`
    does that as a job of its own): on data with repeat buyers it would also
    take their orders away.
    """
    spark = next(iter(staging.values())).sparkSession
    loaded: dict[str, DataFrame] = {}

    def load(name: str, accepted: DataFrame, rejected: DataFrame | None = None) -> None:
        accepted = with_declared_columns(accepted, name)
        write_table(accepted, folder, name, "overwrite")
        loaded[name] = spark.read.schema(accepted.schema).parquet(f"{folder}/{name}")
        if rejected is not None and keep_rejects:
            write_table(rejected, f"{folder}/{REJECTS}", name, "overwrite")

    load("customers", clean_customers(staging["orders"]))
    load("product_category", clean_category_lookup(staging["products"]))
    mode = {"strict": strict, "hold": checkpointed if keep_rejects else _as_is}
    load("products", *clean_products(staging["products"], loaded["product_category"], **mode))
    load("sellers", *clean_sellers(staging["sellers"], mode["hold"]))
    mode["ordered"] = True
    load("orders", *clean_orders(staging["orders"], loaded["customers"], **mode))
    load(
        "order_items",
        *clean_order_items(staging["order_items"], loaded["orders"], loaded["products"], loaded["sellers"], **mode),
    )
    load("order_payments", *clean_order_payments(staging["order_payments"], loaded["orders"], **mode))
    load("order_reviews", *clean_order_reviews(staging["order_reviews"], loaded["orders"], **mode))
    samples = clean_geolocation(staging["geolocation"], hold=mode["hold"])
    load("geolocation", with_surrogate_key(samples.accepted, "geo_id", held=keep_rejects), samples.rejected)
    return loaded
