"""Table definitions: raw text tables, typed tables and their rules."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# The typed tables, one line per column:
# name, declared type, nullable, key marker, default.
TYPED_COLUMNS = {
    "customers": (
        ("customer_id", "char(32)", False, "PRI", None),
        ("customer_unique_id", "char(32)", False, "MUL", None),
        ("customer_zip_code_prefix", "varchar(10)", True, "", None),
        ("customer_city", "varchar(100)", True, "", None),
        ("customer_state", "char(2)", True, "MUL", None),
        ("created_at", "timestamp", True, "", "CURRENT_TIMESTAMP"),
    ),
    "sellers": (
        ("seller_id", "char(32)", False, "PRI", None),
        ("seller_zip_code_prefix", "varchar(10)", True, "", None),
        ("seller_city", "varchar(100)", True, "", None),
        ("seller_state", "char(2)", True, "MUL", None),
    ),
    "product_category": (
        ("category_id", "int", False, "PRI", None),
        ("category_name", "varchar(100)", False, "UNI", None),
        ("parent_category_id", "int", True, "MUL", None),
    ),
    "products": (
        ("product_id", "char(32)", False, "PRI", None),
        ("category_id", "int", True, "MUL", None),
        ("product_name_length", "int", True, "", None),
        ("product_description_length", "int", True, "", None),
        ("product_photos_qty", "int", True, "", "0"),
        ("product_weight_g", "decimal(10,2)", True, "", None),
        ("product_length_cm", "decimal(10,2)", True, "", None),
        ("product_height_cm", "decimal(10,2)", True, "", None),
        ("product_width_cm", "decimal(10,2)", True, "", None),
    ),
    "orders": (
        ("order_id", "char(32)", False, "PRI", None),
        ("customer_id", "char(32)", False, "MUL", None),
        ("order_status", "varchar(20)", False, "MUL", None),
        ("order_purchase_timestamp", "datetime", False, "MUL", None),
        ("order_approved_at", "datetime", True, "", None),
        ("order_delivered_carrier_date", "datetime", True, "", None),
        ("order_delivered_customer_date", "datetime", True, "", None),
        ("order_estimated_delivery_date", "datetime", False, "", None),
    ),
    "order_items": (
        ("order_id", "char(32)", False, "PRI", None),
        ("order_item_id", "int", False, "PRI", None),
        ("product_id", "char(32)", False, "MUL", None),
        ("seller_id", "char(32)", False, "MUL", None),
        ("shipping_limit_date", "datetime", True, "", None),
        ("price", "decimal(10,2)", False, "MUL", None),
        ("freight_value", "decimal(10,2)", False, "", "0"),
    ),
    "order_payments": (
        ("order_id", "char(32)", False, "PRI", None),
        ("payment_sequential", "int", False, "PRI", None),
        ("payment_type", "varchar(20)", False, "MUL", None),
        ("payment_installments", "int", False, "", "1"),
        ("payment_value", "decimal(10,2)", False, "", None),
    ),
    "order_reviews": (
        ("review_id", "char(32)", False, "PRI", None),
        ("order_id", "char(32)", False, "PRI", None),
        ("review_score", "tinyint", False, "MUL", None),
        ("review_comment_title", "varchar(255)", True, "", None),
        ("review_comment_message", "text", True, "", None),
        ("review_creation_date", "datetime", True, "MUL", None),
        ("review_answer_timestamp", "datetime", True, "", None),
    ),
    "geolocation": (
        ("geo_id", "bigint", False, "PRI", None),
        ("geolocation_zip_code_prefix", "varchar(10)", False, "MUL", None),
        ("geolocation_lat", "decimal(10,6)", True, "", None),
        ("geolocation_lng", "decimal(10,6)", True, "", None),
        ("geolocation_city", "varchar(100)", True, "MUL", None),
        ("geolocation_state", "char(2)", True, "MUL", None),
    ),
}

# Columns of the raw files in file order, all text. The spelling
# `lenght` is the files' own.
RAW_COLUMNS = {
    "customers": (
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ),
    "orders": (
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    "order_items": (
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ),
    "products": (
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ),
    "sellers": (
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
    ),
    "order_payments": (
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ),
    "order_reviews": (
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ),
    "geolocation": (
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ),
}

# Order status codes.
ORDER_STATUSES = (
    "created", "approved", "processing", "shipped", "delivered", "invoiced", "canceled", "unavailable",
)

# Row rules. A rule that is unknown (NULL) passes.
CHECKS = {
    "customers": {"chk_cust_state": "char_length(customer_state) = 2"},
    "sellers": {"chk_seller_state": "char_length(seller_state) = 2"},
    "products": {"chk_product_weight": "product_weight_g >= 0"},
    "orders": {"chk_order_status": "order_status IN ({})".format(", ".join(f"'{s}'" for s in ORDER_STATUSES))},
    "order_items": {"chk_price_positive": "price >= 0", "chk_freight_nonneg": "freight_value >= 0"},
    "order_payments": {"chk_payment_value": "payment_value >= 0", "chk_installments": "payment_installments >= 0"},
    "order_reviews": {"chk_review_score": "review_score BETWEEN 1 AND 5"},
}

# References: column, parent table, parent column, and what a
# delete of the parent does to the child.
REFERENCES = {
    "product_category": [("parent_category_id", "product_category", "category_id", "restrict")],
    "products": [("category_id", "product_category", "category_id", "set_null")],
    "orders": [("customer_id", "customers", "customer_id", "restrict")],
    "order_items": [
        ("order_id", "orders", "order_id", "cascade"),
        ("product_id", "products", "product_id", "restrict"),
        ("seller_id", "sellers", "seller_id", "restrict"),
    ],
    "order_payments": [("order_id", "orders", "order_id", "cascade")],
    "order_reviews": [("order_id", "orders", "order_id", "cascade")],
}

# Business meaning of each table, as the dictionary reports it.
MEANINGS = {
    "customers": "Customer identity used on an order (see DQ report #1 for unique_id caveat)",
    "sellers": "Marketplace seller who fulfills order_items",
    "product_category": "Normalized product category lookup (3NF)",
    "products": "Product catalog with physical dimensions for freight calc",
    "orders": "One row per customer order, with full delivery lifecycle timestamps",
    "order_items": "Line items within an order; one row per product/seller combo",
    "order_payments": "One or more payment transactions applied to an order",
    "order_reviews": "Customer review/rating left for a delivered order",
    "geolocation": "Zip-prefix level lat/lng samples for Brazil (corrected sign, see DQ report #3)",
}


@dataclass(frozen=True)
class ColumnDef:
    name: str
    declared: str
    nullable: bool
    key: str
    default: str | None

    @property
    def spark_type(self) -> T.DataType:
        return spark_type(self.declared)

    @property
    def max_length(self) -> int | None:
        sized = re.fullmatch(r"(?:var)?char\((\d+)\)", self.declared)
        return int(sized.group(1)) if sized else None


def spark_type(declared: str) -> T.DataType:
    """Spark type of a declared SQL type."""
    if declared == "text" or "char" in declared:
        return T.StringType()
    if declared.startswith("decimal"):
        precision, scale = re.findall(r"\d+", declared)
        return T.DecimalType(int(precision), int(scale))
    simple = {
        "int": T.IntegerType(),
        "bigint": T.LongType(),
        "tinyint": T.ByteType(),
        "datetime": T.TimestampNTZType(),
        "timestamp": T.TimestampType(),
    }
    return simple[declared]


@dataclass(frozen=True)
class TableDef:
    name: str
    columns: tuple[ColumnDef, ...]

    @property
    def primary_key(self) -> list[str]:
        return [c.name for c in self.columns if c.key == "PRI"]

    @property
    def unique(self) -> list[str]:
        return [c.name for c in self.columns if c.key == "UNI"]

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]

    @property
    def lengths(self) -> dict[str, int]:
        return {c.name: c.max_length for c in self.columns if c.max_length is not None}

    @property
    def checks(self) -> dict[str, str]:
        return CHECKS.get(self.name, {})

    @property
    def references(self) -> list[tuple[str, str, str, str]]:
        return REFERENCES.get(self.name, [])

    @property
    def defaults(self) -> dict[str, str]:
        return {c.name: c.default for c in self.columns if c.default is not None}

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type, c.nullable) for c in self.columns])


TABLES = {
    name: TableDef(name, tuple(ColumnDef(*column) for column in columns)) for name, columns in TYPED_COLUMNS.items()
}


def raw_schema(table: str) -> T.StructType:
    """All-text schema of a raw file."""
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[table]])
