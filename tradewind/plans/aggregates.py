"""Grouped reports: growth, rankings, tiers, rollups, seasons.

Sums over order items are first taken per order or per product, before any
join, so that a key with very many items travels as one row per task.
Windows without a partition run on one row per day or month, which the
calendar bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import money, percent, sum_cents
from ..functions.times import day, iso_yearweek, month_label

# Order states that bring no revenue, and the lifetime value
# (in currency units) from which a tier starts.
NO_REVENUE = ("canceled", "unavailable")
GOLD_FROM = 1000
SILVER_FROM = 300


def catalog(products: DataFrame, product_category: DataFrame, how: str = "inner") -> DataFrame:
    """(product_id, category_name) of the products that have a category."""
    return products.join(product_category, "category_id", how).select("product_id", "category_name")


def revenue_per_order(order_items: DataFrame) -> DataFrame:
    return order_items.groupBy("order_id").agg(sum_cents(F.col("price")).alias("cents"))


def revenue_per_product(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """(category_name, product_id, cents): summed per product before the catalog is joined."""
    per_product = order_items.groupBy("product_id").agg(sum_cents(F.col("price")).alias("cents"))
    return per_product.join(products.select("product_id", "category_name"), "product_id")


def revenue_per(period: Column, name: str, orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """(period, cents) of the orders' purchase time."""
    timed = orders.select("order_id", period.alias(name))
    return revenue_per_order(order_items).join(timed, "order_id").groupBy(name).agg(F.sum("cents").alias("cents"))


def monthly_growth(orders: DataFrame, order_items: DataFrame, excluded: Sequence[str] = NO_REVENUE) -> DataFrame:
    """Revenue per month against the month before it that has sales."""
    sold = orders.filter(~F.col("order_status").isin(list(excluded)))
    monthly = revenue_per(month_label(F.col("order_purchase_timestamp")), "revenue_month", sold, order_items)
    by_month = Window.orderBy("revenue_month")
    return (
        monthly.withColumn("previous", F.lag("cents").over(by_month))
        .select(
            "revenue_month",
            money(F.col("cents")).alias("revenue"),
            money(F.col("previous")).alias("prev_month_revenue"),
            percent(F.col("cents") - F.col("previous"), F.col("previous")).alias("mom_growth_pct"),
        )
        .orderBy("revenue_month")
    )


def top_products_per_category(order_items: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """Products whose revenue is among the ``n`` highest values of their category."""
    by_revenue = Window.partitionBy("category_name").orderBy(F.col("cents").desc())
    return (
        revenue_per_product(order_items, products)
        .withColumn("rnk", F.dense_rank().over(by_revenue))
        .filter(F.col("rnk") <= n)
        .select("category_name", "product_id", money(F.col("cents")).alias("product_revenue"), "rnk")
        .orderBy("category_name", "rnk", "product_id")
    )


def payments_per_customer(orders: DataFrame, order_payments: DataFrame) -> DataFrame:
    """(customer_id, cents) paid: summed per order before the orders are joined."""
    paid = order_payments.groupBy("order_id").agg(sum_cents(F.col("payment_value")).alias("cents"))
    return (
        paid.join(orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id")
        .agg(F.sum("cents").alias("cents"))
    )


def lifetime_value_tiers(
    customers: DataFrame,
    orders: DataFrame,
    order_payments: DataFrame,
    gold: float = GOLD_FROM,
    silver: float = SILVER_FROM,
) -> DataFrame:
    value = money(F.col("cents"))
    return (
        payments_per_customer(orders, order_payments)
        .join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .select(
            "customer_id",
            "customer_unique_id",
            value.alias("lifetime_value"),
            F.when(value >= gold, "Gold").when(value >= silver, "Silver").otherwise("Bronze").alias("clv_tier"),
        )
        .orderBy(F.col("lifetime_value").desc(), "customer_id")
    )


def sales_rollup(orders: DataFrame, order_items: DataFrame, start: str, end: str) -> DataFrame:
    """Revenue per day with subtotals per ISO week and month, from ``start`` up to but not including ``end``.

    The range is usually a small part of the orders, so the join that drops
    all other items comes first. Days are summed next; the rollup multiplies
    one row per day only. The level tells subtotals apart: 0 day, 1 week,
    2 month, 3 everything.
    """
    ts = F.col("order_purchase_timestamp")
    first, last = (F.lit(b).cast("timestamp_ntz") for b in (start, end))
    in_range = orders.filter((ts >= first) & (ts < last)).select("order_id", day(ts).alias("sales_day"))
    daily = (
        order_items.select("order_id", "price")
        .join(in_range, "order_id")
        .groupBy("sales_day")
        .agg(sum_cents(F.col("price")).alias("cents"))
    )
    return (
        daily.select(
            month_label(F.col("sales_day")).alias("sales_month"),
            iso_yearweek(F.col("sales_day")).alias("sales_week"),
            "sales_day",
            "cents",
        )
        .rollup("sales_month", "sales_week", "sales_day")
        .agg(F.sum("cents").alias("cents"), F.grouping_id().alias("level"))
        .select(
            "sales_month",
            "sales_week",
            "sales_day",
            money(F.col("cents")).alias("revenue"),
            F.when(F.col("level") == 0, 0).when(F.col("level") == 1, 1).when(F.col("level") == 3, 2).otherwise(3).alias("level"),
        )
        .orderBy("sales_month", "sales_week", "sales_day")
    )


def top_category_per_month(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Best-selling category of each calendar month, all years taken together; ties stay."""
    month = F.month("order_purchase_timestamp")
    monthly = (
        order_items.select("order_id", "product_id", "price")
        .join(orders.select("order_id", month.alias("order_month")), "order_id")
        .groupBy("order_month", "product_id")
        .agg(sum_cents(F.col("price")).alias("cents"))
        .join(products.select("product_id", "category_name"), "product_id")
        .groupBy("order_month", "category_name")
        .agg(F.sum("cents").alias("cents"))
    )
    best = Window.partitionBy("order_month").orderBy(F.col("cents").desc())
    return (
        monthly.withColumn("rnk", F.rank().over(best))
        .filter(F.col("rnk") == 1)
        .select("order_month", "category_name", money(F.col("cents")).alias("revenue"))
        .orderBy("order_month", "category_name")
    )
