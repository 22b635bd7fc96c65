"""Reports over ordered rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import money, percent, sum_cents
from ..functions.times import day
from ..operators.skew import previous_value
from .aggregates import revenue_per

# Rows in the moving average, sellers kept per state.
MOVING_ROWS = 7
TOP_SELLERS = 3


def moving_average(orders: DataFrame, n: int = MOVING_ROWS) -> DataFrame:
    """Orders per day and their mean over the last ``n`` days that have orders."""
    daily = orders.groupBy(day(F.col("order_purchase_timestamp")).alias("order_date")).agg(
        F.count(F.lit(1)).alias("order_count")
    )
    recent = Window.orderBy("order_date").rowsBetween(1 - n, Window.currentRow)
    mean = F.round(F.sum("order_count").over(recent).cast("decimal(20,0)") / F.count("order_count").over(recent), 2)
    return daily.withColumn("moving_avg_7day", mean.cast("decimal(24,2)")).orderBy("order_date")


def order_gaps(orders: DataFrame, identity: str = "customer_id") -> DataFrame:
    """Time of and days since the customer's previous order."""
    times = orders.select(identity, "order_id", "order_purchase_timestamp")
    order = ["order_purchase_timestamp", "order_id"]
    with_previous = previous_value(times, identity, order, "order_purchase_timestamp", "previous_order_ts")
    gap = F.datediff("order_purchase_timestamp", "previous_order_ts").cast("bigint")
    return with_previous.withColumn("days_since_previous_order", gap).orderBy(identity, *order)


def top_sellers_per_state(sellers: DataFrame, order_items: DataFrame, n: int = TOP_SELLERS) -> DataFrame:
    """Sellers among the ``n`` first by revenue in their state; no state is a state too."""
    by_revenue = Window.partitionBy("seller_state").orderBy(F.col("cents").desc())
    return (
        order_items.groupBy("seller_id")
        .agg(sum_cents(F.col("price")).alias("cents"))
        .join(sellers.select("seller_id", "seller_state"), "seller_id")
        .withColumn("state_rank", F.rank().over(by_revenue))
        .filter(F.col("state_rank") <= n)
        .select("seller_id", "seller_state", money(F.col("cents")).alias("revenue"), "state_rank")
        .orderBy("seller_state", "state_rank", "seller_id")
    )


def running_revenue(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Revenue per day, its running total, and that total as a share of everything."""
    daily = revenue_per(day(F.col("order_purchase_timestamp")), "order_date", orders, order_items)
    so_far = Window.orderBy("order_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy("order_date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        daily.withColumn("running", F.sum("cents").over(so_far))
        .withColumn("grand", F.sum("cents").over(everything))
        .select(
            "order_date",
            money(F.col("cents")).alias("revenue"),
            money(F.col("running")).alias("running_total"),
            percent(F.col("running"), F.col("grand")).alias("pct_of_grand_total"),
        )
        .orderBy("order_date")
    )
