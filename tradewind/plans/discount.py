"""Discounts for a table of requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import running_total

# The rules in order of priority (first match wins).
NEW_CUSTOMER = ("NEW_CUSTOMER", "15.00")
HIGH_VALUE_ORDER = ("HIGH_VALUE_ORDER", "10.00")
LOYAL_CUSTOMER = ("LOYAL_CUSTOMER", "5.00")
NO_DISCOUNT = ("NO_DISCOUNT", "0.00")
HIGH_VALUE_ABOVE = 500
LOYAL_FROM = 5


def prior_orders(requests: DataFrame, orders: DataFrame) -> DataFrame:
    """Requests with ``prior``, the customer's orders placed before the as-of order.

    The as-of order is looked up by its id alone. Requests with a known order
    and the orders themselves are laid on one time line per customer and
    counted by a running total, so no request is paired with an order. Without
    such an order all of the customer's orders count, which takes one number
    per customer; without an id none does.
    """
    times = orders.select(
        F.col("order_id").alias("as_of_order_id"), F.col("order_purchase_timestamp").alias("as_of")
    )
    asked = requests.join(times, "as_of_order_id", "left").select(
        F.col("customer_id").alias("person"), "as_of", F.struct(*requests.columns).alias("request")
    )
    dated = asked.filter(F.col("as_of").isNotNull()).select("person", F.col("as_of").alias("ts"), F.lit(0).alias("placed"), "request")
    placed = orders.select(
        F.col("customer_id").alias("person"),
        F.col("order_purchase_timestamp").alias("ts"),
        F.lit(1).alias("placed"),
        F.lit(None).cast(asked.schema["request"].dataType).alias("request"),
    )
    # A request comes before the orders of its own instant: only earlier ones count.
    counted = running_total(dated.unionByName(placed), "person", ["ts", "placed"], "placed", "count")
    known = counted.filter(F.col("request").isNotNull()).select("request.*", F.col("count").cast("bigint").alias("prior"))
    totals = orders.groupBy(F.col("customer_id").alias("_buyer")).agg(F.count(F.lit(1)).alias("_all"))
    everything = F.when(F.col("request.as_of_order_id").isNull(), 0).otherwise(F.coalesce("_all", F.lit(0)))
    undated = (
        asked.filter(F.col("as_of").isNull())
        .join(totals, F.col("person") == F.col("_buyer"), "left")
        .select("request.*", everything.cast("bigint").alias("prior"))
    )
    return known.unionByName(undated)


def discounts(
    requests: DataFrame,
    orders: DataFrame,
    high_value_above: float = HIGH_VALUE_ABOVE,
    loyal_from: int = LOYAL_FROM,
) -> DataFrame:
    """One discount per request (customer_id, order_value, as_of_order_id)."""
    rules = [
        (F.col("prior") == 0, NEW_CUSTOMER),
        (F.col("order_value") > high_value_above, HIGH_VALUE_ORDER),
        (F.col("prior") >= loyal_from, LOYAL_CUSTOMER),
        (F.lit(True), NO_DISCOUNT),
    ]
    reason = F.coalesce(*[F.when(rule, F.lit(name)) for rule, (name, _) in rules])
    pct = F.coalesce(*[F.when(rule, F.lit(p).cast("decimal(5,2)")) for rule, (_, p) in rules])
    amount = F.round(F.col("order_value") * F.col("discount_pct") / 100, 2).cast("decimal(12,2)")
    return (
        prior_orders(requests, orders)
        .withColumns({"discount_pct": pct, "discount_reason": reason})
        .withColumn("discount_amount", amount)
        .withColumn("final_amount", (F.col("order_value") - F.col("discount_amount")).cast("decimal(12,2)"))
        .select(
            *requests.columns, "discount_pct", "discount_amount", "final_amount", "discount_reason"
        )
    )
