"""Reports built on subqueries, ranks, recursion and runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import money, sum_cents
from ..functions.times import month_start
from ..operators.changes import add_nullable_column, update_where_in
from ..session import checkpointed
from .aggregates import payments_per_customer, revenue_per_product

# Row limit of the big-spender list, shortest run of months, the
# group name of the category tree and its members.
TOP_SPENDERS = 100
SHORTEST_RUN = 3
GROUP_NAME = "livros (grupo)"
GROUP_MEMBERS = ("livros_interesse_geral", "livros_tecnicos", "livros_importados")


def spent_per_customer(customers: DataFrame, orders: DataFrame, order_payments: DataFrame) -> DataFrame:
    """(customer_id, customer_state, total_spent) of customers with a payment."""
    return (
        payments_per_customer(orders, order_payments)
        .join(customers.select("customer_id", "customer_state"), "customer_id")
        .select("customer_id", "customer_state", money(F.col("cents")).alias("total_spent"))
    )


def _average(total):
    return F.round(F.avg(total), 6).cast("decimal(32,6)")


def above_state_average(
    customers: DataFrame, orders: DataFrame, order_payments: DataFrame, n: int | None = TOP_SPENDERS
) -> DataFrame:
    """Customers who spent more than the mean of their state; no state is a state too.

    The mean is an aggregate joined back, not a window, so a state with most
    of the customers is combined per task and never gathered.
    """
    totals = spent_per_customer(customers, orders, order_payments)
    means = totals.groupBy(F.col("customer_state").alias("_state")).agg(
        _average("total_spent").alias("avg_spent_in_state")
    )
    above = (
        totals.join(means, F.col("customer_state").eqNullSafe(F.col("_state")))
        .filter(F.col("total_spent") > F.col("avg_spent_in_state"))
        .select("customer_id", "customer_state", "total_spent", "avg_spent_in_state")
        .orderBy(F.col("total_spent").desc(), "customer_id")
    )
    return above if n is None else above.limit(n)


def above_state_average_correlated(
    customers: DataFrame, orders: DataFrame, order_payments: DataFrame, n: int = TOP_SPENDERS
) -> DataFrame:
    """The same report as a correlated subquery, which Spark turns into a join."""
    totals = spent_per_customer(customers, orders, order_payments)
    return totals.sparkSession.sql(
        """
        SELECT * FROM (
            SELECT t.customer_id, t.customer_state, t.total_spent,
                   (SELECT CAST(round(avg(m.total_spent), 6) AS decimal(32,6))
                    FROM {totals} m WHERE m.customer_state <=> t.customer_state) AS avg_spent_in_state
            FROM {totals} t)
        WHERE total_spent > avg_spent_in_state
        ORDER BY total_spent DESC, customer_id
        LIMIT {n}
        """,
        totals=totals,
        n=n,
    )


def nth_product_per_category(order_items: DataFrame, products: DataFrame, n: int = 2, dense: bool = True) -> DataFrame:
    """Products at revenue rank ``n`` of their category.

    With ``dense`` equal revenues take one rank. Without it the rank is one
    more than the number of products that earn more, so after a tie at the top
    there may be no second place.
    """
    by_revenue = Window.partitionBy("category_name").orderBy(F.col("cents").desc())
    rank = F.dense_rank() if dense else F.rank()
    return (
        revenue_per_product(order_items, products)
        .withColumn("rnk", rank.over(by_revenue))
        .filter(F.col("rnk") == n)
        .select("category_name", "product_id", money(F.col("cents")).alias("revenue"))
        .orderBy("category_name", "product_id")
    )


def grouped_categories(
    product_category: DataFrame, group: str = GROUP_NAME, members: Sequence[str] = GROUP_MEMBERS
) -> DataFrame:
    """The lookup with a parent column, one more row for the group, and its members under it."""
    flat = add_nullable_column(product_category, "parent_category_id", "int")
    next_id = product_category.agg((F.max("category_id") + 1).cast("int").alias("category_id"))
    added = next_id.select(
        "category_id", F.lit(group).alias("category_name"), F.lit(None).cast("int").alias("parent_category_id")
    )
    return update_where_in(
        flat.unionByName(added), "parent_category_id", next_id.scalar(), "category_name", members
    )


def category_tree(categories: DataFrame) -> DataFrame:
    """Every category below a root with its depth and path, in path order.

    Starts at the categories without a parent. A cycle has no such start and
    gives no rows; `unreachable_categories` reports it.
    """
    reached = categories.join(_climb(categories, with_path=False).select("category_id"), "category_id", "left_semi")
    return (
        _climb(reached, with_path=True)
        .filter(F.col("depth") > 0)
        .select("category_id", "category_name", "parent_category_id", "depth", "path")
        .orderBy("path")
    )


def unreachable_categories(categories: DataFrame) -> DataFrame:
    """Categories that no root leads to: members of a cycle or below one, or with an unknown parent."""
    return categories.join(_climb(categories, with_path=False).select("category_id"), "category_id", "left_anti")


def _climb(categories: DataFrame, with_path: bool) -> DataFrame:
    """Categories that a root leads to, with their depth and the names on the way.

    Every category first knows its parent; in each round it takes over what the
    category it has reached knows, so the distance doubles and a tree of n
    levels takes log2(n) rounds. A round in which none arrives at a root leaves
    only categories that never will: were a root above one of them, another one
    half as far from it would have arrived.
    """
    path = F.col("category_name") if with_path else F.lit(None).cast("string")
    columns = ["category_id", "category_name", "parent_category_id"]
    known = checkpointed(
        categories.select(
            *columns, F.col("parent_category_id").alias("_up"), (F.col("parent_category_id").isNotNull()).cast("int").alias("depth"), path.alias("path")
        )
    )
    arrived, climbing = known.filter(F.col("_up").isNull()), known.filter(F.col("_up").isNotNull())
    while True:
        above = known.select(
            F.col("category_id").alias("_at"), F.col("_up").alias("_next"), F.col("depth").alias("_depth"), F.col("path").alias("_path")
        )
        moved = climbing.join(above, F.col("_up") == F.col("_at")).select(
            *columns,
            F.col("_next").alias("_up"),
            (F.col("depth") + F.col("_depth")).alias("depth"),
            F.concat_ws(" > ", "_path", "path").alias("path") if with_path else F.col("path"),
        )
        moved = checkpointed(moved)
        there = moved.filter(F.col("_up").isNull())
        if there.isEmpty():
            return arrived
        arrived, climbing = arrived.unionByName(there), moved.filter(F.col("_up").isNotNull())
        known = arrived.unionByName(climbing)


def consecutive_months(
    customers: DataFrame, orders: DataFrame, shortest: int = SHORTEST_RUN, identity: str = "customer_id"
) -> DataFrame:
    """Runs of at least ``shortest`` months in a row with an order.

    Orders are reduced to one row per customer and month before anything is
    gathered per customer. ``identity`` names the customer column to follow.
    """
    month = month_start(F.col("order_purchase_timestamp")).alias("order_month")
    months = orders.select("customer_id", month).distinct()
    if identity == "customer_id":
        months = months.join(customers.select("customer_id"), "customer_id", "left_semi")
    else:
        people = customers.select("customer_id", identity)
        months = months.join(people, "customer_id").select(identity, "order_month").distinct()
    numbered = months.withColumn(
        "rn", F.row_number().over(Window.partitionBy(identity).orderBy("order_month"))
    )
    return (
        numbered.groupBy(identity, F.add_months("order_month", -F.col("rn")).alias("run"))
        .agg(
            F.min("order_month").alias("streak_start"),
            F.max("order_month").alias("streak_end"),
            F.count(F.lit(1)).alias("consecutive_months"),
        )
        .filter(F.col("consecutive_months") >= shortest)
        .drop("run")
        .orderBy(F.col("consecutive_months").desc(), identity, "streak_start")
    )
