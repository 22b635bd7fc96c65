"""Reports that are mostly joins."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import cents, money, sum_cents
from ..session import checkpointed

# Categories of the never-bought report, the tolerance of the
# payment check in currency units, and the row limits of the top lists.
BOUGHT = ("eletronicos",)
NEVER = ("livros_interesse_geral", "livros_tecnicos", "livros_importados")
TOLERANCE = 0.01
TOP_MISMATCHES = 50
TOP_PAIRS = 50
TOP_DELAYS = 50
LATEST_ROWS = 100
MIN_SUPPORT = 2

# Products of a basket that meet in one block, products that the first bound of
# the pair counts comes from, and the most that are broadcast (their ids only).
BASKET_BLOCK = 1000
FIRST_PRODUCTS = 256
BROADCAST_PRODUCTS = 200_000


def conflicting_identities(
    customers: DataFrame,
    identity: Sequence[str] = ("customer_unique_id",),
    id_column: str = "customer_id",
    attributes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Pairs a < b of one identity that differ in any attribute.

    A comparison with a NULL is unknown and does not count. The identity's
    distinct attribute values are compared first, and rows are matched only
    between values that differ, so copies that agree are never paired with one
    another. The pairs of rows that differ are the result, however many.
    """
    attributes = attributes or {"customer_city": "city", "customer_state": "state"}
    keys, shorts = list(identity), list(attributes.values())
    rows = customers.select(*keys, id_column, *[F.col(c).alias(short) for c, short in attributes.items()])

    def suffixed(df: DataFrame, columns: Sequence[str], mark: str) -> DataFrame:
        return df.withColumnsRenamed({c: f"{c}{mark}" for c in columns})

    def differ(left: str, right: str) -> Column:
        return reduce(lambda x, y: x | y, [F.col(f"{c}{left}") != F.col(f"{c}{right}") for c in shorts])

    ascending = F.col(f"{id_column}_a") < F.col(f"{id_column}_b")
    result = [*keys, *[f"{c}_{s}" for s in "ab" for c in (id_column, *shorts)]]
    values = rows.select(*keys, *shorts).distinct()
    conflicts = suffixed(values, shorts, "_left").join(suffixed(values, shorts, "_right"), keys)
    conflicts = conflicts.filter(differ("_left", "_right"))

    def members(found: DataFrame, side: str, mark: str) -> DataFrame:
        named = suffixed(rows, [*keys, id_column, *shorts], mark)
        same = [F.col(k) == F.col(f"{k}{mark}") for k in keys]
        same += [F.col(f"{c}{side}").eqNullSafe(F.col(f"{c}{mark}")) for c in shorts]
        return found.join(named, same).drop(*[f"{k}{mark}" for k in keys])

    return (
        members(members(conflicts, "_left", "_a"), "_right", "_b")
        .filter(ascending)
        .select(*result)
    )


def conflict_classes(
    customers: DataFrame,
    identity: Sequence[str] = ("customer_unique_id",),
    id_column: str = "customer_id",
    attributes: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row for each different set of attribute values of an identity that has conflicting ones: the identity, the
    values, ``first_id`` and ``members``.

    What `conflicting_identities` lists in pairs, in as many rows as there are
    different values: an identity with very many rows is added up in every task
    and joined with nothing but its own classes. An identity conflicts when an
    attribute has two values that are not NULL.
    """
    attributes = attributes or {"customer_city": "city", "customer_state": "state"}
    keys, shorts = list(identity), list(attributes.values())
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    classes = (
        customers.filter(known)
        .groupBy(*keys, *[F.col(c).alias(short) for c, short in attributes.items()])
        .agg(F.min(id_column).alias("first_id"), F.count(id_column).alias("members"))
    )
    several = [F.min(c).alias(f"_least_{c}") for c in shorts] + [F.max(c).alias(f"_most_{c}") for c in shorts]
    conflict = reduce(lambda a, b: a | b, [F.col(f"_least_{c}") < F.col(f"_most_{c}") for c in shorts])
    conflicting = classes.groupBy(*keys).agg(*several).filter(conflict).select(*keys)
    return classes.join(conflicting, keys, "left_semi").select(*keys, *shorts, "first_id", "members")


def orphans(
    order_items: DataFrame, parents: Mapping[str, tuple[str, DataFrame, str]]
) -> DataFrame:
    """(issue, cnt) of item rows without a parent; a NULL key is one too.

    ``parents`` maps an issue to (item column, parent, parent column). Items
    are counted per key before the join.
    """
    found = []
    for issue, (column, parent, parent_column) in parents.items():
        per_key = order_items.groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
        known = parent.select(F.col(parent_column).alias("_known"))
        found.append(
            per_key.join(known, F.col(column) == F.col("_known"), "left_anti")
            .agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("cnt"))
            .select(F.lit(issue).alias("issue"), "cnt")
        )
    return reduce(DataFrame.unionByName, found)


def never_ordered(customers: DataFrame, orders: DataFrame) -> DataFrame:
    columns = ["customer_id", "customer_unique_id", "customer_city", "customer_state"]
    buyers = orders.select("customer_id").distinct()
    return customers.select(*columns).join(buyers, "customer_id", "left_anti")


def payment_mismatch(
    orders: DataFrame,
    order_payments: DataFrame,
    order_items: DataFrame,
    tolerance: float = TOLERANCE,
    n: int | None = TOP_MISMATCHES,
) -> DataFrame:
    """Orders whose payments differ from items plus freight by more than ``tolerance``."""
    paid = order_payments.groupBy("order_id").agg(sum_cents(F.col("payment_value")).alias("paid"))
    owed = order_items.groupBy("order_id").agg(
        F.sum(cents(F.col("price")) + cents(F.col("freight_value"))).alias("owed")
    )
    gap = F.col("paid") - F.col("owed")
    found = (
        paid.join(owed, "order_id")
        .filter(F.abs(gap) > F.lit(Decimal(str(tolerance)) * 100))
        .join(orders.select("order_id", "order_status"), "order_id")
        .orderBy(F.abs(gap).desc(), "order_id")
    )
    return (found if n is None else found.limit(n)).select(
        "order_id",
        "order_status",
        money(F.col("paid")).alias("total_paid"),
        money(F.col("owed")).alias("total_order_value"),
        money(gap).alias("discrepancy"),
    )


def customer_360(
    customers: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    product_category: DataFrame,
    order_reviews: DataFrame,
    n: int = LATEST_ROWS,
) -> DataFrame:
    """The ``n`` latest item rows with customer, product, category and review.

    Each order that keeps any row gives at least one, so the rows asked for
    lie in the ``n`` latest such orders. These are found on keys and times
    alone and checkpointed; only their rows then meet the wide columns, and
    review texts never move.
    """
    sellable = order_items.join(products.select("product_id"), "product_id", "left_semi").select("order_id").distinct()
    latest = checkpointed(
        orders.join(customers.select("customer_id"), "customer_id", "left_semi")
        .join(sellable, "order_id", "left_semi")
        .select("order_id", "customer_id", "order_status", "order_purchase_timestamp")
        .orderBy(F.col("order_purchase_timestamp").desc(), "order_id")
        .limit(n)
    )
    items = order_items.join(latest, "order_id")
    reviews = order_reviews.join(latest.select("order_id"), "order_id", "left_semi")
    return (
        items.join(customers.select("customer_id", "customer_state"), "customer_id")
        .join(products.select("product_id", "category_id"), "product_id")
        .join(product_category.select("category_id", "category_name"), "category_id", "left")
        .join(reviews.select("order_id", "review_score", "review_comment_message"), "order_id", "left")
        .select(
            "customer_id",
            "customer_state",
            "order_id",
            "order_status",
            "order_purchase_timestamp",
            "product_id",
            "category_name",
            "price",
            "freight_value",
            "review_score",
            "review_comment_message",
        )
        .orderBy(
            F.col("order_purchase_timestamp").desc(),
            "order_id", "product_id", "price", "freight_value", "review_score", "review_comment_message",
        )
        .limit(n)
    )


def bought_but_never(
    customers: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    bought: Sequence[str] = BOUGHT,
    never: Sequence[str] = NEVER,
) -> DataFrame:
    """Customers with an item of a ``bought`` category and none of a ``never`` category.

    Both conditions are flags gathered in one pass over the items: per order
    first, then per customer.
    """
    wanted = F.col("category_name").isin(list(bought))
    unwanted = F.col("category_name").isin(list(never))
    marked = products.filter(wanted | unwanted).select(
        "product_id", wanted.cast("int").alias("wanted"), unwanted.cast("int").alias("unwanted")
    )
    flags = [F.max("wanted").alias("wanted"), F.max("unwanted").alias("unwanted")]
    per_order = order_items.select("order_id", "product_id").join(marked, "product_id").groupBy("order_id").agg(*flags)
    return (
        per_order.join(orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id")
        .agg(*flags)
        .filter((F.col("wanted") == 1) & (F.col("unwanted") == 0))
        .join(customers.select("customer_id"), "customer_id", "left_semi")
        .select("customer_id")
    )


def best_product_per_seller(sellers: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Highest-revenue product of each seller and category; ties go to the lower product id."""
    best = Window.partitionBy("seller_id", "category_name").orderBy(F.col("cents").desc(), "product_id")
    return (
        order_items.groupBy("seller_id", "product_id")
        .agg(sum_cents(F.col("price")).alias("cents"))
        .join(products.select("product_id", "category_name"), "product_id")
        .join(sellers.select("seller_id"), "seller_id", "left_semi")
        .withColumn("rn", F.row_number().over(best))
        .filter(F.col("rn") == 1)
        .select("seller_id", "category_name", "product_id", money(F.col("cents")).alias("revenue"))
        .orderBy("seller_id", "category_name")
    )


def _most_frequent(pairs: DataFrame, min_support: int, n: int) -> DataFrame:
    return (
        pairs.withColumnRenamed("orders", "times_bought_together")
        .filter(F.col("times_bought_together") >= min_support)
        .orderBy(F.col("times_bought_together").desc(), "product_a", "product_b")
        .limit(n)
    )


def basket_pairs(bought: DataFrame, block: int = BASKET_BLOCK, longest: int | None = None) -> DataFrame:
    """(product_a, product_b) of every two products of an order, once for each order; (order_id, product_id) may repeat.

    Orders of up to ``block`` rows are paired as they stand. The products of
    larger ones, where there are any, are dealt to blocks of about ``block``,
    and each block meets each other one (and itself) under a key of its own, so
    such an order is spread over many tasks. ``longest``: the products that an
    order can have at most, if known.
    """
    if longest is not None and longest <= block:
        return _pairs_within(bought)
    size = bought.groupBy("order_id").agg(F.count(F.lit(1)).alias("_size")).filter(F.col("_size") > block)
    size = checkpointed(size)
    if size.isEmpty():
        return _pairs_within(bought)
    regular = _pairs_within(bought.join(size.select("order_id"), "order_id", "left_anti"))
    last = F.floor((F.col("_size") - 1) / block)
    dealt = bought.join(size, "order_id").distinct().withColumn("_last", last)
    dealt = dealt.withColumn("_block", F.pmod(F.xxhash64("product_id"), F.col("_last") + 1))
    low = dealt.select(
        "order_id", F.col("product_id").alias("_one"), F.col("_block").alias("_low"), F.explode(F.sequence("_block", "_last")).alias("_high")
    )
    high = dealt.select(
        "order_id", F.col("product_id").alias("_two"), F.explode(F.sequence(F.lit(0).cast("bigint"), "_block")).alias("_low"),
        F.col("_block").alias("_high"),
    )
    large = low.join(high, ["order_id", "_low", "_high"]).filter((F.col("_low") < F.col("_high")) | (F.col("_one") < F.col("_two")))
    return regular.union(large.select(F.least("_one", "_two"), F.greatest("_one", "_two")))


def _pairs_within(bought: DataFrame) -> DataFrame:
    """Pairs of orders whose products fit a row."""
    baskets = bought.groupBy("order_id").agg(F.array_sort(F.collect_set("product_id")).alias("_basket"))
    placed = baskets.filter(F.size("_basket") > 1).select("_basket", F.posexplode("_basket").alias("_place", "product_a"))
    rest = F.slice("_basket", F.col("_place") + 2, F.size("_basket"))
    return placed.select("product_a", F.explode(rest).alias("product_b"))


def pair_counts(bought: DataFrame, block: int = BASKET_BLOCK, longest: int | None = None) -> DataFrame:
    return basket_pairs(bought, block, longest).groupBy("product_a", "product_b").agg(F.count(F.lit(1)).alias("orders"))


def candidate_products(
    bought: DataFrame, min_support: int, n: int, block: int = BASKET_BLOCK, first: int = FIRST_PRODUCTS
) -> tuple[DataFrame, int, int]:
    """(products, how many, bound): all that can be in one of the ``n`` most frequent pairs, which have ``bound`` orders at least.

    A pair has no more orders than either product has rows. The n-th best pair
    among the ``first`` most frequent products is a bound for the n-th best of
    all, and products with fewer rows go. Where that leaves less than half, the
    bound is raised with eight times as many products, until it stands still.
    The search is spared where the most frequent products, bought
    independently, would meet less than once.
    """
    rows = F.count(F.lit(1)).alias("_rows")
    several = F.min("order_id") < F.max("order_id") if min_support > 1 else F.lit(True)
    frequency = checkpointed(
        bought.groupBy("product_id").agg(rows, several.alias("_several")).filter("_several").filter(F.col("_rows") >= min_support)
    )
    often = frequency.orderBy(F.col("_rows").desc()).limit(math.isqrt(2 * n) + 1).agg(F.min("_rows")).scalar()
    kept, total, often = frequency.agg(F.count(F.lit(1)), F.sum("_rows"), F.max(often)).first()
    bound = min_support
    if not kept or often * often < total:
        return frequency.select("product_id"), kept, bound
    while kept > first:
        most = frequency.orderBy(F.col("_rows").desc(), "product_id").limit(first).select("product_id")
        found = pair_counts(bought.join(F.broadcast(most), "product_id", "left_semi"), block, first)
        best = found.filter(F.col("orders") > bound).orderBy(F.col("orders").desc()).limit(n)
        seen = best.agg(F.count(F.lit(1)).alias("n"), F.min("orders").alias("least")).first()
        if seen["n"] < n:
            break
        bound, before = seen["least"], kept
        kept = frequency.filter(F.col("_rows") >= bound).count()
        if 2 * kept > before:
            break
        first *= 8
    return frequency.filter(F.col("_rows") >= bound).select("product_id"), kept, bound


def market_basket(
    order_items: DataFrame,
    min_support: int = MIN_SUPPORT,
    n: int = TOP_PAIRS,
    block: int = BASKET_BLOCK,
    first: int = FIRST_PRODUCTS,
) -> DataFrame:
    """The ``n`` pairs of products found together in the most orders, ties by product.

    Only products that `candidate_products` leaves are paired. No order is bound
    to one task; a table laid out by order is paired without moving its rows.
    """
    bought = order_items.select("order_id", "product_id").dropna()
    products, kept, bound = candidate_products(bought, min_support, n, block, first)
    known = F.broadcast(products) if kept <= BROADCAST_PRODUCTS else products
    return _most_frequent(pair_counts(bought.join(known, "product_id", "left_semi"), block, kept), bound, n)


def shipping_delays(
    orders: DataFrame,
    customers: DataFrame,
    order_items: DataFrame,
    sellers: DataFrame,
    n: int = TOP_DELAYS,
) -> DataFrame:
    """The ``n`` latest (order, seller) deliveries behind their estimate.

    Late is decided on the timestamp, days on the calendar, so 0 days is
    possible. As in `customer_360` the ``n`` latest orders that keep a row are
    found on keys first.
    """
    done, due = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    late = orders.filter(done > due).select(
        "order_id",
        "customer_id",
        "order_estimated_delivery_date",
        "order_delivered_customer_date",
        F.datediff(done, due).cast("bigint").alias("days_late"),
    )
    # Late orders are few: their items are looked up first, and only those meet the sellers.
    late = late.join(customers.select("customer_id"), "customer_id", "left_semi")
    sold = order_items.select("order_id", "seller_id").join(late.select("order_id"), "order_id", "left_semi").distinct()
    sold = sold.join(sellers.select("seller_id"), "seller_id", "left_semi")
    worst = (
        late.join(sold.select("order_id").distinct(), "order_id", "left_semi")
        .orderBy(F.col("days_late").desc(), "order_id")
        .limit(n)
    )
    return (
        sold.join(worst, "order_id")
        .distinct()
        .join(customers.select("customer_id", "customer_state"), "customer_id")
        .join(sellers.select("seller_id", "seller_state"), "seller_id")
        .select(
            "order_id",
            "customer_id",
            "customer_state",
            "seller_id",
            "seller_state",
            "order_estimated_delivery_date",
            "order_delivered_customer_date",
            "days_late",
        )
        .orderBy(F.col("days_late").desc(), "order_id", "seller_id")
        .limit(n)
    )
