import datetime
import itertools
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradewind.plans import aggregates, dictionary, discount, joins, subqueries, windows

D = Decimal


def day(text):
    return datetime.datetime.fromisoformat(text)


def orders(spark, *rows):
    """(order_id, customer_id, time[, status])"""
    data = [(o, c, day(t), *(s or ["delivered"])) for o, c, t, *s in rows]
    return spark.createDataFrame(
        data, "order_id string, customer_id string, order_purchase_timestamp timestamp_ntz, order_status string"
    )


def items(spark, *rows):
    """(order_id, product_id, seller_id, price)"""
    data = [(o, p, s, D(str(v)), D("0")) for o, p, s, v in rows]
    return spark.createDataFrame(
        data, "order_id string, product_id string, seller_id string, price decimal(10,2), freight_value decimal(10,2)"
    )


def products(spark, **category):
    return spark.createDataFrame(list(category.items()), "product_id string, category_name string")


def payments(spark, *rows):
    return spark.createDataFrame([(o, D(str(v))) for o, v in rows], "order_id string, payment_value decimal(10,2)")


def customers(spark, **state):
    data = [(c, c, None, s) for c, s in state.items()]
    return spark.createDataFrame(
        data, "customer_id string, customer_unique_id string, customer_city string, customer_state string"
    )


def test_growth_is_against_the_month_before_with_sales(spark, rows):
    o = orders(
        spark, ("1", "c", "2018-01-05"), ("2", "c", "2018-03-05"), ("3", "c", "2018-04-05"), ("4", "c", "2018-05-05"),
        ("5", "c", "2018-05-06", "canceled"),
    )
    i = items(spark, ("1", "p", "s", 100), ("2", "p", "s", 150), ("3", "p", "s", 0), ("4", "p", "s", 7), ("5", "p", "s", 9))
    assert rows(aggregates.monthly_growth(o, i)) == [
        ("2018-01", 100.0, None, None), ("2018-03", 150.0, 100.0, 50.0), ("2018-04", 0.0, 150.0, -100.0),
        ("2018-05", 7.0, 0.0, None),
    ]


def test_ties_give_more_than_ten_products(spark):
    catalog = products(spark, **{f"p{i:02}": "c" for i in range(12)})
    prices = [100 - i for i in range(9)] + [50, 50, 40]
    i = items(spark, *[("o", f"p{n:02}", "s", v) for n, v in enumerate(prices)])
    top = aggregates.top_products_per_category(i, catalog).collect()
    assert len(top) == 11 and [r.rnk for r in top][-2:] == [10, 10]


def test_second_place_after_a_tie(spark, rows):
    catalog = products(spark, a="c", b="c", d="c", e="x")
    i = items(spark, ("o", "a", "s", 9), ("o", "b", "s", 9), ("o", "d", "s", 5), ("o", "e", "s", 1))
    assert rows(subqueries.nth_product_per_category(i, catalog)) == [("c", "d", 5.0)]
    assert rows(subqueries.nth_product_per_category(i, catalog, dense=False)) == []


def test_tier_limits(spark, rows):
    values = {"a": "299.99", "b": "300", "c": "999.99", "d": "1000"}
    o = orders(spark, *[(c, c, "2018-01-01") for c in values])
    got = aggregates.lifetime_value_tiers(customers(spark, **dict.fromkeys([*values, "none"], "SP")), o, payments(spark, *values.items()))
    assert rows(got, "customer_id", "clv_tier") == [("a", "Bronze"), ("b", "Silver"), ("c", "Silver"), ("d", "Gold")]


def test_rollup_levels_add_up(spark):
    days = ["2017-12-31", "2018-01-01", "2018-01-07", "2018-01-08", "2018-01-31", "2018-02-01"]
    o = orders(spark, *[(str(n), "c", d) for n, d in enumerate(days)])
    i = items(spark, *[(str(n), "p", "s", n + 1) for n in range(len(days))])
    got = aggregates.sales_rollup(o, i, "2018-01-01", "2018-02-01").collect()
    per_level = {lv: sum(r.revenue for r in got if r.level == lv) for lv in range(4)}
    assert set(per_level.values()) == {D("14.00")}
    assert {r.sales_week for r in got if r.level == 1} == {201801, 201802, 201805}
    assert [r.sales_month for r in got if r.level == 3] == [None]


def test_best_category_pools_the_years_and_keeps_ties(spark, rows):
    catalog = products(spark, a="x", b="y")
    o = orders(spark, ("1", "c", "2017-05-01"), ("2", "c", "2018-05-09"), ("3", "c", "2018-06-01"))
    i = items(spark, ("1", "a", "s", 5), ("2", "b", "s", 5), ("3", "a", "s", 1), ("3", "b", "s", 2))
    assert rows(aggregates.top_category_per_month(o, i, catalog)) == [(5, "x", 5.0), (5, "y", 5.0), (6, "y", 2.0)]


def people(spark, *rows):
    return spark.createDataFrame(
        list(rows), "customer_unique_id string, customer_id string, customer_city string, customer_state string"
    )


def test_conflicts_with_unknown_attributes(spark, rows):
    df = people(
        spark,
        ("u1", "a", None, "SP"), ("u1", "b", "rio", "RJ"),
        ("u2", "a", None, None), ("u2", "b", "rio", "RJ"),
        ("u3", "a", "rio", "RJ"), ("u3", "b", "rio", "RJ"),
        ("u4", "a", None, "SP"), ("u4", "b", None, "RJ"),
        (None, "a", "x", "SP"), (None, "b", "y", "RJ"),
    )
    got = rows(joins.conflicting_identities(df), "customer_unique_id", "customer_id_a", "customer_id_b")
    assert got == [("u1", "a", "b"), ("u4", "a", "b")]


def test_conflicts_equal_the_pairwise_definition(spark, rows):
    pick = random.Random(3)
    data = [
        (pick.choice("uvw"), f"c{n:03}", pick.choice(["x", "y", None]), pick.choice(["SP", "RJ", None])) for n in range(60)
    ]
    differ = lambda x, y: x is not None and y is not None and x != y
    expected = sorted(
        (a[0], a[1], b[1])
        for a, b in itertools.permutations(data, 2)
        if a[0] == b[0] and a[1] < b[1] and (differ(a[2], b[2]) or differ(a[3], b[3]))
    )
    got = joins.conflicting_identities(people(spark, *data))
    assert rows(got, "customer_unique_id", "customer_id_a", "customer_id_b") == expected
    assert got.columns == [
        "customer_unique_id", "customer_id_a", "city_a", "state_a", "customer_id_b", "city_b", "state_b"
    ]


def test_agreeing_copies_are_not_paired(spark):
    """A million copies of one identity would be half a trillion pairs."""
    copies = spark.range(1_000_000).select(
        F.lit("u").alias("customer_unique_id"), F.format_string("c%07d", "id").alias("customer_id"),
        F.lit("rio").alias("customer_city"), F.lit("RJ").alias("customer_state"),
    )
    odd = people(spark, ("u", "c0000002x", "sao paulo", "RJ"))
    got = joins.conflicting_identities(copies.unionByName(odd))
    assert got.count() == 1_000_000


def test_orphans_count_null_keys(spark, rows):
    i = items(spark, ("1", "p", "s", 1), ("2", "p", "s", 1), ("2", "q", "s", 1), (None, "p", "s", 1))
    o = orders(spark, ("1", "c", "2018-01-01"))
    got = joins.orphans(i, {"order": ("order_id", o, "order_id"), "product": ("product_id", products(spark, p="x"), "product_id")})
    assert rows(got) == [("order", 3), ("product", 1)]


def test_never_ordered(spark, rows):
    got = joins.never_ordered(customers(spark, a="SP", b=None), orders(spark, ("1", "a", "2018-01-01")))
    assert rows(got, "customer_id") == [("b",)]


def test_mismatch_tolerance(spark, rows):
    o = orders(spark, *[(x, "c", "2018-01-01") for x in ("1", "2", "3", "4")])
    i = items(spark, ("1", "p", "s", 10), ("2", "p", "s", 10), ("3", "p", "s", 10))
    p = payments(spark, ("1", "10.01"), ("2", "5.01"), ("2", "5.01"), ("3", "9.98"), ("4", 5))
    assert rows(joins.payment_mismatch(o, p, i), "order_id", "discrepancy") == [("2", 0.02), ("3", -0.02)]
    assert joins.payment_mismatch(o, p, i, n=1).count() == 1


def test_customer_360_equals_the_plain_join(spark, rows):
    pick = random.Random(5)
    o = orders(spark, *[(f"o{n:02}", pick.choice("abz"), f"2018-01-{pick.randrange(1, 20):02}") for n in range(40)])
    i = items(spark, *[(f"o{pick.randrange(40):02}", pick.choice("pqrx"), "s", pick.randrange(1, 9)) for _ in range(90)])
    c = customers(spark, a="SP", b=None)
    p = spark.createDataFrame([("p", 1), ("q", 2), ("r", None)], "product_id string, category_id int")
    k = spark.createDataFrame([(1, "one")], "category_id int, category_name string")
    r = spark.createDataFrame(
        [(f"o{n:02}", n % 5, f"m{n}") for n in range(0, 40, 3)] + [("o03", 9, "again")],
        "order_id string, review_score int, review_comment_message string",
    )
    plain = (
        c.join(o, "customer_id").join(i, "order_id").join(p, "product_id").join(k, "category_id", "left").join(r, "order_id", "left")
    )
    order = [F.col("order_purchase_timestamp").desc(), "order_id", "product_id", "price", "freight_value", "review_score",
             "review_comment_message"]
    for n in (1, 7, 30, 1000):
        got = joins.customer_360(c, o, i, p, k, r, n=n)
        assert rows(got) == rows(plain.orderBy(*order).limit(n).select(*got.columns))


def test_bought_but_never(spark, rows):
    catalog = products(spark, e="eletronicos", b="livros_tecnicos", o="other")
    o = orders(spark, ("1", "a", "2018-01-01"), ("2", "b", "2018-01-01"), ("3", "b", "2018-01-02"), ("4", "d", "2018-01-01"),
               ("5", "gone", "2018-01-01"))
    i = items(spark, ("1", "e", "s", 1), ("1", "o", "s", 1), ("2", "e", "s", 1), ("3", "b", "s", 1), ("4", "o", "s", 1),
              ("5", "e", "s", 1))
    assert rows(joins.bought_but_never(customers(spark, a="x", b="x", d="x"), o, i, catalog)) == [("a",)]


def test_best_product_per_seller_breaks_ties_by_id(spark, rows):
    sellers = spark.createDataFrame([("s",), ("t",)], "seller_id string")
    i = items(spark, ("1", "b", "s", 5), ("1", "a", "s", 5), ("2", "a", "t", 1), ("3", "b", "t", 2), ("4", "b", "none", 2))
    got = joins.best_product_per_seller(sellers, i, products(spark, a="x", b="x"))
    assert rows(got) == [("s", "x", "a", 5.0), ("t", "x", "b", 2.0)]


@pytest.mark.parametrize("seed", range(3))
def test_conflict_classes_are_those_of_the_pairs(spark, seed):
    pick = random.Random(seed)
    data = [(f"c{n}", pick.choice(["u1", "u2", "u3", "u4", None]), pick.choice(["x", "y", None]), pick.choice(["A", None])) for n in range(25)]
    df = spark.createDataFrame(data, "customer_id string, customer_unique_id string, customer_city string, customer_state string")
    pairs = {r["customer_unique_id"] for r in joins.conflicting_identities(df).collect()}
    classes = joins.conflict_classes(df).collect()
    assert {r["customer_unique_id"] for r in classes} == pairs
    members = Counter((u, c, s) for _, u, c, s in data if u in pairs)
    first = {key: min(i for i, *rest in data if tuple(rest) == key) for key in members}
    assert {(r["customer_unique_id"], r["city"], r["state"]): (r["first_id"], r["members"]) for r in classes} == {
        key: (first[key], n) for key, n in members.items()}


def brute_baskets(baskets, n, least=2):
    pairs = Counter(p for b in baskets for p in itertools.combinations(sorted(b), 2))
    ranked = sorted(((-c, *p) for p, c in pairs.items() if c >= least))
    return [(a, b, -c) for c, a, b in ranked[:n]]


@pytest.mark.parametrize("seed", range(6))
def test_market_basket_with_large_baskets(spark, seed):
    """Regular and large baskets in every mixture give the exact top list."""
    pick = random.Random(seed)
    names = [f"p{n:02}" for n in range(14)]
    baskets = [set(pick.sample(names, pick.choice([1, 2, 3, 9, 12]))) for _ in range(12 if seed % 2 else 5)]
    data = [(str(n), p, "s", 1) for n, b in enumerate(baskets) for p in b for _ in range(pick.choice([1, 1, 2]))]
    i = items(spark, *data)
    for n in (3, 10):
        for block, first in ((3, 256), (1000, 4)):
            got = [tuple(r) for r in joins.market_basket(i, n=n, block=block, first=first).collect()]
            assert got == brute_baskets(baskets, n), (n, block, first)


def test_market_basket_does_not_pair_within_a_huge_basket(spark):
    """One basket of 200,000 products would have 20 billion pairs."""
    huge = spark.range(200_000).select(F.lit("huge").alias("order_id"), F.concat(F.lit("p"), "id").alias("product_id"))
    small = spark.createDataFrame([("1", "p1"), ("1", "p2"), ("2", "p1"), ("2", "p2"), ("3", "p7"), ("3", "p5")], huge.schema)
    got = [tuple(r) for r in joins.market_basket(huge.unionByName(small), n=5).collect()]
    assert got == [("p1", "p2", 3), ("p5", "p7", 2)]


def test_market_basket_pairs_only_products_that_can_be_in_the_list(spark):
    """A few products are in most orders; a bound from them spares the pairs of all others, ties at the border included."""
    pick = random.Random(3)
    often, seldom = [f"a{n}" for n in range(12)], [f"z{n:03}" for n in range(400)]
    baskets = [{*pick.sample(often, 5), *pick.sample(seldom, 6)} for _ in range(300)]
    bought = spark.createDataFrame([(n, p) for n, b in enumerate(baskets) for p in b], "order_id long, product_id string")
    products, kept, bound = joins.candidate_products(bought, 2, 20, first=16)
    assert kept == products.count() == 12 and bound == brute_baskets(baskets, 20)[-1][2]
    every = joins.basket_pairs(bought).count()
    assert every == sum(len(b) * (len(b) - 1) // 2 for b in baskets)
    assert joins.basket_pairs(bought.join(products, "product_id", "left_semi")).count() < every / 4
    assert [tuple(r) for r in joins.market_basket(bought, n=20, first=16).collect()] == brute_baskets(baskets, 20)


def test_market_basket_spreads_a_large_order(spark):
    """Two orders of the same 3,000 products: no task makes more than a part of their pairs."""
    wide = spark.range(3_000).crossJoin(spark.range(2).toDF("order_id")).select("order_id", F.col("id").alias("product_id"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = joins.basket_pairs(wide, block=200)
        made = [r["n"] for r in pairs.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sum(made) == 2 * 3000 * 2999 // 2 and len(made) == 4 and max(made) < sum(made) / 2
    got = joins.market_basket(wide.where("product_id < 1000"), n=3, block=100).collect()
    assert [tuple(r) for r in got] == [(0, 1, 2), (0, 2, 2), (0, 3, 2)]


def test_market_basket_with_many_overlapping_baskets(spark):
    pick = random.Random(1)
    names = [f"p{n:03}" for n in range(60)]
    baskets = [set(pick.sample(names, 30)) for _ in range(30)]
    i = items(spark, *[(str(n), p, "s", 1) for n, b in enumerate(baskets) for p in b])
    assert [tuple(r) for r in joins.market_basket(i, n=20, block=7).collect()] == brute_baskets(baskets, 20)


def test_payment_tolerance_finer_than_a_cent(spark):
    o = spark.createDataFrame([("1", "delivered"), ("2", "delivered")], "order_id string, order_status string")
    paid = spark.createDataFrame([("1", D("10.02")), ("2", D("10.01"))], "order_id string, payment_value decimal(10,2)")
    owed = spark.createDataFrame([(k, D("10.00"), D("0.00")) for k in "12"], "order_id string, price decimal(10,2), freight_value decimal(10,2)")
    found = joins.payment_mismatch(o, paid, owed, tolerance=0.015).collect()
    assert [(r["order_id"], float(r["discrepancy"])) for r in found] == [("1", 0.02)]


def test_shipping_delay_of_zero_days(spark, rows):
    o = spark.createDataFrame(
        [
            ("1", "a", day("2018-01-05T08:00"), day("2018-01-05T20:00")),
            ("2", "a", day("2018-01-05T20:00"), day("2018-01-05T08:00")),
            ("3", "a", day("2018-01-05"), None),
            ("4", "b", day("2018-01-01"), day("2018-01-09")),
        ],
        "order_id string, customer_id string, order_estimated_delivery_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz",
    )
    sellers = spark.createDataFrame([("s", "SP"), ("t", None)], "seller_id string, seller_state string")
    i = items(spark, ("1", "p", "s", 1), ("1", "q", "s", 1), ("1", "p", "t", 1), ("2", "p", "s", 1), ("4", "p", "s", 1), ("4", "p", "u", 1))
    got = joins.shipping_delays(o, customers(spark, a="SP", b="RJ"), i, sellers)
    assert [(r.order_id, r.seller_id, r.days_late) for r in got.collect()] == [("4", "s", 8), ("1", "s", 0), ("1", "t", 0)]
    assert [r.order_id for r in joins.shipping_delays(o, customers(spark, a="SP"), i, sellers, n=1).collect()] == ["1"]


def test_no_state_is_a_state(spark, rows):
    o = orders(spark, *[(c, c, "2018-01-01") for c in "abcd"])
    p = payments(spark, ("a", 10), ("b", 20), ("c", 5), ("d", "5.01"))
    c = customers(spark, a=None, b=None, c="SP", d="SP")
    expected = [("b", None, 20.0, 15.0), ("d", "SP", 5.01, 5.005)]
    assert rows(subqueries.above_state_average(c, o, p)) == expected
    assert rows(subqueries.above_state_average_correlated(c, o, p)) == expected
    sellers = spark.createDataFrame([(s, None) for s in "wxyz"], "seller_id string, seller_state string")
    sold = items(spark, ("1", "p", "w", 9), ("1", "p", "x", 8), ("1", "p", "y", 8), ("1", "p", "z", 1))
    assert rows(windows.top_sellers_per_state(sellers, sold), "seller_id", "state_rank") == [("w", 1), ("x", 2), ("y", 2)]


def test_category_tree(spark, rows):
    flat = spark.createDataFrame([(n, f"c{n}") for n in range(1, 6)], "category_id int, category_name string")
    grouped = subqueries.grouped_categories(flat, "group", ["c2", "c4"])
    assert rows(grouped.filter("category_id = 6 or parent_category_id is not null")) == [
        (2, "c2", 6), (4, "c4", 6), (6, "group", None)
    ]
    tree = subqueries.category_tree(grouped)
    assert rows(tree, "category_name", "depth", "path") == [("c2", 1, "group > c2"), ("c4", 1, "group > c4")]


def test_a_cycle_is_reported_not_followed(spark, rows):
    nodes = spark.createDataFrame(
        [(1, "a", None), (2, "b", 1), (3, "c", 4), (4, "d", 3), (5, "e", 99)],
        "category_id int, category_name string, parent_category_id int",
    )
    assert rows(subqueries.category_tree(nodes), "path") == [("a > b",)]
    assert rows(subqueries.unreachable_categories(nodes), "category_id") == [(3,), (4,), (5,)]


def test_a_deep_tree(spark):
    chain = spark.range(1, 1502).select(
        F.col("id").cast("int").alias("category_id"),
        F.col("id").cast("string").alias("category_name"),
        F.when(F.col("id") > 1, F.col("id") - 1).cast("int").alias("parent_category_id"),
    )
    assert subqueries.category_tree(chain).agg(F.max("depth")).first()[0] == 1500


def test_run_across_the_year_end(spark, rows):
    dates = ["2017-11-30", "2017-12-01", "2017-12-31", "2018-01-15", "2018-03-01", "2018-04-01"]
    o = orders(spark, *[(str(n), "a" if n % 2 else "b", d) for n, d in enumerate(dates)])
    c = customers(spark, a="SP", b="SP").withColumn("customer_unique_id", F.lit("u"))
    assert rows(subqueries.consecutive_months(c, o)) == []
    got = subqueries.consecutive_months(c, o, identity="customer_unique_id")
    assert rows(got) == [("u", datetime.date(2017, 11, 1), datetime.date(2018, 1, 1), 3)]


def test_moving_average_is_over_rows(spark):
    dates = ["2018-01-01"] * 3 + ["2018-01-02"] + [f"2018-02-{d:02}" for d in range(1, 8)]
    got = windows.moving_average(orders(spark, *[(str(n), "c", d) for n, d in enumerate(dates)])).collect()
    assert [float(r.moving_avg_7day) for r in got] == [3.0, 2.0, 1.67, 1.5, 1.4, 1.33, 1.29, 1.0, 1.0]


def test_running_total_ends_at_everything(spark):
    o = orders(spark, *[(str(n), "c", f"2018-01-{n:02}") for n in range(1, 4)])
    got = windows.running_revenue(o, items(spark, ("1", "p", "s", 1), ("2", "p", "s", 1), ("3", "p", "s", 1))).collect()
    assert [(float(r.running_total), float(r.pct_of_grand_total)) for r in got] == [(1.0, 33.33), (2.0, 66.67), (3.0, 100.0)]


def many_orders(spark, n=300, seed=2):
    pick = random.Random(seed)
    start = day("2018-01-01")
    data = [
        (f"o{i:03}", pick.choice("hhhhab"), start + datetime.timedelta(hours=12 * pick.randrange(40)), "delivered") for i in range(n)
    ]
    schema = "order_id string, customer_id string, order_purchase_timestamp timestamp_ntz, order_status string"
    return data, spark.createDataFrame(data, schema)


def test_order_gaps(spark, rows):
    data, o = many_orders(spark)
    expected = []
    for _, group in itertools.groupby(sorted(data, key=lambda r: (r[1], r[2], r[0])), key=lambda r: r[1]):
        previous = None
        for oid, cust, ts, _ in group:
            gap = (ts.date() - previous.date()).days if previous else None
            expected.append((cust, oid, ts, previous, gap))
            previous = ts
    assert rows(windows.order_gaps(o)) == sorted(expected, key=lambda t: tuple(map(repr, t)))


def test_discount_counts_prior_orders(spark):
    data, o = many_orders(spark)
    pick = random.Random(8)
    asked = [(pick.choice("hab"), D(pick.choice(["500", "500.01", "99.99"])), pick.choice([*(r[0] for r in data), "new", None]))
             for _ in range(150)]
    requests = spark.createDataFrame(asked, "customer_id string, order_value decimal(10,2), as_of_order_id string")
    times = {r[0]: r[2] for r in data}

    def prior(customer, as_of):
        if as_of is None:
            return 0
        mine = [r for r in data if r[1] == customer and r[0] != as_of]
        return len(mine) if as_of not in times else sum(r[2] < times[as_of] for r in mine)

    got = Counter(tuple(r) for r in discount.prior_orders(requests, o).collect())
    assert got == Counter((*r, prior(r[0], r[2])) for r in asked)


def test_discount_rules(spark):
    o = orders(
        spark, *[(f"a{n}", "a", f"2018-01-0{n}") for n in range(1, 8)], ("b1", "b", "2018-01-03"), ("b2", "b", "2018-01-03")
    )
    asked = [
        ("a", "100", "a1"), ("a", "500", "a5"), ("a", "500", "a6"), ("a", "500.01", "a6"), ("a", "10", None),
        ("a", "33.33", "unknown"), ("b", "10", "b2"), ("nobody", "10", "unknown"), ("b", "10.10", "a4"),
    ]
    requests = spark.createDataFrame([(c, D(v), x) for c, v, x in asked], "customer_id string, order_value decimal(10,2), as_of_order_id string")
    got = {(r.customer_id, str(r.order_value), r.as_of_order_id): (float(r.discount_pct), float(r.discount_amount), float(r.final_amount), r.discount_reason)
           for r in discount.discounts(requests, o).collect()}
    assert got == {
        ("a", "100.00", "a1"): (15, 15.0, 85.0, "NEW_CUSTOMER"),
        ("a", "500.00", "a5"): (0, 0.0, 500.0, "NO_DISCOUNT"),
        ("a", "500.00", "a6"): (5, 25.0, 475.0, "LOYAL_CUSTOMER"),
        ("a", "500.01", "a6"): (10, 50.0, 450.01, "HIGH_VALUE_ORDER"),
        ("a", "10.00", None): (15, 1.5, 8.5, "NEW_CUSTOMER"),
        ("a", "33.33", "unknown"): (5, 1.67, 31.66, "LOYAL_CUSTOMER"),
        ("b", "10.00", "b2"): (15, 1.5, 8.5, "NEW_CUSTOMER"),
        ("nobody", "10.00", "unknown"): (15, 1.5, 8.5, "NEW_CUSTOMER"),
        ("b", "10.10", "a4"): (0, 0.0, 10.1, "NO_DISCOUNT"),
    }


def test_dictionary(spark):
    raw = {"stg_orders": spark.range(1), "stgx": spark.range(1)}
    assert {r.table_name for r in dictionary.column_profile(raw).collect()} == {"stgx"}
    declared = dictionary.declared_dictionary(spark).collect()
    assert len(declared) == 55
    first = declared[0]
    assert (first.table_name, first.column_name, first.column_type, first.is_nullable, first.column_key) == (
        "customers", "customer_id", "char(32)", "NO", "PRI"
    )
    assert dictionary.dictionary_export(spark).columns == ["table", "column", "type", "nullable", "key"]
    frame = customers(spark, a=None, b="SP")
    got = {r.column_name: (r.row_count, r.null_count) for r in dictionary.data_dictionary({"customers": frame}).filter("table_name = 'customers'").collect()}
    assert got["customer_state"] == (2, 1) and got["created_at"] == (None, None)


def test_two_ways_to_write_an_anti_join(spark, rows):
    """LEFT JOIN ... IS NULL, NOT IN and left_anti agree on keys that are not NULL."""
    c, o = customers(spark, a="SP", b="SP", d=None), orders(spark, ("1", "a", "2018-01-01"), ("2", "a", "2018-01-02"))
    outer = c.join(o.select("customer_id", "order_id"), "customer_id", "left").filter("order_id IS NULL")
    not_in = spark.sql("SELECT * FROM {c} WHERE customer_id NOT IN (SELECT customer_id FROM {o})", c=c, o=o)
    assert rows(joins.never_ordered(c, o), "customer_id") == rows(outer, "customer_id") == rows(not_in, "customer_id")
    # A NULL in the list makes NOT IN unknown for every row; the anti join has no such trap.
    with_null = o.select("customer_id").unionByName(spark.createDataFrame([(None,)], "customer_id string"))
    assert spark.sql("SELECT * FROM {c} WHERE customer_id NOT IN (SELECT customer_id FROM {o})", c=c, o=with_null).count() == 0
    assert joins.never_ordered(c, with_null).count() == 2
