import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradewind.plans import cleaning, quality
from tradewind.schemas import RAW_COLUMNS, TABLES
from tradewind.session import checkpointed

TS = "2018-03-05 14:07:00"


def raw(spark, table, *rows):
    """A raw table; rows are dicts, columns they leave out are NULL."""
    names = RAW_COLUMNS[table]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"{n} string" for n in names))


def reasons(cleaned):
    return {r.reject_reason: r["count"] for r in cleaned.rejected.groupBy("reject_reason").count().collect()}


def test_customers_are_the_distinct_order_customers(spark, rows):
    orders = raw(spark, "orders", {"customer_id": "a"}, {"customer_id": " a "}, {"customer_id": "  "}, {})
    assert rows(cleaning.clean_customers(orders), "customer_id", "customer_unique_id", "customer_city") == [("a", "a", None)]


def test_categories_differing_in_case_or_accents_are_one(spark, rows):
    stg = raw(
        spark,
        "products",
        *[{"product_id": f"p{i}", "product_category_name": c} for i, c in enumerate(["São", "sao ", " SAO", "", None, "bebes"])],
    )
    lookup = cleaning.clean_category_lookup(stg)
    assert rows(lookup) == [(1, "bebes"), (2, "sao"), (3, "unknown")]
    products = cleaning.clean_products(stg, lookup)
    assert rows(products.accepted, "product_id", "category_id") == [
        ("p0", 2), ("p1", 2), ("p2", 2), ("p3", 3), ("p4", 3), ("p5", 1)
    ]


def test_products(spark, rows):
    stg = raw(
        spark,
        "products",
        {"product_id": " p1 ", "product_name_lenght": "3.5", "product_weight_g": "10.255", "product_photos_qty": ""},
        {"product_id": "p2", "product_weight_g": "heavy"},
        {"product_id": " "},
    )
    lookup = cleaning.clean_category_lookup(stg)
    cleaned = cleaning.clean_products(stg, lookup)
    got = rows(cleaned.accepted, "product_id", "product_name_length", "product_photos_qty", "product_weight_g", "product_length_cm")
    assert got == [("p1", 4, 0, 10.26, None)]
    assert reasons(cleaned) == {"unreadable product_weight_g": 1, "no product_id": 1}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cleaning.clean_products(stg, lookup, strict=True).accepted.collect()


def test_products_without_their_category_are_rejected(spark, rows):
    stg = raw(spark, "products", *[{"product_id": f"p{i}", "product_category_name": c} for i, c in enumerate("abcb")])
    lookup = cleaning.clean_category_lookup(stg).filter("category_name <> 'b'")
    cleaned = cleaning.clean_products(stg, lookup)
    assert rows(cleaned.accepted, "product_id") == [("p0",), ("p2",)]
    assert reasons(cleaned) == {"unknown category": 2}


def test_held_rows_are_read_once(spark, orders):
    held = []

    def hold(marked):
        held.append(checkpointed(marked))
        return held[0]

    cleaned = cleaning.clean_orders(orders, cleaning.clean_customers(orders), hold=hold)
    assert len(held) == 1 and cleaned.accepted.count() + cleaned.rejected.count() == orders.count()
    assert "Join" not in cleaned.rejected._jdf.queryExecution().toString()


def test_sellers(spark, rows):
    stg = raw(
        spark,
        "sellers",
        {"seller_id": "s1 ", "seller_zip_code_prefix": " 01 ", "seller_city": " RIO ", "seller_state": "rj "},
        {"seller_id": "s1", "seller_zip_code_prefix": "01", "seller_city": "rio", "seller_state": "RJ"},
        {"seller_id": "s2", "seller_city": " ", "seller_state": ""},
        {"seller_id": ""},
        {"seller_id": "s3", "seller_state": "RJX"},
    )
    cleaned = cleaning.clean_sellers(stg)
    assert rows(cleaned.accepted) == [("s1", "01", "rio", "RJ"), ("s2", None, None, None)]
    assert reasons(cleaned) == {"no seller_id": 1, "too long seller_state": 1}


@pytest.fixture
def orders(spark):
    full = {"order_status": " Delivered", "order_purchase_timestamp": TS, "order_estimated_delivery_date": TS}
    return raw(
        spark,
        "orders",
        {"order_id": " o1", "customer_id": "c1 ", **full, "order_approved_at": " "},
        {"order_id": "o2", "customer_id": "c1", **full, "order_approved_at": "05-03-2018 14:07"},
        {"order_id": "o3", "customer_id": "c9", **full},
        {"order_id": "o4", "customer_id": "c1", "order_status": "x", "order_purchase_timestamp": TS},
        {"order_id": "o5", "customer_id": "c1", **full, "order_status": "lost"},
        {"order_id": "o6", "customer_id": "c1", **full, "order_status": None},
        {"order_id": "o7" * 17, "customer_id": "c1", **full},
        {"order_id": None, "customer_id": "c1", **full},
    )


@pytest.fixture
def customers(spark):
    return spark.createDataFrame([("c1",)], "customer_id string")


def test_orders(spark, orders, customers, rows):
    cleaned = cleaning.clean_orders(orders, customers)
    when = datetime.datetime(2018, 3, 5, 14, 7)
    got = rows(cleaned.accepted, "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at")
    assert got == [("o1", "c1", "delivered", when, None)]
    assert reasons(cleaned) == {
        "unreadable order_approved_at": 1,
        "unknown customer_id": 1,
        "no order_estimated_delivery_date": 1,
        "no order_id": 1,
        "check chk_order_status": 2,
        "too long order_id": 1,
    }
    assert cleaned.accepted.count() + cleaned.rejected.count() == orders.count()


def test_order_items(spark, orders, customers, rows):
    known = cleaning.clean_orders(orders, customers).accepted
    products = spark.createDataFrame([("p1",)], "product_id string")
    sellers = spark.createDataFrame([("s1",)], "seller_id string")
    base = {
        "order_id": "o1 ", "order_item_id": "1", "product_id": "p1", "seller_id": " s1",
        "shipping_limit_date": TS, "price": "10.005", "freight_value": "0",
    }
    stg = raw(
        spark,
        "order_items",
        base,
        {**base, "order_item_id": "2.9"},
        {**base, "order_id": "o9"},
        {**base, "product_id": "p9"},
        {**base, "seller_id": "s9"},
        {**base, "price": "free"},
        {**base, "price": ""},
        {**base, "freight_value": "-0.01"},
    )
    cleaned = cleaning.clean_order_items(stg, known, products, sellers)
    assert rows(cleaned.accepted, "order_id", "order_item_id", "seller_id", "price") == [
        ("o1", 1, "s1", 10.01), ("o1", 2, "s1", 10.01)
    ]
    assert reasons(cleaned) == {
        "unknown order_id": 1, "unknown product_id": 1, "unknown seller_id": 1, "unreadable price": 1, "no price": 1,
        "check chk_freight_nonneg": 1,
    }


def test_rows_stay_where_they_are_when_few_lack_a_parent(spark):
    base = {"payment_sequential": "1", "payment_type": "card", "payment_installments": "1", "payment_value": "5"}
    ids = [*range(1000), 1 << 20, None]
    stg = raw(spark, "order_payments", *[{**base, "order_id": None if i is None else f" {i}"} for i in ids])
    known = spark.range(20_000).select(F.col("id").cast("string").alias("order_id"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10k")
    try:
        cleaned = cleaning.clean_order_payments(stg, known)
        plan = cleaned.accepted._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
        assert cleaned.accepted.count() == 1000 and reasons(cleaned) == {"unknown order_id": 1, "no order_id": 1}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def small_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10k")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_accepted_and_rejected_items_are_not_sorted_by_parents(spark, small_broadcasts):
    many = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    parents = [many.withColumnRenamed("k", key) for key in ("order_id", "product_id", "seller_id")]
    base = {"order_item_id": "1", "shipping_limit_date": TS, "price": "1", "freight_value": "0"}
    ids = [("1", "2", "3"), ("x", "2", "3"), ("1", "x", "3"), ("1", "2", "x")]
    stg = raw(spark, "order_items", *[{**base, "order_id": o, "product_id": p, "seller_id": s} for o, p, s in ids])
    cleaned = cleaning.clean_order_items(stg, *parents)
    every = cleaned.accepted.select(F.lit(1)).union(cleaned.rejected.select(F.lit(1)))
    assert "Sort" not in every._jdf.queryExecution().executedPlan().toString()
    assert every.count() == 4 and cleaned.accepted.count() == 1


def test_rows_that_travel_to_many_unknown_keys_are_not_sorted(spark, small_broadcasts):
    ids = spark.range(1_000_200).select(F.concat(F.lit(" "), F.col("id").cast("string")).alias("order_id"))
    hot = spark.range(5_000).select(F.lit("unknown").alias("order_id"))
    base = {"payment_sequential": "1", "payment_type": "card", "payment_installments": "1", "payment_value": "5"}
    stg = ids.union(hot).union(spark.sql("SELECT CAST(NULL AS string)")).select(
        "order_id", *[F.lit(v).alias(name) for name, v in base.items()]
    )
    known = spark.range(100).select(F.col("id").cast("string").alias("order_id"))
    cleaned = cleaning.clean_order_payments(stg, known)
    every = cleaned.accepted.select(F.lit(1)).union(cleaned.rejected.select(F.lit(1)))
    plan = every._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "BroadcastHashJoin" not in plan and "ShuffledHashJoin" in plan
    assert cleaned.accepted.count() == 100
    assert reasons(cleaned) == {"unknown order_id": 1_005_100, "no order_id": 1}


def test_loaded_parents_do_not_move_the_rows(spark, tmp_path, small_broadcasts):
    many = spark.range(20_000).select(F.col("id").cast("string").alias("order_id"))
    many.write.parquet(f"{tmp_path}/orders")
    stg = raw(spark, "order_reviews", *[{"review_id": "r", "order_id": o, "review_score": "5"} for o in ("7", "x")])
    cleaned = cleaning.clean_order_reviews(stg, spark.read.parquet(f"{tmp_path}/orders"))
    assert "Exchange hashpartitioning" not in cleaned.accepted._jdf.queryExecution().executedPlan().toString()
    assert cleaned.accepted.count() == 1 and reasons(cleaned) == {"unknown order_id": 1}


def test_payments(spark, orders, customers, rows):
    known = cleaning.clean_orders(orders, customers).accepted
    base = {"order_id": "o1", "payment_sequential": "1", "payment_type": " CARD ", "payment_installments": "2.9", "payment_value": "5"}
    cleaned = cleaning.clean_order_payments(raw(spark, "order_payments", base, {**base, "order_id": "o7"}), known)
    assert rows(cleaned.accepted) == [("o1", 1, "card", 2, 5.0)]
    assert reasons(cleaned) == {"unknown order_id": 1}


def test_reviews(spark, orders, customers, rows):
    known = cleaning.clean_orders(orders, customers).accepted
    stg = raw(
        spark,
        "order_reviews",
        *[{"review_id": f"r{s}", "order_id": "o1", "review_score": s} for s in ("0", "5", "6", "x", "3.0", None)],
        {"review_id": "text", "order_id": "o1", "review_score": "1", "review_comment_title": " ",
         "review_comment_message": " fine ", "review_creation_date": "5-3-2018 4:07"},
        {"review_id": "date", "order_id": "o1", "review_score": "1", "review_creation_date": "31-02-2018 10:00"},
        {"review_id": "lost", "order_id": "o8", "review_score": "1"},
    )
    cleaned = cleaning.clean_order_reviews(stg, known)
    columns = ["review_id", "review_score", "review_comment_title", "review_comment_message", "review_creation_date"]
    assert rows(cleaned.accepted, *columns) == [
        ("r5", 5, None, None, None), ("text", 1, None, "fine", datetime.datetime(2018, 3, 5, 4, 7))
    ]
    assert reasons(cleaned) == {"score not 1 to 5": 5, "unreadable review_creation_date": 1, "unknown order_id": 1}


def geo(spark, *points):
    return raw(spark, "geolocation", *[{"geolocation_lat": a, "geolocation_lng": b} for a, b in points])


def test_geolocation(spark, rows):
    points = [("23.54", "46.63"), ("-23.54", "-46.63"), ("91", "1"), ("1e2", "1"), (".5", "1"), ("1", "181"), ("3.", "60")]
    cleaned = cleaning.clean_geolocation(geo(spark, *points))
    got = rows(cleaned.accepted, "geolocation_lat", "geolocation_lng")
    assert got == sorted([(-23.54, -46.63), (-23.54, -46.63), (-3.0, -60.0)], key=lambda t: tuple(map(repr, t)))
    assert reasons(cleaned) == {"latitude": 3, "longitude": 1}


def test_geolocation_with_a_box_leaves_northern_points(spark, rows):
    box = quality.BOX
    cleaned = cleaning.clean_geolocation(geo(spark, ("3", "60"), ("23.5", "46.6"), ("-10", "-50")), box=box)
    got = rows(cleaned.accepted, "geolocation_lat", "geolocation_lng")
    assert got == sorted([(3.0, -60.0), (-23.5, -46.6), (-10.0, -50.0)], key=lambda t: tuple(map(repr, t)))


def test_whole_pipeline_gives_the_declared_tables(spark, orders, tmp_path):
    base = {"order_id": "o1", "order_item_id": "1", "product_id": "p1", "seller_id": "s1", "price": "1", "freight_value": "1"}
    staging = {
        "orders": orders,
        "order_items": raw(spark, "order_items", base, {**base, "order_id": "gone"}),
        "products": raw(spark, "products", {"product_id": "p1"}),
        "sellers": raw(spark, "sellers", {"seller_id": "s1"}),
        "order_payments": raw(spark, "order_payments"),
        "order_reviews": raw(spark, "order_reviews"),
        "geolocation": geo(spark, ("1", "1"), ("1", "1")),
    }
    typed = cleaning.load_production(staging, str(tmp_path))
    counts = {n: df.count() for n, df in typed.items()}
    assert counts == {
        "customers": 2, "product_category": 1, "products": 1, "sellers": 1, "orders": 2, "order_items": 1,
        "order_payments": 0, "order_reviews": 0, "geolocation": 2,
    }
    assert spark.read.parquet(f"{tmp_path}/_rejects/order_items").first()["reject_reason"] == "unknown order_id"
    for name, df in typed.items():
        declared = {c.name: c.spark_type for c in TABLES[name].columns}
        assert [(f.name, f.dataType) for f in df.schema] == list(declared.items()), name
    assert typed["customers"].filter("created_at is null").count() == 0
    assert typed["product_category"].first()["parent_category_id"] is None


def checks(df):
    return {r["check"]: r.rows_affected for r in df.collect()}


def test_quality_checks(spark, orders):
    assert checks(quality.missing_master(orders)) == {"customers rebuilt from orders": 2}
    assert checks(quality.date_formats(orders, "order_approved_at")) == {"blank": 7, "dd-MM-yyyy HH:mm": 1}
    points = spark.createDataFrame([(Decimal("23.5"), Decimal("46.6"))], "geolocation_lat decimal(10,6), geolocation_lng decimal(10,6)")
    assert checks(quality.sign_inversion(points)) == {"inside the box as read": 0, "inside the box corrected": 1}
    text = spark.createDataFrame([("A", "x"), (" A ", None), (None, "AA")], "t string, m string")
    assert checks(quality.placeholder_text(text, ["t", "m"])) == {"t is filler": 2, "m is filler": 0}
    assert text.join(quality.flag_filler(text, ["t"]).select("t"), "t").count() == 2
    products = raw(spark, "products", {"product_category_name": " "}, {}, {"product_category_name": "x"})
    assert checks(quality.missing_category(products)) == {"category missing": 2}
    sizes = spark.createDataFrame([(1, None), (None, None), (1, 1)], "w int, h int")
    assert checks(quality.missing_dimensions(sizes, ["w", "h"])) == {"w missing": 1, "h missing": 2, "any missing": 2}
    done = spark.createDataFrame(
        [("o1", "delivered", None), ("o2", "delivered", 1), ("o3", "shipped", None)],
        "order_id string, order_status string, order_delivered_customer_date int",
    )
    assert checks(quality.delivered_without_date(done)) == {"delivered without a date": 1}
    paid = spark.createDataFrame([("o1",), ("o1",)], "order_id string")
    assert checks(quality.orders_without(done, paid)) == {"orders without payment": 2}


def test_encoding_report(spark):
    data = spark.createDataFrame([("são".encode(),), ("são".encode("cp1252"),)], "t binary")
    assert checks(quality.encoding_report(data, "t")) == {"t not valid UTF-8": 1}
    assert {r.t for r in quality.repair_encoding(data, "t").collect()} == {"são"}
    assert quality.repair_encoding(data, "t").filter(F.col("t") == "são").count() == 2
