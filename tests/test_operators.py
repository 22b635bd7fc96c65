import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradewind.operators import changes, constraints, skew
from tradewind.operators.gated import gated_append, published_batches, read_published
from tradewind.operators.keys import keep_last, with_surrogate_key
from tradewind.schemas import TABLES
from tradewind.sources import tables


def timeline(spark, n=600, seed=1):
    """Rows of which one key holds two thirds, with many equal times."""
    pick = random.Random(seed)
    start = datetime.datetime(2018, 1, 1)
    data = [
        (
            pick.choice(["hot", "hot", "hot", "hot", "a", "b", "c"]),
            start + datetime.timedelta(hours=6 * pick.randrange(60)),
            i,
            pick.randrange(5),
        )
        for i in range(n)
    ]
    return spark.createDataFrame(data, "k string, ts timestamp_ntz, id int, v int")


@pytest.mark.parametrize("partitions", ["1", "4", "40"])
def test_ranged_windows_equal_plain_ones(spark, rows, partitions):
    df = timeline(spark).unionByName(spark.createDataFrame([(None, datetime.datetime(2018, 1, n), 1000 + n, n) for n in (5, 2, 9)], timeline(spark, 1).schema))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows(skew.previous_value(df, "k", ["ts", "id"], "ts", "prev"), "k", "ts", "id", "v", "prev")
        total = rows(skew.running_total(df, "k", ["ts", "id"], "v", "so_far"), "k", "ts", "id", "v", "so_far")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    plain = Window.partitionBy("k").orderBy("ts", "id")
    assert got == rows(df.withColumn("prev", F.lag("ts").over(plain)))
    assert total == rows(df.withColumn("so_far", F.sum("v").over(plain.rowsBetween(Window.unboundedPreceding, 0))))


def test_previous_value_wants_its_own_order(spark):
    with pytest.raises(ValueError):
        skew.previous_value(timeline(spark, 5), "k", ["id"], "ts", "prev")


def test_keep_last_keeps_rows_without_identity(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), (None, 1), (None, 1), ("b", 9)], "k string, id int")
    assert rows(keep_last(df, ["k"], ["id"])) == sorted(
        [("a", 3), ("b", 9), (None, 1), (None, 1)], key=lambda t: tuple(map(repr, t))
    )


def test_surrogate_key_has_no_holes(spark):
    # A third of the rows are copies of one another.
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("v")).repartition(7, "v")
    numbered = with_surrogate_key(df, "n")
    assert sorted(r.n for r in numbered.collect()) == list(range(1, 3001))
    ordered = with_surrogate_key(df.distinct(), "n", ["v"])
    values = [r.v for r in ordered.orderBy("n").collect()]
    assert values == sorted(values) and ordered.agg(F.max("n")).first()[0] == len(values)


def found(df):
    return {r.rule: r.violations for r in df.collect()}


def test_row_rules_pass_on_unknown(spark):
    df = spark.createDataFrame([(1, "SP"), (None, None), (-1, "SPX")], "w int, s string")
    assert found(constraints.not_null(df, "t", ["w", "s"])) == {"not_null w": 1, "not_null s": 1}
    assert found(constraints.check(df, "t", {"w": "w >= 0", "s": "char_length(s) = 2"})) == {"check w": 1, "check s": 1}
    assert found(constraints.max_length(df, "t", {"s": 2})) == {"length s": 1}


def test_unique_ignores_incomplete_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (1, None), (1, None), (2, 1)], "a int, b int")
    assert found(constraints.unique(df, "t", ["a", "b"])) == {"unique a, b": 2}
    assert found(constraints.unique(df.limit(0), "t", ["a"])) == {"unique a": 0}


def test_foreign_key_passes_null(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert found(constraints.foreign_key(child, "t", "k", parent, "id", "p")) == {"foreign_key k -> p": 2}


def test_delete_actions(spark, rows):
    child = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    gone = spark.createDataFrame([(2,), (2,), (9,)], "id int")
    act = {a: rows(changes.propagate_delete(child, "k", gone, "id", a), "v") for a in ("cascade", "restrict", "set_null")}
    assert act == {"cascade": [("x",), ("z",)], "restrict": [("y",)], "set_null": [("x",), ("y",), ("z",)]}
    cleared = changes.propagate_delete(child, "k", gone, "id", "set_null")
    assert rows(cleared.filter("k is null"), "v") == [("y",), ("z",)]
    assert rows(changes.delete_by_key(child, "k", gone, "id"), "v") == [("x",), ("z",)]
    with pytest.raises(ValueError):
        changes.propagate_delete(child, "k", gone, "id", "ignore")


def test_insert_update_defaults(spark, rows):
    df = spark.createDataFrame([(1, "a", 5)], "id int, name string, p int")
    more = changes.insert_values(df, [{"id": 2, "name": "b"}], {"p": df.agg(F.max("p")).scalar()})
    assert rows(more) == [(1, "a", 5), (2, "b", 5)]
    changed = changes.update_where_in(more, "p", df.agg(F.max("id")).scalar(), "name", ["b", "c"])
    assert rows(changed) == [(1, "a", 5), (2, "b", 1)]
    assert changes.add_nullable_column(df, "parent", "int").first()["parent"] is None
    filled = changes.fill_defaults(df, {"p": F.lit(0), "freight": F.lit(0)})
    assert rows(filled) == [(1, "a", 5, 0)]


def order(spark, order_id, customer="c1", status="created"):
    ts = datetime.datetime(2018, 1, 1)
    schema = (
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_estimated_delivery_date timestamp_ntz"
    )
    return spark.createDataFrame([(order_id, customer, status, ts, ts)], schema)


def item(spark, order_id, number=1, seller="s1"):
    schema = "order_id string, order_item_id int, product_id string, seller_id string, price decimal(10,2), freight_value decimal(10,2)"
    from decimal import Decimal

    return spark.createDataFrame([(order_id, number, "p1", seller, Decimal("99.90"), Decimal("12.50"))], schema)


@pytest.fixture
def parents(spark):
    return {
        "customers": spark.createDataFrame([("c1",)], "customer_id string"),
        "products": spark.createDataFrame([("p1",)], "product_id string"),
        "sellers": spark.createDataFrame([("s1",)], "seller_id string"),
    }


def test_gated_append_is_all_or_nothing(spark, parents, tmp_path):
    root = str(tmp_path / "gated")
    bad = {"orders": order(spark, "o1"), "order_items": item(spark, "o1", seller="nobody")}
    report = gated_append(bad, parents, root, "first")
    assert {r.rule for r in report.filter("violations > 0").collect()} == {"foreign_key seller_id -> sellers"}
    assert not any(r.accepted for r in report.collect())
    assert published_batches(spark, root).count() == 0

    good = {"orders": order(spark, "o2"), "order_items": item(spark, "o2")}
    assert all(r.accepted for r in gated_append(good, parents, root, "second").collect())
    stored = {n: read_published(spark, root, n) for n in good}
    assert [r.order_id for r in stored["orders"].collect()] == ["o2"]
    assert stored["order_items"].count() == 1

    # The same key again is refused; a key of a stored parent is fine.
    again = gated_append({"orders": order(spark, "o2")}, {**parents, **stored}, root, "third")
    assert {r.rule for r in again.filter("violations > 0").collect()} == {"primary_key already stored"}
    later = gated_append({"order_items": item(spark, "o2", 2)}, {**parents, **stored}, root, "fourth")
    assert all(r.accepted for r in later.collect())
    assert read_published(spark, root, "order_items").count() == 2


def test_half_written_batch_is_not_read(spark, parents, tmp_path):
    root = str(tmp_path / "gated")
    gated_append({"orders": order(spark, "o1")}, parents, root, "01")
    order(spark, "o9").write.parquet(f"{root}/orders/batch=crashed")
    assert [r.order_id for r in read_published(spark, root, "orders").collect()] == ["o1"]


def test_declared_tables():
    assert sum(len(t.columns) for t in TABLES.values()) == 55
    assert TABLES["order_items"].primary_key == ["order_id", "order_item_id"]
    assert TABLES["products"].schema["product_weight_g"].dataType.simpleString() == "decimal(10,2)"
    assert TABLES["order_reviews"].schema["review_score"].dataType.simpleString() == "tinyint"
    assert TABLES["orders"].lengths["order_status"] == 20


def test_layouts(spark, tmp_path):
    even = spark.range(2000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    hot = spark.range(2000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    assert tables.bucket_skew(even, "k", 16) < 2 < 5 < tables.bucket_skew(hot, "k", 16)
    tables.write_bucketed(even, "layout_even", str(tmp_path / "e"), ["k", "v"], 16)
    tables.write_clustered(hot, "layout_hot", str(tmp_path / "h"), ["k", "v"])
    assert spark.table("layout_hot").count() == 2000
    plan = spark.table("layout_even").groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    spark.sql("drop table layout_even")
    spark.sql("drop table layout_hot")


def test_row_counts(spark, rows):
    counted = tables.row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert rows(counted) == [("a", 3), ("b", 0)]
