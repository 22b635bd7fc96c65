"""Keys that outlive loads, and deletes over all references."""

import pytest
from pyspark.sql import functions as F

from tradewind.operators.keys import extend_key_map, read_key_map
from tradewind.operators.referential import delete_over_references
from tradewind.plans.cleaning import stored_category_lookup


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "name string")


def test_known_values_keep_their_numbers(spark, tmp_path, rows):
    root = str(tmp_path)
    assert read_key_map(spark, root, "map", "name", "id").collect() == []
    first = extend_key_map(names(spark, "m", "b", "b", None), root, "map", "01", "name", "id")
    assert rows(first) == [(1, "b"), (2, "m")]
    second = extend_key_map(names(spark, "a", "m", "z"), root, "map", "02", "name", "id")
    assert rows(second) == [(1, "b"), (2, "m"), (3, "a"), (4, "z")]
    # A rerun adds nothing, whatever it brings.
    assert rows(extend_key_map(names(spark, "q"), root, "map", "02", "name", "id")) == rows(second)
    assert rows(extend_key_map(names(spark), root, "map", "03", "name", "id")) == rows(second)


def test_a_load_that_died_is_written_anew(spark, tmp_path, rows):
    root = str(tmp_path)
    extend_key_map(names(spark, "a"), root, "map", "1", "name", "id")
    names(spark, "left over").withColumn("id", F.lit(9).cast("bigint")).write.parquet(f"{root}/map/batch=id_2")
    assert rows(read_key_map(spark, root, "map", "name", "id")) == [(1, "a")]
    assert rows(extend_key_map(names(spark, "c", "b"), root, "map", "2", "name", "id")) == [(1, "a"), (2, "b"), (3, "c")]


def test_categories_over_loads(spark, tmp_path, rows):
    def load(batch, *values):
        raw = spark.createDataFrame([(v,) for v in values], "product_category_name string")
        return rows(stored_category_lookup(raw, str(tmp_path), batch), "category_id", "category_name")

    first = load("1", "toys", "Bébé ", "bebe")
    assert [k for k, _ in first] == [1, 2]
    second = load("2", "TOYS", "art", " bebé", "zoo")
    assert second[:2] == first and [n for _, n in second[2:]] == ["art", "zoo"]


@pytest.fixture
def shop(spark):
    return {
        "customers": spark.createDataFrame([("c1",), ("c2",), ("c3",)], "customer_id string"),
        "orders": spark.createDataFrame([("o1", "c1"), ("o2", "c1"), ("o3", "c2")], "order_id string, customer_id string"),
        "order_items": spark.createDataFrame(
            [("o1", 1, "p1"), ("o1", 2, "p2"), ("o3", 1, "p1"), (None, 1, "p2")], "order_id string, order_item_id int, product_id string"
        ),
        "order_payments": spark.createDataFrame([("o1", 5.0), ("o2", 6.0)], "order_id string, payment_value double"),
        "products": spark.createDataFrame([("p1", 1), ("p2", 2), ("p3", None)], "product_id string, category_id int"),
        "product_category": spark.createDataFrame([(1, None), (2, 1), (3, 2)], "category_id int, parent_category_id int"),
    }


def keys(spark, column, *values):
    return spark.createDataFrame([(v,) for v in values], f"{column} {'int' if isinstance(values[0], int) else 'string'}")


def test_a_restrict_reference_stops_all(spark, shop, rows):
    done = delete_over_references(shop, "customers", keys(spark, "customer_id", "c1", "c3"))
    assert done.blocked and rows(done.blockers) == [("orders", "customer_id", "customers", 2)]
    assert all(rows(done.tables[n]) == rows(df) for n, df in shop.items())


def test_cascades_reach_all_tables(spark, shop, rows):
    done = delete_over_references(shop, "orders", keys(spark, "order_id", "o1", "o9"))
    assert not done.blocked and done.blockers.count() == 0
    assert rows(done.tables["orders"], "order_id") == [("o2",), ("o3",)]
    assert rows(done.tables["order_items"], "order_id", "product_id") == [("o3", "p1"), (None, "p2")]
    assert rows(done.tables["order_payments"], "order_id") == [("o2",)]
    assert rows(done.tables["customers"]) == rows(shop["customers"])


def test_set_null_and_restrict_within_a_table(spark, shop, rows):
    blocked = delete_over_references(shop, "product_category", keys(spark, "category_id", 2))
    assert rows(blocked.blockers) == [("product_category", "parent_category_id", "product_category", 1)]
    done = delete_over_references(shop, "product_category", keys(spark, "category_id", 3))
    assert not done.blocked and rows(done.tables["products"]) == rows(shop["products"])
    without = {n: df for n, df in shop.items() if n != "product_category"}
    flat = without | {"product_category": shop["product_category"].drop("parent_category_id")}
    done = delete_over_references(flat, "product_category", keys(spark, "category_id", 2))
    assert rows(done.tables["products"]) == [("p1", 1), ("p2", None), ("p3", None)]
    assert rows(done.tables["product_category"]) == [(1,), (3,)]


def test_restrict_behind_a_cascade(spark, shop, rows):
    """Customers cascade to orders, orders to items; what restricts the items' orders at that depth stops everything."""
    rules = {
        "orders": [("customer_id", "customers", "customer_id", "cascade")],
        "order_items": [("order_id", "orders", "order_id", "cascade")],
        "order_payments": [("order_id", "orders", "order_id", "restrict")],
    }
    done = delete_over_references(shop, "customers", keys(spark, "customer_id", "c1"), rules)
    assert done.blocked and rows(done.blockers) == [("order_payments", "order_id", "orders", 2)]
    done = delete_over_references(shop, "customers", keys(spark, "customer_id", "c2"), rules)
    assert not done.blocked and rows(done.tables["order_items"], "order_id") == [("o1",), ("o1",), (None,)]
    assert rows(done.tables["orders"], "order_id") == [("o1",), ("o2",)] and done.tables["customers"].count() == 2


def test_a_table_that_cascades_to_itself(spark, shop, rows):
    rules = {
        "product_category": [("parent_category_id", "product_category", "category_id", "cascade")],
        "products": [("category_id", "product_category", "category_id", "set_null")],
    }
    done = delete_over_references(shop, "product_category", keys(spark, "category_id", 2), rules)
    assert rows(done.tables["product_category"], "category_id") == [(1,)]
    assert rows(done.tables["products"]) == [("p1", 1), ("p2", None), ("p3", None)]
    circle = {"orders": [("order_id", "order_items", "order_id", "cascade")], "order_items": [("order_id", "orders", "order_id", "cascade")]}
    with pytest.raises(ValueError, match="circle"):
        delete_over_references(shop, "orders", keys(spark, "order_id", "o1"), circle)
