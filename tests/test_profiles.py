"""Profiles from sketches and fillers found in the data."""

import pytest
from pyspark.sql import functions as F

from tradewind.plans import dictionary, quality


@pytest.fixture
def wide(spark):
    return spark.range(20_000).select(
        F.col("id").alias("k"),
        (F.col("id") % 5000).cast("string").alias("some"),
        F.when(F.col("id") % 2 == 0, F.col("id").cast("double")).alias("half"),
        F.when(F.col("id") != 7, F.col("id")).otherwise(8).alias("almost"),
        F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(cast(id % 300 as int))").alias("at"),
        F.lit(None).cast("int").alias("empty"),
    )


def test_estimates_are_near_and_keys_exact(wide):
    exact = {r["column_name"]: r for r in dictionary.column_profile({"t": wide}).collect()}
    got = {r["column_name"]: r for r in dictionary.sketch_profile({"t": wide}).collect()}
    assert got.keys() == exact.keys()
    for name, r in got.items():
        want = exact[name]
        assert all(r[c] == want[c] for c in ("position", "column_type", "row_count", "null_count", "key_candidate")), name
        assert abs(r["distinct_count"] - want["distinct_count"]) <= 3 * dictionary.RELATIVE_ERROR * want["distinct_count"]
    assert {n for n, r in got.items() if not r["estimated"]} == {"k", "almost"}
    assert got["k"]["key_candidate"] and got["almost"]["distinct_count"] == 19_999


def test_one_pass_without_expansion(wide):
    plan = dictionary.column_sketches({"t": wide})._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Expand" in dictionary.column_profile({"t": wide})._jdf.queryExecution().executedPlan().toString()


def test_sketches_of_loads_make_those_of_all(wide):
    low, high = (dictionary.column_sketches({"t": wide.filter(c)}) for c in ("k < 12000", "k >= 9000"))
    parts = dictionary.sketch_profile({"t": wide}, low.unionByName(high)).collect()
    some = next(r for r in parts if r["column_name"] == "some")
    assert some["row_count"] == 23_000 and abs(some["distinct_count"] - 5000) <= 3 * dictionary.RELATIVE_ERROR * 5000


def test_empty_and_raw_tables(wide, rows):
    none = dictionary.sketch_profile({"t": wide.limit(0), "stg_t": wide})
    assert {(r["row_count"], r["distinct_count"]) for r in none.collect()} == {(0, 0)}


def test_fillers_are_found(spark, rows):
    data = [("A", "fine"), (" A", "long enough"), ("A ", None), ("", "x"), ("B", "x"), (None, "other")] * 50
    data += [(f"t{n}", f"text {n}") for n in range(200)] + [("rare", "AAAA")] * 3
    df = spark.createDataFrame(data, "title string, message string").repartition(3)
    assert rows(quality.found_fillers(df, ["title", "message"])) == [("message", "x", 100), ("title", "A", 150), ("title", "B", 50)]
    assert rows(quality.found_fillers(df, ["title"], share=0.2)) == [("title", "A", 150)]
    assert quality.found_fillers(df.limit(0), ["title", "message"]).count() == 0
