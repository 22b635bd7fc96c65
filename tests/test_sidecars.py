"""Sidecars name every file that holds a key, and few others."""

import pytest
from pyspark.sql import functions as F

from tradewind.sources.sidecars import matching_files, read_matching, write_sidecar
from tradewind.sources.tables import clustered


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("side"))
    rows = spark.range(4000).select(
        F.col("id").alias("k"), F.pmod(F.xxhash64("id"), F.lit(900)).alias("v"),
        F.when(F.col("id") % 10 != 0, F.concat(F.lit("s"), F.col("id"))).alias("s"),
    )
    clustered(rows, ["k"], 16).write.parquet(f"{root}/t")
    write_sidecar(spark, f"{root}/t", f"{root}/side", ["v", "s"])
    return f"{root}/t", f"{root}/side"


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "key " + ("string" if isinstance(values[0], str) else "long"))


def test_no_file_is_left_out_and_few_are_read_in_vain(spark, stored):
    path, side = stored
    holds = {}
    for r in spark.read.parquet(path).select("v", F.col("_metadata.file_path").alias("f")).collect():
        holds.setdefault(r["v"], set()).add(r["f"])
    total = len({f for files in holds.values() for f in files})
    vain = 0
    for v in list(holds)[:25]:
        found = set(matching_files(spark, side, "v", keys(spark, v)))
        assert holds[v] <= found
        vain += len(found - holds[v])
    assert total == 16 and vain <= 25 * 16 / 8


def test_rows_of_a_batch_of_keys(spark, stored):
    path, side = stored
    got = read_matching(spark, path, side, "s", keys(spark, "s17", "s18", "s10", "nowhere", None))
    assert sorted(r["k"] for r in got.collect()) == [17, 18] and got.columns == ["k", "v", "s"]
    files = got.select(F.input_file_name()).distinct().count()
    assert files == 1 and len(matching_files(spark, side, "s", keys(spark, "s17", "s18"))) <= 3
    assert read_matching(spark, path, side, "s", keys(spark, "x")).count() == 0


def test_an_empty_table(spark, tmp_path):
    spark.range(0).withColumn("v", F.lit("a")).write.parquet(str(tmp_path / "t"))
    write_sidecar(spark, str(tmp_path / "t"), str(tmp_path / "side"), ["v"])
    assert matching_files(spark, str(tmp_path / "side"), "v", keys(spark, "a")) == []
