"""Changes of published tables: what is written, what is read, and what stays."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tradewind.operators.gated import batch_folder, publish, published_files, read_published
from tradewind.operators.rewrites import delete_published, update_published
from tradewind.sources.tables import clustered


@pytest.fixture
def root(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(80).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"), F.lit(None).cast("int").alias("n"))
    clustered(rows, ["k"], 8).write.parquet(batch_folder(root, "t", "1"))
    publish(spark, root, "1")
    return root


def times(root):
    return {
        os.path.join(folder, f): os.stat(os.path.join(folder, f)).st_mtime_ns
        for folder, _, files in os.walk(f"{root}/t") for f in files if f.endswith(".parquet")
    }


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "k long")


def test_only_touched_files_are_written(spark, root, rows):
    before = times(root)
    written = delete_published(spark, root, "t", "2", "k", keys(spark, 11, 12, 500, None))
    assert 1 <= len(written) < 4
    after = times(root)
    assert all(after[f] == t for f, t in before.items())
    new = sorted(r["k"] for r in spark.read.parquet(*[f for f in after if f not in before]).collect())
    assert {11, 12}.isdisjoint(new) and len(new) < 40
    assert rows(read_published(spark, root, "t"), "k") == sorted([(k,) for k in range(80) if k not in (11, 12)], key=lambda t: repr(t[0]))
    # Replaced files are not in the listing of a read.
    names = published_files(spark, root, "t").select("_file").distinct().collect()
    assert not {r[0] for r in names} & set(written)


def test_updates_over_deletes(spark, root):
    delete_published(spark, root, "t", "2", "k", keys(spark, 3))
    some = F.col("k").between(2, 5) | F.col("n").isNotNull()
    assert len(update_published(spark, root, "t", "3", some, {"v": F.concat("v", F.lit("!")), "n": F.col("k")})) >= 1
    got = {r["k"]: (r["v"], r["n"]) for r in read_published(spark, root, "t").collect()}
    assert {k: v for k, v in got.items() if k < 7} == {
        0: ("v0", None), 1: ("v1", None), 2: ("v2!", 2), 4: ("v4!", 4), 5: ("v5!", 5), 6: ("v6", None)}
    assert len(got) == 79 and read_published(spark, root, "t").dtypes == [("k", "bigint"), ("v", "string"), ("n", "int")]


def test_a_change_is_seen_when_published_and_done_once(spark, root):
    delete_published(spark, root, "t", "2", "k", keys(spark, 1))
    state = times(root)
    assert delete_published(spark, root, "t", "2", "k", keys(spark, 1, 2)) == [] and times(root) == state
    # As if it had died before its entry: the table is as it was, and the change can be done.
    shutil.rmtree(f"{root}/_published")
    publish(spark, root, "1")
    assert read_published(spark, root, "t").count() == 80
    assert delete_published(spark, root, "t", "2", "k", keys(spark, 1, 40)) != []
    assert read_published(spark, root, "t").count() == 78


def test_nothing_to_change(spark, root):
    state = times(root)
    assert delete_published(spark, root, "t", "2", "k", keys(spark, 900)) == [] and times(root) == state
    assert read_published(spark, root, "t").count() == 80
    delete_published(spark, root, "t", "3", "k", keys(spark, *range(80)))
    assert read_published(spark, root, "t").count() == 0
