"""Every registered query against its DuckDB SQL on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tradewind.bindings.registered import REGISTERED

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, (decimal.Decimal, datetime.date)) and not isinstance(value, datetime.datetime):
        raise AssertionError(f"{type(value).__name__} differs between engines, cast it")
    return f"{type(value).__name__} {value!r}"


def test_every_query_has_sql():
    assert REGISTERED.keys() <= entry_points.oracle_sql().keys()


@pytest.mark.parametrize("name", list(REGISTERED))
def test_same_result(spark, duck, name):
    df = entry_points.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[p]) for p in places) for r in result.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
