import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradewind.functions import numbers, text, times


def one(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


def test_blank_text_is_null_but_tabs_are_text(spark):
    assert one(spark, ["", "   ", " a ", "\t", None], "string", text.blank_to_null) == [None, None, "a", "\t", None]


def test_category_name(spark):
    assert one(spark, [" Livros ", "  ", None], "string", text.category_name) == ["livros", "unknown", "unknown"]


def test_fold_ignores_case_accents_and_trailing_blanks(spark):
    df = spark.createDataFrame([("São",), ("sao ",), ("SAO",), ("sal",)], "x string")
    assert df.groupBy(text.fold(F.col("x"))).count().count() == 2


def test_number_text(spark):
    raw = ["3.7", "-3.5", "12", "", " ", "x", None, "1e2"]
    assert one(spark, raw, "string", numbers.rounded_int) == [4, -4, 12, None, None, None, None, 100]
    assert one(spark, raw, "string", numbers.truncated_int) == [3, -3, 12, None, None, None, None, 100]
    decimals = one(spark, ["2.005", "99999999999"], "string", lambda c: numbers.to_decimal(c, 10, 2))
    assert decimals == [Decimal("2.01"), None]


def test_strict_number_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, ["heavy"], "string", lambda c: numbers.to_decimal(c, 10, 2, strict=True))


def test_money_sums_are_exact(spark):
    amounts = [Decimal("0.10")] * 3 + [Decimal("99999999.99")]
    df = spark.createDataFrame([(a,) for a in amounts], "x decimal(10,2)")
    assert df.agg(numbers.money(numbers.sum_cents(F.col("x")))).first()[0] == sum(amounts)
    doubles = spark.createDataFrame([(0.1,), (0.2,), (1.15,)], "x double")
    assert doubles.agg(numbers.money(numbers.sum_cents(F.col("x")))).first()[0] == Decimal("1.45")


def test_percent_of_zero_is_null(spark):
    df = spark.createDataFrame([(5, 0), (1, 3), (-1, 3)], "n bigint, d bigint")
    got = [r[0] for r in df.select(numbers.percent(F.col("n"), F.col("d"))).collect()]
    assert got == [None, Decimal("33.33"), Decimal("-33.33")]


def test_day_first_dates(spark):
    raw = ["05-03-2018 14:07", "5-3-2018 4:07", "31-02-2018 10:00", "2018-03-05 14:07:00", "", None]
    got = one(spark, raw, "string", lambda c: times.parse_timestamp(c, times.DAY_FIRST))
    assert got == [datetime.datetime(2018, 3, 5, 14, 7), datetime.datetime(2018, 3, 5, 4, 7), None, None, None, None]


def test_year_first_dates(spark):
    raw = ["2018-03-05 14:07:09", "2018-03-05", "05-03-2018 14:07", "2018-02-29 00:00:00"]
    got = one(spark, raw, "string", lambda c: times.parse_timestamp(c, times.YEAR_FIRST))
    assert got == [datetime.datetime(2018, 3, 5, 14, 7, 9), None, None, None]


def test_parsing_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # Midnight of this day does not exist on clocks in that zone.
        got = one(spark, ["2017-10-15 00:00:00"], "string", lambda c: times.parse_timestamp(c, times.YEAR_FIRST))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [datetime.datetime(2017, 10, 15)]


def test_strict_date_raises(spark):
    with pytest.raises(Exception, match="expected format"):
        one(spark, ["5/3/2018"], "string", lambda c: times.parse_timestamp(c, times.DAY_FIRST, strict=True))


def test_iso_yearweek(spark):
    days = [datetime.datetime(2017, 12, 31), datetime.datetime(2018, 1, 1), datetime.datetime(2018, 12, 31)]
    assert one(spark, days, "timestamp_ntz", times.iso_yearweek) == [201752, 201801, 201901]


def test_cents_are_exact_for_wide_decimals(spark):
    df = spark.createDataFrame([(Decimal("123456789012345.67"), 0.29), (Decimal("900719925474099.31"), 1234567.89)], "d decimal(20,2), f double")
    got = df.select(numbers.cents(F.col("d")), numbers.cents(F.col("f"))).collect()
    assert [tuple(r) for r in got] == [(12345678901234567, 29), (90071992547409931, 123456789)]
