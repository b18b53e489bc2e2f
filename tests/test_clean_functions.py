"""Expression units: each clean rule on its edge rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.functions import clean as C
from strata.functions.dates import calendar_columns, day_diff, exact_money_mean, rounded_mean


def one_col(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_blank_to_null(spark):
    assert one_col(spark, ["", "   ", None, "\t", " a ", "a\n"], C.blank_to_null) == [None, None, None, "\t", "a", "a\n"]


def test_zip5(spark):
    assert one_col(spark, ["12", "123456", None, " 7 ", "01234"], C.zip5) == ["00012", "12345", None, "00007", "01234"]


def test_bounded_text(spark):
    got = one_col(spark, ["x" * 33, "c" * 81, "short"], lambda c: C.clean_text(c, 32))
    assert [len(v) for v in got] == [32, 32, 5]


def test_state_code(spark):
    assert one_col(spark, ["sp", " SP ", "s", "abc", ""], C.state_code) == ["SP", "SP", "S", "AB", None]


def test_to_smallint(spark):
    vals = ["7", " 007 ", "-1", "1.0", "x", "99999", "7\n", ""]
    assert one_col(spark, vals, C.to_smallint) == [7, 7, None, None, None, None, None, None]


def test_to_money(spark):
    vals = ["1.005", "5", ".5", "5.", "-5", "1e3", "123456789012.3", "0.00"]
    assert one_col(spark, vals, C.to_money) == [Decimal("1.01"), Decimal("5.00"), None, None, None, None, None, Decimal("0.00")]


def test_to_coordinate(spark):
    got = one_col(spark, ["-23.54562128115268", "+1", "12345.1", "-1.5"], C.to_coordinate)
    assert got == [Decimal("-23.54562128115268"), None, None, Decimal("-1.50000000000000")]


def test_to_timestamp(spark):
    vals = ["2018-03-04 05:06:07", "2018-03-04", "2018-13-45 00:00:00", "2018-01-01 24:00:00", " 2018-03-04 05:06:07 "]
    assert one_col(spark, vals, C.to_timestamp) == [
        dt.datetime(2018, 3, 4, 5, 6, 7), None, None, None, dt.datetime(2018, 3, 4, 5, 6, 7)]


def test_has_text(spark):
    assert one_col(spark, [None, "", "  ", "\t", "a"], C.has_text) == [False, False, False, True, True]


def test_calendar_columns(spark):
    df = spark.createDataFrame([(dt.date(2018, 3, 5),), (dt.date(2018, 3, 4),), (dt.date(2018, 3, 3),)], "d date")
    rows = df.select(*calendar_columns("d")).collect()
    assert [r["day_of_week"] for r in rows] == [1, 7, 6]
    assert [r["is_weekend"] for r in rows] == [False, True, True]
    assert rows[0]["month_name"] == "March" and rows[1]["day_of_week_name"] == "Sunday"
    assert rows[0]["quarter"] == 1 and rows[0]["year"] == 2018


def test_day_diff_negative_and_null(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2018, 1, 10, 23), dt.datetime(2018, 1, 12, 1)), (None, dt.datetime(2018, 1, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(day_diff("a", "b")).collect()] == [-2, None]


def test_rounded_mean_half_away(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (2, 1), (2, 2)], "g int, s smallint")
    got = dict(df.groupBy("g").agg(rounded_mean("s").alias("m")).collect())
    assert got == {1: 3, 2: 2}


def test_exact_money_mean(spark):
    # true mean just under 0.005: decimal avg would round 0.0050 -> 0.01
    rows = [(1, Decimal("0.01"))] * 49999 + [(1, Decimal("0.00"))] * 50001 + [(2, None)]
    df = spark.createDataFrame(rows, "g int, p decimal(10,2)")
    got = dict(df.groupBy("g").agg(exact_money_mean("p").alias("m")).collect())
    assert got == {1: Decimal("0.00"), 2: None}
