"""Scalar functions on the edge rows of FIXTURES section 4."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.functions import dates as D
from panelcast.functions import labels as L
from panelcast.functions import numbers as N


def _one(spark, expr, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"s {typ}")
    return [r[0] for r in df.select(expr(F.col("s"))).collect()]


def test_be_slash_dates(spark):
    got = _one(spark, D.parse_be_slash_date, ["29/02/2567", "18/11/2568", "18/11/2025", "31/02/2568", "x", None])
    assert got == [dt.date(2024, 2, 29), dt.date(2025, 11, 18), dt.date(2025, 11, 18), None, None, None]


def test_thai_long_dates(spark):
    got = _one(spark, D.parse_thai_long_date, ["26 พฤศจิกายน 2568", "1 มกราคม 2567", "26 Foo 2568", "26 พฤศจิกายน"])
    assert got == [dt.date(2025, 11, 26), dt.date(2024, 1, 1), None, None]


def test_parse_chain_and_be_iso(spark):
    df = spark.createDataFrame([("2543-02-29 10:00:00",), ("2024/01/05",), ("29/02/2567",), ("nonsense",)], "s string")
    got = [r.d for r in D.with_parsed_date(df, "s", "d").collect()]
    assert got == [dt.date(2000, 2, 29), dt.date(2024, 1, 5), dt.date(2024, 2, 29), None]


def test_times(spark):
    got = _one(spark, D.normalize_time, ["เวลา 15:44 น.", "17:10", "-", None])
    assert got == ["15:44:00", "17:10:00", None, None]


def test_numbers(spark):
    assert _one(spark, N.strip_thousands, ["62,900.00", "1 234", "+", ""]) == [62900.0, 1234.0, None, None]
    assert _one(spark, N.clean_numeric, ["฿62,900.50 บาท", "62,900 THB", "-", "+", ""]) == [62900.5, 62900.0, None,
                                                                                             None, None]
    assert _one(spark, N.to_number, ["NaN", "1e3", "abc"]) == [None, 1000.0, None]


def test_range_rule_bounds(spark):
    got = _one(spark, lambda c: N.in_range_or_null(c, 10000, 100000), [9999.99, 10000.0, 100000.0, 100000.01],
               "double")
    assert got == [None, 10000.0, 100000.0, None]
    got = _one(spark, lambda c: N.in_range_or_null(c, 20, 50), [19.99, 20.0, 50.0], "double")
    assert got == [None, 20.0, 50.0]


def test_weekdays_and_next_open(spark):
    sat = dt.date(2025, 11, 22)
    df = spark.createDataFrame([(sat,)], "d date")
    r = df.select(D.weekday_number("d").alias("w"), D.weekday_name("d").alias("n"),
                  D.next_open_day("d", [6]).alias("next"), D.is_open_day("d", [6]).alias("open"),
                  D.next_open_day("d", [5, 6]).alias("next_wd")).first()
    assert (r.w, r.n, r.next, r.open, r.next_wd) == (5, "Saturday", dt.date(2025, 11, 24), True, dt.date(2025, 11, 24))
    with pytest.raises(ValueError):
        D.next_open_day(F.col("d"), range(7))


def test_change_pct_zero_denominator(spark):
    df = spark.createDataFrame([(5.0, 0.0), (110.0, 100.0)], "p double, l double")
    got = [r[0] for r in df.select(N.change_pct("p", "l")).collect()]
    assert got[0] is None and abs(got[1] - 10.0) < 1e-12


def test_classes(spark):
    df = spark.createDataFrame([(0.05, 2.0, -1.5, 0.15, 0.05)], "a double, v double, d double, b double, var double")
    r = df.select(L.trend_class("a"), L.volatility_class("v"), L.drift_severity("d"), L.bias_class("b"),
                  L.stability_class("var")).first()
    assert tuple(r) == ("flat", "high", "HIGH", "OVER-PREDICT", "STABLE")


def test_recommendations_default(spark):
    df = spark.createDataFrame([(False, 99.0, 0.0, "STABLE"), (True, 90.0, 0.3, "VOLATILE")],
                               "d boolean, m double, b double, s string")
    recs = [r[0] for r in df.select(L.recommendations("d", "m", "b", "s")).collect()]
    assert recs[0] == [L.REC_STABLE]
    assert len(recs[1]) == 4 and "OVER-PREDICT" in recs[1][2]
