"""Unit literals for the text/clock/time parsers and label columns (FIXTURES.md section 8)."""

import datetime as dt


from plover.functions import (clock_hour, flight_timestamp, label_from_status, label_from_threshold,
                              parse_month_year, parse_number_text, parse_percent, parse_tenure)
from plover.functions.labels import label_audit


def _one(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn("x")).collect()]


def test_tenure(spark):
    got = _one(spark, ["10+ years", "< 1 year", "1 year", "3 years", "n/a", None], parse_tenure)
    assert got == [10.0, 0.0, 1.0, 3.0, None, None]


def test_percent(spark):
    assert _one(spark, ["13.56%", "", None, "7%"], parse_percent) == [13.56, None, None, 7.0]


def test_month_year(spark):
    assert _one(spark, ["Dec-2015", "Jan-1999", None, "bad"], parse_month_year) == [2015.0, 1999.0, None, None]


def test_weather_text(spark):
    assert _one(spark, ["0.00s", "T", " 7 ", None, "2.5"], parse_number_text) == [None, None, 7.0, None, 2.5]


def test_clock_hour(spark):
    assert _one(spark, [5, 930, 1230, 2400, None], clock_hour, "int") == [0, 9, 12, 24, None]
    assert _one(spark, [2400], lambda c: clock_hour(c, wrap_24=True), "int") == [0]


def test_flight_timestamp(spark):
    df = spark.createDataFrame([("2015-01-03", 5), ("2015-01-03", 930), ("2015-01-03", 1230),
                                ("2015-01-03", 2400), ("2015-01-03", None)], "d string, c int")
    got = [r[0] for r in df.select(flight_timestamp("d", "c")).collect()]
    assert got == [dt.datetime(2015, 1, 3, 0, 5), dt.datetime(2015, 1, 3, 9, 30), dt.datetime(2015, 1, 3, 12, 30),
                   dt.datetime(2015, 1, 4, 0, 0), None]


def test_labels(spark):
    df = spark.createDataFrame([(15.0, "Fully Paid"), (14.9, "Charged Off"), (None, None)], "d double, s string")
    got = df.select(label_from_threshold("d", 15.0), label_from_status("s", "Fully Paid")).collect()
    assert [tuple(r) for r in got] == [(1, "false"), (0, "true"), (0, None)]


def test_label_audit_ignores_null_recorded(spark):
    df = spark.createDataFrame([(20.0, 1.0), (20.0, 0.0), (1.0, None), (None, 0.0)], "d double, rec double")
    r = label_audit(df, "d", "rec", 15.0).first()
    assert (r.n_rows, r.n_discrepant, r.n_recorded_null, r.n_discrepant_null_safe) == (4, 1, 1, 2)
