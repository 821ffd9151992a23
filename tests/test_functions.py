from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from frames import plain_rows
from tallymark.functions import fiscal, measures, text
from tallymark.functions.fiscal import FiscalPeriod


@pytest.mark.parametrize(
    "given, number",
    [
        ("12.50-", -12.5), ("1,234", 1234), ("", 0), ("abc", 0), ("-7.25", -7.25), ("$ 3.00", 3),
        ("5-3", 0), ("1.2.3", 0), ("-", 0), (None, 0),
    ],
)
def test_signed_number(spark, given, number):
    df = spark.createDataFrame([(given,)], "x string").select(text.signed_number("x").alias("n"))
    assert plain_rows(df) == [(number,)]


def test_codes_keep_leading_zeros_and_drop_text(spark):
    rows = [("0110000",), ("111",), ("A11",), ("7",), (None,)]
    df = spark.createDataFrame(rows, "x string").select(text.cost_centre_code("x").alias("c"))
    assert [r.c for r in df.collect()] == ["011", "111", None, "007", None]


def test_substring_is_start_to_end(spark):
    df = spark.createDataFrame([("ABCDEFGH",)], "x string")
    assert df.select(text.substr_span("x", 5, 7)).first()[0] == "EFG"


def test_period_keys_are_padded(spark):
    df = spark.createDataFrame([(2018, 1), (2018, 9), (2018, 10), (2018, 12)], "y int, p int")
    keys = [r.k for r in df.select(text.period_key("y", "p").alias("k")).collect()]
    assert keys == ["2018001", "2018009", "2018010", "2018012"]
    assert text.period_key_text(2018, 4) == "2018004"


def test_prior_period_crosses_the_year(spark):
    assert FiscalPeriod(2018, 1).prior() == FiscalPeriod(2017, 12)
    assert FiscalPeriod(2018, 12).prior() == FiscalPeriod(2018, 11)
    df = spark.createDataFrame([(2018, 1), (2018, 10)], "y int, p int")
    prior = df.select(fiscal.prior_year("y", "p"), fiscal.prior_period("p"))
    assert [tuple(r) for r in prior.collect()] == [(2017, 12), (2018, 9)]


def test_spreadsheet_serial_and_epoch_days(spark):
    df = spark.range(1).select(
        fiscal.date_of_serial(F.lit(43220)).alias("d"),
        fiscal.epoch_days(F.lit(dt.date(2018, 4, 30))).alias("n"),
        fiscal.date_of_epoch_days(F.lit(17651)).alias("back"),
        fiscal.day_stamp(F.lit(dt.date(2018, 4, 3))).alias("stamp"),
    )
    assert tuple(df.first()) == (dt.date(2018, 4, 30), 17651, dt.date(2018, 4, 30), "20180403")


def test_calendar_lookup(spark):
    calendar = spark.createDataFrame(
        [(4, dt.date(2018, 4, 30)), (5, dt.date(2018, 5, 1))], "PERIOD int, USADAT date"
    )
    assert fiscal.period_of(calendar, dt.date(2018, 5, 1)) == FiscalPeriod(2018, 5)
    with pytest.raises(ValueError):
        fiscal.period_of(calendar, dt.date(2018, 6, 1))
    days = spark.createDataFrame([(dt.date(2018, 4, 30),), (dt.date(2018, 6, 1),)], "d date")
    found = plain_rows(fiscal.with_fiscal_period(days, "d", calendar), "d", "PERIOD", "YEAR")
    assert found == [(dt.date(2018, 4, 30), 4, 2018), (dt.date(2018, 6, 1), None, 2018)]


def test_variance_falls_back_on_null_and_zero(spark):
    rows = [(10, 3, 1), (0, 3, 1), (None, 3, 1), (None, None, 1), (10, 3, None)]
    df = spark.createDataFrame(rows, "base int, alt int, other int").select(
        measures.variance("base", "other", "alt").alias("minus"),
        measures.variance("base", "other", "alt", sign=+1).alias("plus"),
        measures.variance("base", "other").alias("plain"),
        measures.variance("base", "other", "other").alias("own"),
    )
    got = [tuple(None if v is None else float(v) for v in r) for r in df.collect()]
    assert got == [
        (9, 11, 9, 9), (2, 4, -1, 0), (2, 4, None, 0), (None, None, None, 0),
        (None, None, None, None),
    ]


def test_rounding_is_half_away_from_zero(spark):
    df = spark.sql("select 0.125BD a, -0.125BD b, 'x' t, 7 n")
    rounded = measures.round_figures(df)
    assert plain_rows(rounded) == [(0.13, -0.13, "x", 7)]
    assert rounded.schema["a"].dataType == df.schema["a"].dataType


def test_fill_touches_numbers_only(spark):
    df = spark.sql("select cast(null as decimal(28,8)) a, cast(null as string) t, cast(null as int) n")
    assert plain_rows(measures.fill_zero_numeric(df)) == [(0.0, None, 0)]


def test_exact_sums_do_not_depend_on_order(spark):
    df = spark.range(30000).selectExpr("cast(0.1 as double) x")
    sums = {
        df.repartition(n).agg(measures.total("x")).first()[0] for n in (1, 3, 8)
    }
    assert {float(s) for s in sums} == {3000.0}


def test_one_decimal_floor(spark):
    values = spark.sql("select 1.29BD x union all select -1.21BD")
    assert plain_rows(values.select(measures.one_decimal_floor("x"))) == [(-1.3,), (1.2,)]
