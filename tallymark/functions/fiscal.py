"""Dates and fiscal periods. The run date is always an argument, never the clock."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.measures import ColumnLike, as_column

# Fixed value: spreadsheets number days from 1900-01-01 as day 1 and count a
# 29 February 1900 that never was, hence two days off.
SPREADSHEET_ORIGIN = dt.date(1900, 1, 1)
SPREADSHEET_OFFSET = 2

PERIODS_PER_YEAR = 12


class FiscalPeriod(NamedTuple):
    year: int
    period: int

    def prior(self) -> FiscalPeriod:
        if self.period == 1:
            return FiscalPeriod(self.year - 1, PERIODS_PER_YEAR)
        return FiscalPeriod(self.year, self.period - 1)


def prior_year(year: ColumnLike, period: ColumnLike) -> Column:
    year = as_column(year)
    return F.when(as_column(period) == 1, year - 1).otherwise(year)


def prior_period(period: ColumnLike) -> Column:
    period = as_column(period)
    return F.when(period == 1, F.lit(PERIODS_PER_YEAR)).otherwise(period - 1)


def epoch_days(date: ColumnLike) -> Column:
    return F.unix_date(as_column(date))


def date_of_epoch_days(days: ColumnLike) -> Column:
    return F.date_from_unix_date(as_column(days))


def date_of_serial(serial: ColumnLike) -> Column:
    """Spreadsheet serial day number to date."""
    origin = F.lit(SPREADSHEET_ORIGIN)
    return F.date_sub(F.date_add(origin, as_column(serial).cast("int")), SPREADSHEET_OFFSET)


def day_stamp(date: ColumnLike) -> Column:
    return F.date_format(as_column(date), "yyyyMMdd")


def timestamp_literal(stamp: dt.datetime | str) -> Column:
    text = stamp.isoformat(sep=" ") if isinstance(stamp, dt.datetime) else stamp
    return F.lit(text).cast("timestamp")


def with_fiscal_period(df: DataFrame, date_col: str, calendar: DataFrame) -> DataFrame:
    """Give every row the fiscal period of its date and that date's calendar year."""
    lookup = calendar.select(F.col("USADAT").alias(date_col), "PERIOD").dropDuplicates([date_col])
    return df.join(lookup, date_col, "left").withColumn("YEAR", F.year(date_col))


def period_of(calendar: DataFrame, run_date: dt.date) -> FiscalPeriod:
    """Fiscal period of one run date.

    Reads one calendar row to the driver, so that the scans of the run can be
    pruned by literal partition values.
    """
    row = calendar.where(F.col("USADAT") == F.lit(run_date)).select("PERIOD").first()
    if row is None:
        raise ValueError(f"the fiscal calendar has no row for {run_date}")
    return FiscalPeriod(run_date.year, int(row["PERIOD"]))
