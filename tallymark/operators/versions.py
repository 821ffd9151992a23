"""Versions of a report batch: which is the latest, what is new, which number is next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.measures import fill_zero_numeric, round_figures
from tallymark.operators.keys import CODE, PERIOD, PERIOD_KEYS
from tallymark.sources.exports import upper_headers

DATE, RUN_NUMBER, MOST_RECENT, CHECKED_AT = "DATE", "TIMESRANTODAY", "MOSTRECENT", "DATETIME"
VERSION_COLUMNS = (MOST_RECENT, CHECKED_AT, RUN_NUMBER)
YES, NO = "YES", "NO"


def yes_no(condition: Column) -> Column:
    return F.when(condition, F.lit(YES)).otherwise(F.lit(NO))


def latest_runs(history: DataFrame) -> DataFrame:
    """Per period, the last run date and the highest run number of that date.

    Two hash aggregates: the first leaves one row per period and date, so neither
    needs a period's rows together, as a window would.
    """
    days = history.groupBy(*PERIOD_KEYS, DATE).agg(F.max(RUN_NUMBER).alias("day_run"))
    return days.groupBy(*PERIOD_KEYS).agg(
        F.max(DATE).alias("last_date"), F.max_by("day_run", DATE).alias("last_run")
    )


def flag_latest(history: DataFrame) -> DataFrame:
    """Mark the rows of each period's latest run YES, ties included, and the rest NO."""
    is_latest = (F.col(DATE) == F.col("last_date")) & (F.col(RUN_NUMBER) == F.col("last_run"))
    return (
        history.drop(MOST_RECENT)
        .join(latest_runs(history), PERIOD_KEYS, "left")
        .withColumn(MOST_RECENT, yes_no(is_latest))
        .drop("last_date", "last_run")
    )


def prepare_batch(report: DataFrame) -> DataFrame:
    """A report as it is compared and stored: no null figures, no blank codes, two digits."""
    named = upper_headers(report)
    return round_figures(fill_zero_numeric(named).where(F.trim(CODE) != ""))


def unseen_rows(batch: DataFrame, history: DataFrame) -> DataFrame:
    """Distinct batch rows that no version in the history has.

    The comparison covers every report column, the run date and period among them,
    so rows meet only within one period and date and their figures spread the keys.
    """
    return batch.subtract(round_figures(history.select(*batch.columns)))


def changed_periods(batch: DataFrame, history: DataFrame) -> DataFrame:
    """Periods of a batch with at least one unseen row."""
    return unseen_rows(batch, history).select(*PERIOD_KEYS).distinct()


def with_run_number(batch: DataFrame, history: DataFrame) -> DataFrame:
    """Number the batch's run: one more than the highest for its period and date, or 1."""
    on = [PERIOD, DATE]
    last = history.groupBy(*on).agg(F.max(RUN_NUMBER).alias("last_run"))
    number = (F.coalesce("last_run", F.lit(0)) + 1).cast("int")
    return batch.join(last, on, "left").withColumn(RUN_NUMBER, number).drop("last_run")
