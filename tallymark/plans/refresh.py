"""The scheduled job: prior period, current period, four history tables."""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tallymark.functions.fiscal import FiscalPeriod, period_of
from tallymark.lineage import settle, settle_all, side_by_side
from tallymark.operators import conform
from tallymark.operators.control import control_totals, nearest_snapshot, period_volumes
from tallymark.operators.history import HistoryStore, merge_distinct
from tallymark.operators.keys import PERIOD_KEYS
from tallymark.plans.audit import history_counts
from tallymark.plans.reports import Ledgers, build_reports
from tallymark.plans.specs import REPORTS
from tallymark.sources.landing import LandingZone, in_periods

CLOSED, OPEN = "YES", "NO"


def conform_landed(
    zone: LandingZone, closed: list[FiscalPeriod], opened: list[FiscalPeriod]
) -> Ledgers:
    """Conformed ledgers of closed and open periods.

    The profitability view is read for closed periods only; an open period takes its
    figures from a snapshot. Exports come from the period-end files of closed periods
    and from the running files of open ones.
    """
    plant, periods = zone.plant(), [*closed, *opened]
    return Ledgers(
        profitability=conform.conform_profitability(zone.profitability(closed)),
        extract=conform.conform_extract(
            zone.extract(periods), plant, zone.article(), zone.adjustment_type()
        ),
        cube=conform.conform_cube(zone.cube(periods), zone.account_map()),
        gl_export=conform.conform_gl_export(zone.gl_export(closed, opened)),
        physical_export=conform.conform_physical_export(zone.physical_export(closed, opened)),
        summary=conform.conform_summary(zone.summary(periods), plant),
    )


def _of_periods(df: DataFrame, periods: list[FiscalPeriod] | None) -> DataFrame:
    return df.where(in_periods("YEAR", "PERIOD", periods))


def from_nearest_snapshot(
    ledgers: Ledgers, volumes: DataFrame, snapshots: DataFrame
) -> Ledgers:
    """Open-period ledgers: the profitability figures of the snapshot nearest in volume."""
    controls = control_totals(ledgers.extract, volumes)
    chosen = nearest_snapshot(snapshots, controls)
    return ledgers._replace(profitability=conform.conform_snapshot(chosen))


def period_pair(
    closed: Ledgers, opened: Ledgers, run_date: dt.date
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Each report twice: for closed periods and for open ones."""
    ended = build_reports(closed, run_date, CLOSED)
    running = build_reports(opened, run_date, OPEN)
    return {name: (ended[name], running[name]) for name in ended}


def refresh(
    zone: LandingZone,
    store: HistoryStore,
    run_date: dt.date,
    run_ts: dt.datetime,
    run_id: str | None = None,
    between: Callable[[], None] | None = None,
) -> dict[str, int]:
    """One run. Returns the rows each history table gained.

    The prior period is stored in all four tables before the current one; ``between``
    is called in the middle, for counts.
    """
    current = period_of(zone.calendar(), run_date)
    prior = current.prior()
    volumes = period_volumes(zone.extract([current]))
    *settled, volumes = settle_all([*conform_landed(zone, [prior], [current]), volumes])
    both = Ledgers(*settled)

    def only(period: FiscalPeriod) -> Ledgers:
        return Ledgers(*[_of_periods(ledger, [period]) for ledger in both])

    opened = from_nearest_snapshot(
        only(current), volumes, zone.snapshots([current])
    ).settled("profitability")
    run_id = run_id or run_ts.strftime("%Y%m%dT%H%M%S")
    pairs = period_pair(only(prior), opened, run_date)

    def append(batch: int) -> list[int]:
        """Store one batch of every report; the tables do not depend on each other."""
        tasks = [
            partial(store.append, name, pair[batch], run_id, run_date, run_ts)
            for name, pair in pairs.items()
        ]
        return side_by_side(store.spark, tasks)

    ended = append(0)
    if between:
        between()
    added = dict(zip(pairs, map(sum, zip(ended, append(1)))))
    schemas = {spec.name: spec.stored_schema() for spec in REPORTS}
    side_by_side(
        store.spark,
        [partial(store.compact_if_due, name, schemas[name], run_date) for name in pairs],
    )
    return added


def refresh_sheets(
    spark: SparkSession,
    stored: dict[str, DataFrame],
    batches: dict[str, DataFrame],
    period: FiscalPeriod,
    run_date: dt.date,
    target: str,
) -> None:
    """Merge the batches into the stored sheets and write a new folder of sheets.

    ``target`` must be new: the stored sheets are read while it is written.
    """
    for name, batch in batches.items():
        merged = merge_distinct(stored[name], batch)
        merged.write.mode("errorifexists").parquet(f"{target}/{name}")
    info = spark.createDataFrame(
        [(period.year, period.period, run_date)], "YEAR int, PERIOD int, TIME date"
    )
    info.write.mode("errorifexists").parquet(f"{target}/info")


def refresh_periods(stored: str, batch: DataFrame) -> None:
    """Merge a batch into a stored sheet that is partitioned by year and period, in place.

    Only partitions the batch touches are read, merged and replaced; the others keep
    their files. The merged rows are settled first, so a write that is cut off can be repeated.
    """
    spark = batch.sparkSession
    touched = batch.select(*PERIOD_KEYS).distinct()
    sheet = spark.read.parquet(stored)
    periods = [FiscalPeriod(*r) for r in touched.collect()]
    merged = settle(merge_distinct(sheet.where(in_periods(*PERIOD_KEYS, periods)), batch.select(*sheet.columns)))
    dealt = merged.repartition(*PERIOD_KEYS)
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*PERIOD_KEYS).parquet(stored)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="reconcile the ledgers of one run date")
    parser.add_argument("--landing", required=True, help="folder of the landed extracts")
    parser.add_argument("--history", required=True, help="folder of the history tables")
    parser.add_argument("--run-date", required=True, type=dt.date.fromisoformat)
    parser.add_argument("--run-time", required=True, type=dt.datetime.fromisoformat)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("ledger-reconciliation").getOrCreate()
    store = HistoryStore(spark, args.history)
    for spec in REPORTS:
        store.create(spec.name, spec.stored_schema())
    history_counts(store).show()
    added = refresh(
        LandingZone(spark, args.landing), store, args.run_date, args.run_time,
        between=lambda: history_counts(store).show(),
    )
    for name, rows in added.items():
        print(f"{name}: {rows} rows added")
    history_counts(store).show()


if __name__ == "__main__":
    main()
