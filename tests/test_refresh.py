"""The scheduled job end to end, on a landing zone written from the smallest sample."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from frames import plain_rows
from tallymark.checks.standins import Samples
from tallymark.functions.fiscal import FiscalPeriod
from tallymark.operators.history import HistoryStore
from tallymark.operators.versions import prepare_batch
from tallymark.plans import refresh as job
from tallymark.plans.audit import history_counts
from tallymark.plans.reports import build_reports
from tallymark.plans.specs import REPORTS
from tallymark.sources.accounts import default_account_map
from tallymark.sources.landing import LandingZone, in_periods

FOLDER = "/root/testdata/sf0.001"
CURRENT, PRIOR = FiscalPeriod(2019, 1), FiscalPeriod(2018, 12)
MORNING = dt.datetime(2019, 1, 15, 8)


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing"))
    samples = Samples(spark, FOLDER)

    def land(name, df, *partitions):
        df.write.partitionBy(*partitions).parquet(f"{root}/{name}")

    def of_run(df, year, period):
        return df.where(in_periods(year, period, [PRIOR, CURRENT, FiscalPeriod(2018, 11)]))

    keys = ["2018011", "2018012", "2019001"]
    land("extract", of_run(samples.extract(), "year", "period"), "year", "period")
    land("summary", of_run(samples.summary(), "fiscal_year", "PERIOD"), "fiscal_year", "PERIOD")
    land("cube", samples.cube().where(F.col("FISCPER").isin(keys)), "FISCPER")
    view = samples.profitability().where(F.col("FiscalYearPeriod").isin(keys))
    view = view.withColumn("CurrencyType", F.lit("10"))
    other = view.withColumn("CurrencyType", F.lit("00"))
    land("profitability", view.unionByName(other), "FiscalYearPeriod", "CurrencyType")
    land("snapshots", of_run(samples.snapshots(), "YEAR", "PERIOD"), "YEAR", "PERIOD", "Number")
    for name in ("gl_export", "physical_export"):
        # Both files of every period; the one a run must not take has doubled figures.
        ended = of_run(getattr(samples, name)(), "YEAR", "PERIOD")
        kinds = {f.name: f.dataType for f in ended.schema.fields}
        running = ended.select(
            *[
                (F.col(f"`{c}`") * 2).cast(kind).alias(c)
                if kind.typeName() == "decimal" else F.col(f"`{c}`")
                for c, kind in kinds.items()
            ]
        )
        closed = F.col("YEAR") == PRIOR.year
        files = [
            (ended.where(closed), "YES"), (running.where(closed), "NO"),
            (running.where(~closed), "YES"), (ended.where(~closed), "NO"),
        ]
        for rows, flag in files:
            rows.withColumn("PERIOD_END", F.lit(flag)).write.mode("append").partitionBy(
                "YEAR", "PERIOD", "PERIOD_END"
            ).parquet(f"{root}/{name}")
    land("plant", samples.plant())
    land("article", samples.article())
    land("adjustment_type", samples.adjustment_type())
    land("account_map", default_account_map(spark))
    land("calendar", samples.calendar())
    return LandingZone(spark, root)


def test_refresh_appends_both_periods_once(spark, landing, tmp_path):
    store = HistoryStore(spark, str(tmp_path))
    run_date = next(
        r.USADAT
        for r in landing.calendar().where("year(USADAT) = 2019 and PERIOD = 1").orderBy("USADAT").collect()
    )
    middle = []
    added = job.refresh(
        landing, store, run_date, MORNING,
        between=lambda: middle.append({n: rows for n, rows, _ in plain_rows(history_counts(store))}),
    )
    assert set(added) == {"physical", "gl", "nsi", "cogs"} and all(added.values())
    again = job.refresh(landing, store, run_date, MORNING + dt.timedelta(hours=1))
    assert set(again.values()) == {0}

    counts = {name: rows for name, rows, _ in plain_rows(history_counts(store))}
    assert counts == added

    ledgers = job.conform_landed(landing, [PRIOR], [])
    expected = build_reports(ledgers, run_date, "YES")
    for spec in REPORTS:
        batch = prepare_batch(expected[spec.name])
        assert batch.dtypes == [
            (f.name, f.dataType.simpleString()) for f in spec.stored_schema().fields
        ]
        history = store.read(spec.name, spec.stored_schema())
        stored = history.where(F.col("PERIODEND") == "YES").select(*batch.columns)
        assert plain_rows(stored) == plain_rows(batch)
        assert middle[0][spec.name] == stored.count() < added[spec.name]
        ends = history.groupBy("YEAR", "PERIOD", "PERIODEND", "MOSTRECENT").count().collect()
        assert {tuple(r)[:4] for r in ends} == {(2018, 12, "YES", "YES"), (2019, 1, "NO", "YES")}


def test_scans_of_a_run_are_pruned(spark, landing):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    ledgers = job.conform_landed(landing, [PRIOR], [CURRENT])
    for name in ledgers._fields:
        plan = getattr(ledgers, name)._jdf.queryExecution().executedPlan().toString()
        fact = [p.split("PushedFilters")[0] for p in plan.split("PartitionFilters: [")[1:]]
        assert any("2018" in p for p in fact), name
        # An open period takes its figures from a snapshot, so the view is not read for it.
        assert any("2019" in p for p in fact) == (name != "profitability"), name


def test_each_period_takes_its_own_export_file(spark, landing):
    ledgers = job.conform_landed(landing, [PRIOR], [CURRENT])
    samples = Samples(spark, FOLDER)
    for name in ("gl_export", "physical_export"):
        expected = samples.ledger(name).where(in_periods("YEAR", "PERIOD", [PRIOR, CURRENT]))
        assert plain_rows(getattr(ledgers, name)) == plain_rows(expected)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
