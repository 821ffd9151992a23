"""Stored snapshots with their totals, and sheets of which only touched periods are rewritten."""

from __future__ import annotations

from pyspark.sql import functions as F

from frames import RUN_DATE, plain_rows
from tallymark.operators.control import nearest_snapshot
from tallymark.operators.history import merge_distinct
from tallymark.operators.versions import prepare_batch
from tallymark.plans.refresh import refresh_periods
from tallymark.sources.snapshots import SnapshotStore
from test_history import batch

SNAPSHOT = "YEAR int, PERIOD int, Number int, ProfitCenterCode string, Volume decimal(28,8)"
CONTROL = "YEAR int, PERIOD int, CONTROLTOTAL decimal(38,8)"


def snapshots(spark, rows):
    frame = spark.createDataFrame(rows, SNAPSHOT.replace("decimal(28,8)", "int"))
    return frame.withColumn("Volume", F.col("Volume").cast("decimal(28,8)"))


def controls(spark, rows):
    frame = spark.createDataFrame(rows, CONTROL.replace("decimal(38,8)", "int"))
    return frame.withColumn("CONTROLTOTAL", F.col("CONTROLTOTAL").cast("decimal(38,8)"))


def test_stored_snapshots_are_read_by_partition(spark, tmp_path):
    rows = [(2018, p, n, c, 10 * n + i) for p in (4, 5) for n in (1, 3, 7) for i, c in enumerate("ab")]
    given, store = snapshots(spark, rows), SnapshotStore(spark, str(tmp_path))
    store.add(given.where("Number < 7"))
    store.add(given.where("Number = 7"))
    for wanted in ([(2018, 4, 60), (2018, 5, 1)], [(2018, 5, 61), (2019, 1, 5)], [(2019, 1, 5)]):
        asked = controls(spark, wanted)
        found, columns = store.nearest(asked), ["YEAR", "PERIOD", "Number", "ProfitCenterCode", "Volume"]
        assert plain_rows(found, *columns) == plain_rows(nearest_snapshot(given, asked), *columns)
    one = store.nearest(controls(spark, [(2018, 4, 60)]))
    plan = one._jdf.queryExecution().executedPlan()
    one.collect()
    metrics = [n.metrics().get("numPartitions").get().value() for n in _scans(one)]
    assert metrics == [1] and "PartitionFilters: [" in plan.toString()


def _scans(df):
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    return [leaves.apply(i) for i in range(leaves.size())]


def test_a_number_stored_again_is_replaced(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    store.add(snapshots(spark, [(2018, 4, 1, "a", 5), (2018, 4, 2, "a", 9)]))
    store.add(snapshots(spark, [(2018, 4, 1, "a", 100), (2018, 4, 1, "b", 1)]))
    assert plain_rows(store.totals(), "Number", "SNAPSHOTVOLUME") == [(1, 101.0), (2, 9.0)]
    assert plain_rows(store.nearest(controls(spark, [(2018, 4, 90)])), "ProfitCenterCode", "Volume") == [("a", 100.0), ("b", 1.0)]


def test_only_touched_periods_of_a_sheet_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "sheet")
    sheet = prepare_batch(batch(spark, ("001", 1, 4), ("002", 2, 5), ("003", 3, 6)))
    sheet = sheet.withColumns({"TIMESRANTODAY": F.lit(1), "MOSTRECENT": F.lit("YES")})
    sheet.repartition(1).write.partitionBy("YEAR", "PERIOD").parquet(path)
    files = lambda p: sorted(f.name for f in (tmp_path / "sheet").glob(f"YEAR=2018/PERIOD={p}/*.parquet"))
    before = {p: files(p) for p in (4, 5, 6)}
    added = prepare_batch(batch(spark, ("001", 1, 4), ("002", 9, 5), ("004", 4, 7), date=RUN_DATE))
    added = added.withColumns({"TIMESRANTODAY": F.lit(2), "MOSTRECENT": F.lit(None).cast("string")})
    whole = [tuple(map(str, r)) for r in merge_distinct(sheet, added.select(*sheet.columns)).select(*sorted(sheet.columns)).collect()]
    refresh_periods(path, added)
    assert files(6) == before[6] and not set(files(5)) & set(before[5]) and files(7)
    stored = spark.read.parquet(path)
    assert sorted(tuple(map(str, r)) for r in stored.select(*sorted(sheet.columns)).collect()) == sorted(whole)
    assert plain_rows(stored.where("PERIOD = 5"), "VOLUME", "MOSTRECENT") == [(2.0, "NO"), (9.0, "YES")]
