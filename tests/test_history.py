from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from frames import MAY, RUN_DATE, plain_rows
from tallymark.operators.control import control_totals, nearest_snapshot, period_volumes
from tallymark.operators.history import HistoryStore, append_changed, merge_distinct
from tallymark.operators.versions import (
    flag_latest,
    prepare_batch,
    unseen_rows,
    with_run_number,
)
from tallymark.plans.refresh import refresh_sheets

FIRST, SECOND = dt.datetime(2018, 5, 31, 9), dt.datetime(2018, 5, 31, 10)
SCHEMA = (
    "CODE string, COSTCENTER string, VOLUME decimal(28,8), DATE date, PERIOD int, YEAR int,"
    " System string"
)


def batch(spark, *rows, date=RUN_DATE):
    """Report rows given as (code, volume, period)."""
    from frames import decimal

    full = [(c, f"name {c}", decimal(v), date, p, 2018, "CONA") for c, v, p in rows]
    return spark.createDataFrame(full, SCHEMA)


def empty_history(spark):
    return spark.createDataFrame(
        [], SCHEMA + ", MOSTRECENT string, DATETIME timestamp, TIMESRANTODAY int"
    )


def summary(history):
    return plain_rows(history, "PERIOD", "CODE", "VOLUME", "DATE", "TIMESRANTODAY", "MOSTRECENT")


def test_batch_is_filled_rounded_and_cleaned(spark):
    given = batch(spark, ("001", 1.005, 4), ("   ", 2, 4), ("", 2, 4), ("002", None, 4))
    prepared = prepare_batch(given)
    assert prepared.columns[-1] == "SYSTEM"
    assert plain_rows(prepared, "CODE", "VOLUME") == [("001", 1.01), ("002", 0.0)]


def test_same_batch_appends_once(spark):
    given = batch(spark, ("001", 1, 4), ("002", 2, 4))
    once = append_changed(empty_history(spark), given, FIRST)
    twice = append_changed(once, given, SECOND)
    assert summary(twice) == summary(once) and once.count() == 2
    # The check is stamped all the same.
    assert {r.DATETIME for r in twice.select("DATETIME").collect()} == {SECOND}


@pytest.mark.parametrize("moved, appended", [(0.001, 0), (0.01, 2)])
def test_a_move_counts_from_two_digits_on(spark, moved, appended):
    before = append_changed(empty_history(spark), batch(spark, ("001", 1, 4), ("002", 2, 4)), FIRST)
    after = append_changed(before, batch(spark, ("001", 1 + moved, 4), ("002", 2, 4)), SECOND)
    assert after.count() == 2 + appended
    if appended:  # the whole batch, as the date's second run; its old rows demoted
        assert summary(after) == [
            (4, "001", 1.0, RUN_DATE, 1, "NO"), (4, "001", 1.01, RUN_DATE, 2, "YES"),
            (4, "002", 2.0, RUN_DATE, 1, "NO"), (4, "002", 2.0, RUN_DATE, 2, "YES"),
        ]


def test_next_day_appends_and_other_periods_stay(spark):
    first = batch(spark, ("001", 1, 4), ("001", 5, 5))
    before = append_changed(empty_history(spark), first, FIRST)
    next_day = RUN_DATE + dt.timedelta(days=1)
    after = append_changed(before, batch(spark, ("001", 1, 4), date=next_day), SECOND)
    assert summary(after) == [
        (4, "001", 1.0, RUN_DATE, 1, "NO"),
        (4, "001", 1.0, next_day, 1, "YES"),
        (5, "001", 5.0, RUN_DATE, 1, "YES"),
    ]


def test_only_the_changed_period_of_a_batch_is_appended(spark):
    before = append_changed(empty_history(spark), batch(spark, ("001", 1, 4), ("001", 5, 5)), FIRST)
    after = append_changed(before, batch(spark, ("001", 1, 4), ("001", 6, 5)), SECOND)
    assert [r[0] for r in summary(after)] == [4, 5, 5]


def test_null_text_is_no_difference(spark):
    unnamed = batch(spark, ("001", 1, 4)).withColumn("COSTCENTER", F.lit(None).cast("string"))
    once = append_changed(empty_history(spark), unnamed, FIRST)
    assert append_changed(once, unnamed, SECOND).count() == 1
    assert unseen_rows(prepare_batch(unnamed), once).count() == 0


def test_run_number_counts_per_period_and_date(spark):
    history = append_changed(empty_history(spark), batch(spark, ("001", 1, 4)), FIRST)
    numbered = with_run_number(prepare_batch(batch(spark, ("1", 1, 4), ("1", 1, 5))), history)
    assert plain_rows(numbered, "PERIOD", "TIMESRANTODAY") == [(4, 2), (5, 1)]


def test_latest_flag_marks_all_ties(spark):
    day = dt.date(2018, 4, 30)
    rows = [
        (2018, 4, day, 1, "a"), (2018, 4, day, 2, "b"), (2018, 4, day, 2, "c"),
        (2018, 4, day - dt.timedelta(days=1), 9, "d"), (2017, 4, day, 1, "e"),
    ]
    history = spark.createDataFrame(rows, "YEAR int, PERIOD int, DATE date, TIMESRANTODAY int, id string")
    assert plain_rows(flag_latest(history), "id", "MOSTRECENT") == [
        ("a", "NO"), ("b", "YES"), ("c", "YES"), ("d", "NO"), ("e", "YES"),
    ]


def test_merge_distinct_drops_repeats(spark):
    sheet = prepare_batch(batch(spark, ("001", 1, 4))).withColumn("TIMESRANTODAY", F.lit(1))
    stored = sheet.withColumn("MOSTRECENT", F.lit("YES"))
    incoming = sheet.withColumn("MOSTRECENT", F.lit(None).cast("string"))
    later = incoming.withColumn("DATE", F.date_add("DATE", 1))
    merged = merge_distinct(stored, incoming.unionByName(later))
    assert plain_rows(merged, "DATE", "MOSTRECENT") == [
        (RUN_DATE, "NO"), (RUN_DATE + dt.timedelta(days=1), "YES"),
    ]


def test_refresh_sheets_writes_new_folders(spark, tmp_path):
    sheet = prepare_batch(batch(spark, ("001", 1, 4))).withColumn("TIMESRANTODAY", F.lit(1))
    sheet = sheet.withColumn("MOSTRECENT", F.lit("YES"))
    target = str(tmp_path / "v2")
    refresh_sheets(spark, {"physical": sheet}, {"physical": sheet}, MAY, RUN_DATE, target)
    assert spark.read.parquet(f"{target}/physical").count() == 1
    assert plain_rows(spark.read.parquet(f"{target}/info")) == [(2018, 5, RUN_DATE)]


def test_store_follows_the_append_rule(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path))
    first = batch(spark, ("001", 1, 4), ("002", 2, 4))
    schema = prepare_batch(first).schema
    assert store.append("physical", first, "r1", RUN_DATE, FIRST) == 2
    assert store.append("physical", first, "r2", RUN_DATE, SECOND) == 0
    moved = batch(spark, ("001", 1.5, 4), ("002", 2, 4))
    assert store.append("physical", moved, "r3", RUN_DATE, SECOND) == 2
    history = store.read("physical", schema)
    pure = append_changed(append_changed(empty_history(spark), first, FIRST), moved, SECOND)
    assert summary(history) == summary(pure)
    assert {r.DATETIME for r in history.select("DATETIME").collect()} == {SECOND}


def dead_attempt(spark, tmp_path, *rows):
    """Rows of an attempt that died before it was logged."""
    lost = prepare_batch(batch(spark, *rows)).withColumn("TIMESRANTODAY", F.lit(2))
    lost.drop("DATE").write.parquet(f"{tmp_path}/physical/DATE={RUN_DATE}/ATTEMPT=r2-dead")


@pytest.mark.parametrize("figure, added", [(1, 0), (9, 1), (5, 1)])
def test_a_dead_attempt_is_never_seen(spark, tmp_path, figure, added):
    store = HistoryStore(spark, str(tmp_path))
    first = batch(spark, ("001", 1, 4))
    schema = prepare_batch(first).schema
    store.append("physical", first, "r1", RUN_DATE, FIRST)
    dead_attempt(spark, tmp_path, ("001", 9, 4))
    assert summary(store.read("physical", schema)) == [(4, "001", 1.0, RUN_DATE, 1, "YES")]
    assert store.append("physical", batch(spark, ("001", figure, 4)), "r2", RUN_DATE, SECOND) == added
    figures = {r[2]: r[5] for r in summary(store.read("physical", schema))}
    assert figures == ({1.0: "YES"} if not added else {1.0: "NO", float(figure): "YES"})


def test_a_repeated_run_id_never_takes_rows_away(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path))
    first = batch(spark, ("001", 1, 4))
    schema = prepare_batch(first).schema
    assert store.append("physical", first, "r1", RUN_DATE, FIRST) == 1
    assert store.append("physical", first, "r1", RUN_DATE, SECOND) == 0
    assert [r[2] for r in summary(store.read("physical", schema))] == [1.0]
    assert store.append("physical", batch(spark, ("001", 5, 4)), "r1", RUN_DATE, SECOND) == 1
    assert [(r[2], r[5]) for r in summary(store.read("physical", schema))] == [(1.0, "NO"), (5.0, "YES")]
    assert sorted(r.APPENDED for r in store.log("physical").collect()) == [0, 1, 1]
    assert store.rows_logged("physical").first()[0] == 2


def test_random_run_orders_give_the_pure_history(spark, tmp_path):
    rng = random.Random(11)
    store, pure = HistoryStore(spark, str(tmp_path)), empty_history(spark)
    for step in range(7):
        date = RUN_DATE - dt.timedelta(days=rng.randrange(3))
        rows = [("001", rng.choice([1, 2]), p) for p in rng.sample([4, 5], rng.choice([1, 2]))]
        given, at = batch(spark, *rows, date=date), FIRST + dt.timedelta(minutes=step)
        store.append("physical", given, f"r{rng.randrange(3)}", date, at)
        grown = append_changed(pure, given, at)
        pure = spark.createDataFrame(grown.collect(), grown.schema)
    history = store.read("physical", prepare_batch(given).schema)
    assert summary(history) == summary(pure)
    assert {r.DATETIME for r in history.collect()} == {at}


def test_an_earlier_run_date_after_a_later_one_is_current(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path))
    day_before = RUN_DATE - dt.timedelta(days=1)
    store.append("physical", batch(spark, ("001", 1, 4)), "r1", RUN_DATE, FIRST)
    given = batch(spark, ("001", 2, 4), date=day_before)
    store.append("physical", given, "r2", day_before, SECOND)
    history = store.read("physical", prepare_batch(given).schema)
    assert {r[2]: r[5] for r in summary(history)} == {1.0: "NO", 2.0: "YES"}


def test_reading_writes_nothing(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path))
    schema = prepare_batch(batch(spark)).schema
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.read("physical", schema)
    assert list(tmp_path.iterdir()) == []
    store.create("physical", schema)
    before = sorted(tmp_path.rglob("*"))
    assert store.read("physical", schema).count() == 0
    assert sorted(tmp_path.rglob("*")) == before


def test_only_rows_of_the_run_date_are_taken(spark, tmp_path):
    other = batch(spark, ("001", 1, 4), date=RUN_DATE - dt.timedelta(days=1))
    with pytest.raises(ValueError, match="another date"):
        HistoryStore(spark, str(tmp_path)).append("physical", other, "r1", RUN_DATE, FIRST)


def test_store_lists_only_the_run_date_to_compare(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path))
    first = batch(spark, ("001", 1, 4))
    schema = prepare_batch(first).schema
    store.append("physical", first, "r1", RUN_DATE, FIRST)
    files = store.stored("physical", schema, RUN_DATE).inputFiles()
    assert files and all(f"DATE={RUN_DATE}" in f or "/log/" in f for f in files)


EXTRACT = "RSMASG string, RSPERD string, RSQTY double, year int, period int"


def control_fixture(spark, strays=True):
    rows = [("11", "2018005", 100.0, 2018, 5), ("30", "2018004", 50.0, 2018, 5)]
    if strays:
        rows += [("18", "2018004", 7.0, 2018, 5), ("41", "2018003", 3.0, 2018, 5)]
    extract = spark.createDataFrame(rows, EXTRACT)
    conformed = spark.createDataFrame(
        [(2018, 5, "001", 60.0), (2018, 5, "002", 50.0)],
        "YEAR int, PERIOD int, CODE string, VOLUMEPHYSICAL double",
    )
    return control_totals(conformed, period_volumes(extract))


def test_control_total_takes_out_every_stray_period(spark):
    columns = ["TOTALVOLUME", "PERIODKEYS", "STRAYVOLUME", "CONTROLTOTAL"]
    assert plain_rows(control_fixture(spark), *columns) == [(110.0, 3, 10.0, 100.0)]
    assert plain_rows(control_fixture(spark, False), *columns) == [(110.0, 1, None, 110.0)]


def test_nearest_snapshot_takes_the_lowest_of_a_tie(spark):
    rows = [(3, "a", 95.0), (7, "a", 60.0), (7, "b", 45.0), (9, "a", 300.0), (12, "a", None)]
    snapshots = spark.createDataFrame(
        [(n, c, v, 2018, 5) for n, c, v in rows],
        "Number int, ProfitCenterCode string, Volume double, YEAR int, PERIOD int",
    )
    chosen = nearest_snapshot(snapshots, control_fixture(spark))
    assert plain_rows(chosen, "Number", "ProfitCenterCode") == [(3, "a")]
