"""The stored history: runs at once, pointers, rewriting, fingerprints."""

from __future__ import annotations

import datetime as dt
import random
import shutil
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from frames import RUN_DATE, plain_rows
from tallymark.operators.commits import CommitLog, State
from tallymark.operators.history import HistoryStore, append_changed, fingerprints
from tallymark.operators.versions import prepare_batch
from test_history import FIRST, SECOND, batch, empty_history, summary

DAY = dt.timedelta(days=1)


class Interrupted(HistoryStore):
    """A store in whose first attempt to commit another run comes first."""

    def __init__(self, spark, root, first):
        super().__init__(spark, root)
        self.first = first

    def _log(self, report):
        log, store = super()._log(report), self

        class Late(CommitLog):
            def commit(self, entry):
                run, store.first = store.first, None
                if run:
                    run()
                return super().commit(entry)

        log.__class__ = Late
        return log


@pytest.fixture
def store(spark, tmp_path):
    return HistoryStore(spark, str(tmp_path))


@pytest.fixture
def schema(spark):
    return prepare_batch(batch(spark)).schema


@pytest.mark.parametrize(
    ("other", "shift"),
    [((("001", 1, 4),), 0), ((("001", 2, 4),), 0), ((("001", 7, 5),), 0), ((("001", 1, 4),), 1)],
    ids=["the same rows", "other figures", "another period", "another date"],
)
def test_of_two_runs_at_once_the_loser_decides_again(spark, store, schema, other, shift):
    mine, date = batch(spark, ("001", 1, 4)), RUN_DATE + shift * DAY
    theirs = batch(spark, *other, date=date)

    def first():
        store.append("physical", theirs, "theirs", date, FIRST)

    late = Interrupted(spark, store.root, first)
    added = late.append("physical", mine, "mine", RUN_DATE, SECOND)
    pure = append_changed(append_changed(empty_history(spark), theirs, FIRST), mine, SECOND)
    assert summary(store.read("physical", schema)) == summary(pure)
    assert added == (0 if (other, shift) == ((("001", 1, 4),), 0) else 1)
    assert sorted(r.SEQ for r in store.log("physical").collect()) == [1, 2]
    assert store.rows_logged("physical").first()[0] == pure.count()


def test_many_runs_at_once_lose_nothing(spark, store, schema):
    store.create("physical", schema)

    def run(n):
        return store.append("physical", batch(spark, ("001", n, 4)), f"r{n}", RUN_DATE, FIRST)

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(run, range(4))) == [1] * 4
    rows = summary(store.read("physical", schema))
    assert sorted(r[2] for r in rows) == [0, 1, 2, 3] and sorted(r[4] for r in rows) == [1, 2, 3, 4]
    assert [r[4] for r in rows if r[5] == "YES"] == [4]


def test_a_number_is_given_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    log.create()
    entry = {"SEQ": 1, "KIND": "append", "RUN": "a", "ATTEMPT": None, "DATE": "2018-05-31", "CHECKED": "x", "APPENDED": 0, "PERIODS": [], "SEEN": []}
    assert log.commit(entry) and not log.commit(entry | {"RUN": "b"})
    assert [r.RUN for r in log.table().collect()] == ["a"]
    assert [p.name for p in (tmp_path / "log").iterdir() if p.name[0] not in "._"] == [f"{1:020d}.json"]


def test_current_rows_come_from_the_folders_that_hold_them(spark, store, schema):
    for day, rows in enumerate([[("001", 1, 4), ("001", 5, 5)], [("001", 2, 4)], [("001", 3, 4)]]):
        date = RUN_DATE + day * DAY
        store.append("physical", batch(spark, *rows, date=date), f"r{day}", date, FIRST)
    current = store.current("physical", schema)
    assert plain_rows(current, "PERIOD", "VOLUME", "DATE") == [(4, 3.0, RUN_DATE + 2 * DAY), (5, 5.0, RUN_DATE)]
    assert len(current.inputFiles()) == 2 and not any("ATTEMPT=r1" in f for f in current.inputFiles())
    one = store.current("physical", schema, [(2018, 4)])
    assert plain_rows(one, "VOLUME") == [(3.0,)] and all("ATTEMPT=r2" in f for f in one.inputFiles())
    plan = store.read("physical", schema)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan


def test_random_run_orders_with_rewriting_between(spark, store, schema):
    rng, pure = random.Random(5), empty_history(spark)
    for step in range(8):
        date = RUN_DATE - rng.randrange(3) * DAY
        rows = [("001", rng.choice([1, 2]), p) for p in rng.sample([4, 5], rng.choice([1, 2]))]
        given, at = batch(spark, *rows, date=date), FIRST + dt.timedelta(minutes=step)
        store.append("physical", given, f"r{step}", date, at)
        grown = append_changed(pure, given, at)
        pure = spark.createDataFrame(grown.collect(), grown.schema)
        if step % 3 == 2:
            store.compact("physical", schema, RUN_DATE + rng.randrange(2) * DAY)
    history = store.read("physical", schema)
    assert summary(history) == summary(pure)
    yes = pure.where("MOSTRECENT = 'YES'")
    columns = ["PERIOD", "CODE", "VOLUME", "DATE", "TIMESRANTODAY"]
    assert plain_rows(store.current("physical", schema), *columns) == plain_rows(yes, *columns)
    assert {r.DATETIME for r in history.collect()} == {at}


def test_an_unchanged_run_reads_no_stored_rows(spark, store, schema, tmp_path):
    rows = batch(spark, ("001", 1, 4), ("002", 2, 4), ("001", 3, 5))
    assert store.append("physical", rows, "r1", RUN_DATE, FIRST) == 3
    shutil.move(tmp_path / "physical", tmp_path / "away")  # reading would fail
    assert store.append("physical", rows.repartition(3), "r2", RUN_DATE, SECOND) == 0
    shutil.move(tmp_path / "away", tmp_path / "physical")
    # Fewer rows make another fingerprint: their comparison finds nothing new, once.
    fewer = rows.where("CODE = '001'")
    assert store.append("physical", fewer, "r3", RUN_DATE, SECOND) == 0
    shutil.move(tmp_path / "physical", tmp_path / "away")
    assert store.append("physical", fewer, "r4", RUN_DATE, SECOND) == 0


def test_fingerprints_tell_rows_apart(spark):
    def of(*rows):
        frame = spark.createDataFrame([(2018, 4, *r) for r in rows], "YEAR int, PERIOD int, a string, b string, c int")
        frame = frame.withColumn("c", F.col("c").cast("decimal(28,2)"))
        return fingerprints(frame.repartition(3)).first()["print"]

    base = of(("x", None, 1), ("y", "z", 2))
    assert base == of(("y", "z", 2), ("x", None, 1))
    others = [of((None, "x", 1), ("y", "z", 2)), of(("x", None, 1)), of(("x", None, 1), ("y", "z", 2), ("y", "z", 2)), of(("x", None, None), ("y", "z", 2)), of(("x", "", 1), ("y", "z", 2))]
    assert len({base, *others}) == 6


def small_runs(spark, store, schema, count):
    """So many committed runs, each of a date of its own, written in one go."""
    rows = spark.range(count).select(
        F.lit("001").alias("CODE"), F.lit("name").alias("COSTCENTER"), F.col("id").cast("decimal(28,8)").alias("VOLUME"),
        (F.col("id") % 12 + 1).cast("int").alias("PERIOD"), F.lit(2018).alias("YEAR"), F.lit("CONA").alias("SYSTEM"),
        F.lit(1).alias("TIMESRANTODAY"), F.date_add(F.lit(RUN_DATE), F.col("id").cast("int")).alias("DATE"),
        F.concat(F.lit("r"), "id").alias("ATTEMPT"),
    )
    rows.coalesce(1).write.partitionBy("DATE", "ATTEMPT").parquet(f"{store.root}/physical")
    store.create("physical", schema)
    log = store._log("physical")
    for n in range(count):
        date = (RUN_DATE + n * DAY).isoformat()
        entry = {"SEQ": n + 1, "KIND": "append", "RUN": f"r{n}", "ATTEMPT": f"r{n}", "DATE": date, "CHECKED": str(FIRST), "APPENDED": 1, "PERIODS": [[2018, n % 12 + 1, f"p{n}"]], "SEEN": []}
        assert log.commit(entry)


def test_many_small_runs_are_read_from_few_files(spark, store, schema):
    small_runs(spark, store, schema, 500)
    before = summary(store.read("physical", schema))
    open_reader = store.read("physical", schema)
    assert store.compact_if_due("physical", schema, RUN_DATE + 500 * DAY)
    history = store.read("physical", schema)
    assert len(before) == 500 and summary(history) == before == summary(open_reader)
    assert len(history.inputFiles()) <= 4 and len(store.current("physical", schema).inputFiles()) <= 2
    assert store.rows_logged("physical").first()[0] == 500
    # The log is read from its checkpoint on, and further runs go on from there.
    log = store._log("physical")
    seen = []
    read = log._read
    log._read = lambda names: seen.extend(names := list(names)) or read(names)
    assert log.state().seq == 501 and len(seen) == 1
    date = RUN_DATE + 3 * DAY  # a date that has been rewritten
    assert store.append("physical", batch(spark, ("001", 3, 4), date=date).replace("name 001", "name", subset="COSTCENTER"), "again", date, SECOND) == 0
    assert store.append("physical", batch(spark, ("001", 9, 4), date=date), "new", date, SECOND) == 1
    new = [r for r in summary(store.read("physical", schema)) if r[3] == date]
    assert [(r[2], r[4]) for r in new] == [(3.0, 1), (9.0, 2)] and new[1][5] == "YES"
    assert not store.compact_if_due("physical", schema, RUN_DATE + 500 * DAY)


def test_a_run_beside_a_rewriting_keeps_its_rows(spark, store, schema):
    for n in range(3):
        store.append("physical", batch(spark, ("001", n, 4), date=RUN_DATE + n * DAY), f"r{n}", RUN_DATE + n * DAY, FIRST)
    date = RUN_DATE + 5 * DAY

    def first():
        store.append("physical", batch(spark, ("001", 9, 4), date=date), "beside", date, SECOND)

    assert Interrupted(spark, store.root, first).compact("physical", schema, date)
    rows = summary(store.read("physical", schema))
    assert [(r[2], r[5]) for r in rows] == [(0.0, "NO"), (1.0, "NO"), (2.0, "NO"), (9.0, "YES")]

    def rewritten():
        store.compact("physical", schema, date + DAY)

    assert not Interrupted(spark, store.root, rewritten).compact("physical", schema, date + DAY)
    assert summary(store.read("physical", schema)) == rows


def test_states_survive_their_file():
    state = State(3, "t", 9, {"a": ("2018-05-31", 2)}, {"c": ["2018-05-30"]}, {(2018, 4): (2, "a")}, {("2018-05-31", 2018, 4): {"p", "q"}})
    assert State.from_json(state.to_json()) == state
