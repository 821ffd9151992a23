"""History of report batches: append only what changed, demote what it replaces."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.fiscal import timestamp_literal
from tallymark.lineage import settle
from tallymark.operators.commits import APPEND, COMPACT, CommitLog, State
from tallymark.operators.keys import PERIOD, PERIOD_KEYS, YEAR
from tallymark.operators.versions import (
    CHECKED_AT,
    DATE,
    MOST_RECENT,
    NO,
    RUN_NUMBER,
    VERSION_COLUMNS,
    YES,
    changed_periods,
    flag_latest,
    prepare_batch,
    with_run_number,
    yes_no,
)


def changed_batch(batch: DataFrame, history: DataFrame) -> DataFrame:
    """Whole batch of every period with an unseen row, numbered as its date's next run.

    ``batch`` is a prepared batch and may hold several periods; each stands alone.
    """
    whole = batch.join(changed_periods(batch, history), PERIOD_KEYS, "left_semi")
    return with_run_number(whole, history)


def demote(history: DataFrame, replaced: DataFrame) -> DataFrame:
    """Set the flag of every row of the replaced periods to NO."""
    marked = replaced.select(*PERIOD_KEYS).distinct().withColumn("replaced", F.lit(True))
    flag = F.when(F.col("replaced"), F.lit(NO)).otherwise(F.col(MOST_RECENT))
    return (
        history.join(marked, PERIOD_KEYS, "left")
        .withColumn(MOST_RECENT, flag)
        .drop("replaced")
    )


def stamp_checked(history: DataFrame, run_ts: dt.datetime | str) -> DataFrame:
    """Put the time the sources were last checked on every row, changed or not."""
    return history.withColumn(CHECKED_AT, timestamp_literal(run_ts))


def append_changed(history: DataFrame, report: DataFrame, run_ts: dt.datetime | str) -> DataFrame:
    """The history after a run: changed periods appended as YES, their old rows NO."""
    batch = prepare_batch(report)
    added = settle(changed_batch(batch, history)).withColumn(MOST_RECENT, F.lit(YES))
    columns = [*batch.columns, MOST_RECENT, RUN_NUMBER]
    kept = demote(history, added).select(*columns)
    return stamp_checked(kept.unionByName(added.select(*columns)), run_ts)


def merge_distinct(sheet: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored sheet and batch without duplicate rows, the latest run of a period marked.

    The mark follows from the rows, so it is left out of the comparison and set anew.
    """
    rows = sheet.drop(MOST_RECENT).unionByName(batch.drop(MOST_RECENT))
    return flag_latest(rows.distinct())


class HistoryStore:
    """History tables that only ever grow, one folder per attempt of a run.

    An attempt writes its changed batch to a fresh folder below the run date and then
    commits it to the table's log, which names the folder; readers take the folders the
    log names. An attempt that dies in between leaves rows nobody ever sees, a run that
    is repeated adds a new commit, and nothing stored is rewritten.

    * Two runs at once: one of them commits, the other finds its number taken, reads the
      commits it missed, and decides again what is new if they concern its date.
    * The log's state points from each period to the commit that added its current
      rows, so those are read from the folders named and from no others.
    * The commit keeps a fingerprint of each period's batch. A batch with a fingerprint
      its date has already is unchanged, and no stored row is read for it; any other is
      compared row by row.
    * :meth:`compact` rewrites the folders of past dates into one and commits that. Readers
      see the rows before it or after it, which are the same.

    Only writers create folders: :meth:`create` once per table, :meth:`append` and :meth:`compact`.
    """

    #: So many folders of past dates are rewritten into one.
    COMPACT_FROM = 64
    #: Rows of a file of a rewritten folder.
    FILE_ROWS = 1_000_000

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _log(self, report: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/log/REPORT={report}")

    def _file_schema(self, batch_schema: T.StructType) -> T.StructType:
        fields = [f for f in batch_schema.fields if f.name not in (*VERSION_COLUMNS, DATE)]
        return T.StructType([*fields, T.StructField(RUN_NUMBER, T.IntegerType())])

    def _folder(self, report: str, date: str, attempt: str) -> str:
        return f"{self.root}/{report}/{DATE}={date}/ATTEMPT={attempt}"

    def _rewritten(self, report: str, attempt: str) -> str:
        return f"{self.root}/{report}/compacted/{attempt}"

    def create(self, report: str, batch_schema: T.StructType) -> None:
        """Make an empty table, unless it is there."""
        self._log(report).create()

    def log(self, report: str) -> DataFrame:
        """All commits: number, kind, run, folder, dates and rows added."""
        return self._log(report).table()

    def state(self, report: str) -> State:
        return self._log(report).state()

    def _rows(
        self, report: str, batch_schema: T.StructType, attempts: dict[str, tuple[str, int]],
        compacted: list[str],
    ) -> DataFrame:
        """Rows of the folders named, with their run number and the number of their commit."""
        columns = [f.name for f in batch_schema.fields if f.name not in VERSION_COLUMNS]
        stored, whole = self._file_schema(batch_schema), [*columns, RUN_NUMBER, "SEQ"]
        date, seq = T.StructField(DATE, T.DateType()), T.StructField("SEQ", T.LongType())
        parts = []
        if attempts:
            layout = T.StructType([*stored.fields, date, T.StructField("ATTEMPT", T.StringType())])
            reader = self.spark.read.schema(layout).option("basePath", f"{self.root}/{report}")
            rows = reader.parquet(*[self._folder(report, d, a) for a, (d, _) in attempts.items()])
            numbers = [(a, n) for a, (_, n) in attempts.items()]
            known = self.spark.createDataFrame(numbers, "ATTEMPT string, SEQ bigint")
            parts.append(rows.join(known, "ATTEMPT").select(*whole))
        if compacted:
            layout = T.StructType([*stored.fields, date, seq])
            parts.append(self.spark.read.schema(layout).parquet(*compacted).select(*whole))
        if not parts:
            fields = {f.name: f for f in [*batch_schema.fields, *stored.fields, date, seq]}
            return self.spark.createDataFrame([], T.StructType([fields[c] for c in whole]))
        return reduce(DataFrame.unionByName, parts)

    def stored(
        self, report: str, batch_schema: T.StructType, date: dt.date | None = None,
        state: State | None = None,
    ) -> DataFrame:
        """Rows of all committed attempts with their run number and commit.

        With a date, only that date's folders are listed and read.
        """
        state = state or self.state(report)
        day = None if date is None else date.isoformat()
        attempts = {a: at for a, at in state.attempts.items() if day in (None, at[0])}
        compacted = [self._rewritten(report, c) for c, dates in state.compacted.items() if day is None or day in dates]
        rows = self._rows(report, batch_schema, attempts, compacted)
        return rows if date is None else rows.where(F.col(DATE) == F.lit(date))

    def append(
        self, name: str, report: DataFrame, run_id: str, run_date: dt.date, run_ts: dt.datetime
    ) -> int:
        """Write the changed periods of a report, commit the check, return the rows added."""
        batch = settle(prepare_batch(report))
        if batch.where(~F.col(DATE).eqNullSafe(F.lit(run_date))).limit(1).count():
            raise ValueError(f"the report has rows of another date than {run_date}")
        self.create(name, batch.schema)
        log, day = self._log(name), run_date.isoformat()
        prints = {tuple(r)[:2]: r["print"] for r in fingerprints(batch).collect()}
        state, written = log.state(), None
        while True:
            if written is None:
                written = self._write_changed(name, batch, prints, run_id, run_date, state)
            attempt, count, periods, seen = written
            entry = {
                "SEQ": state.seq + 1, "KIND": APPEND, "RUN": run_id, "ATTEMPT": attempt, "DATE": day,
                "CHECKED": run_ts.isoformat(sep=" "), "APPENDED": count,
                "PERIODS": [[*p, prints[p]] for p in periods], "SEEN": [[*p, prints[p]] for p in seen],
            }
            if log.commit(entry):
                return count
            # Another run was first. What is new depends on the rows of this date alone.
            missed = log.since(state.seq)
            if any(e["DATE"] == day for e in missed):
                written = None
            state = log.state()

    def _write_changed(
        self, name: str, batch: DataFrame, prints: dict, run_id: str, run_date: dt.date, state: State
    ) -> tuple[str | None, int, list[tuple[int, int]], list[tuple[int, int]]]:
        """Folder, number of rows and periods of what a state lacks of the batch.

        The last are periods of which it has every row, though no equal batch.
        """
        day = run_date.isoformat()
        unlike = [p for p, found in prints.items() if found not in state.prints.get((day, *p), ())]
        if not unlike:
            return None, 0, [], []
        doubtful = batch.where(in_periods(unlike))
        # Rows can only be equal on equal run dates, and numbers count within one:
        # other dates need not be read.
        today = self.stored(name, batch.schema, run_date, state).drop("SEQ")
        added = settle(changed_batch(doubtful, today))
        counts = {tuple(r)[:2]: r["n"] for r in added.groupBy(*PERIOD_KEYS).agg(F.count(F.lit(1)).alias("n")).collect()}
        if not counts:
            return None, 0, [], unlike
        attempt = f"{run_id}-{uuid.uuid4().hex}"
        added.drop(DATE).write.mode("errorifexists").parquet(self._folder(name, day, attempt))
        return attempt, sum(counts.values()), sorted(counts), [p for p in unlike if p not in counts]

    def current(
        self, name: str, batch_schema: T.StructType, periods: list[tuple[int, int]] | None = None
    ) -> DataFrame:
        """Current rows, of all periods or of some, from the folders that hold them."""
        state = self.state(name)
        wanted = {p: at for p, at in state.current.items() if periods is None or p in periods}
        named = {attempt for _, attempt in wanted.values()}
        compacted = [f"{self._rewritten(name, c)}/LATEST=1" for c in state.compacted if c in named]
        rows = self._rows(name, batch_schema, {a: at for a, at in state.attempts.items() if a in named}, compacted)
        return self._pointed(rows, wanted, "left_semi").drop("SEQ")

    def _pointed(self, rows: DataFrame, current: dict, how: str) -> DataFrame:
        points = [(*p, seq) for p, (seq, _) in current.items()]
        known = self.spark.createDataFrame(points, f"{YEAR} int, {PERIOD} int, SEQ bigint")
        if how == "left_semi":
            return rows.join(known, [*PERIOD_KEYS, "SEQ"], how)
        marked = known.withColumn("CURRENT", F.lit(True))
        return rows.join(marked, [*PERIOD_KEYS, "SEQ"], "left")

    def read(self, name: str, batch_schema: T.StructType) -> DataFrame:
        """The history as reports see it: current rows marked, last check on every row."""
        state = self.state(name)
        rows = self._pointed(self.stored(name, batch_schema, state=state), state.current, "left")
        return (
            rows.withColumn(MOST_RECENT, yes_no(F.col("CURRENT")))
            .select(*[c for c in rows.columns if c not in ("SEQ", "CURRENT")], MOST_RECENT)
            .withColumn(CHECKED_AT, F.lit(state.checked).cast("timestamp"))
        )

    def compact(self, name: str, batch_schema: T.StructType, before: dt.date) -> bool:
        """Rewrite what was stored for dates before ``before`` into one folder.

        Rows that are current stand apart from the others. The old folders stay for
        readers that have read an earlier state of the log; nothing names them any more. False if
        there is nothing to rewrite, or another rewriting was first.
        """
        log = self._log(name)
        state = log.state()
        past = {a: at for a, at in state.attempts.items() if at[0] < before.isoformat()}
        if not past:
            return False
        paths = [self._rewritten(name, c) for c in state.compacted]
        rows = self._pointed(self._rows(name, batch_schema, past, paths), state.current, "left")
        marked = rows.withColumn("LATEST", F.col("CURRENT").isNotNull().cast("int")).drop("CURRENT")
        parts = max(1, -(-state.total // self.FILE_ROWS))
        attempt = f"compact-{uuid.uuid4().hex}"
        by = ["LATEST", *PERIOD_KEYS, "SEQ"]
        dealt = marked.repartitionByRange(parts, *by).sortWithinPartitions(*by)
        dealt.write.partitionBy("LATEST").mode("errorifexists").parquet(self._rewritten(name, attempt))
        replaced = [*past, *state.compacted]
        while True:
            entry = {
                "SEQ": state.seq + 1, "KIND": COMPACT, "RUN": None, "ATTEMPT": attempt, "DATE": None,
                "CHECKED": None, "APPENDED": 0, "PERIODS": [], "REPLACES": replaced,
            }
            if log.commit(entry):
                state.apply(entry)
                log.checkpoint(state)
                return True
            state = log.state()
            if not set(replaced) <= {*state.attempts, *state.compacted}:
                return False

    def compact_if_due(self, name: str, batch_schema: T.StructType, before: dt.date) -> bool:
        """Rewrite past dates once they have many folders."""
        past = [a for a, at in self.state(name).attempts.items() if at[0] < before.isoformat()]
        return len(past) >= self.COMPACT_FROM and self.compact(name, batch_schema, before)

    def rows_logged(self, name: str) -> DataFrame:
        """Number of stored rows, from the log alone."""
        return self.spark.createDataFrame([(self.state(name).total,)], "N_ROWS bigint")


def in_periods(periods: list[tuple[int, int]]) -> Column:
    """Rows of the periods, as literals."""
    wanted = [(F.col(YEAR) == y) & (F.col(PERIOD) == p) for y, p in periods]
    return reduce(lambda a, b: a | b, wanted, F.lit(False))


def fingerprints(batch: DataFrame) -> DataFrame:
    """Per period, the number of rows and two sums of 64-bit hashes of them.

    Sums do not depend on the order of the rows and count repeats. Whether a column is
    null is hashed beside it, since a hash passes over nulls.
    """
    columns = [F.col(f"`{c}`") for c in batch.columns]
    seen = [*columns, *[c.isNull() for c in columns]]

    def summed(*salt: Column) -> Column:
        return F.sum(F.xxhash64(*salt, *seen).cast("decimal(38,0)")).cast("string")

    parts = [F.count(F.lit(1)).cast("string"), summed(), summed(F.lit("second"))]
    return batch.groupBy(*PERIOD_KEYS).agg(F.concat_ws(":", *parts).alias("print"))
