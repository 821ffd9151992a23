from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from frames import LEDGER_COLUMNS, RUN_DATE, ledgers, plain_rows
from tallymark.checks.standins import Samples
from tallymark.functions.measures import fill_zero_numeric
from tallymark.lineage import settle
from tallymark.operators.align import align_all, codes_in, codes_not_in, full_outer_align
from tallymark.operators.index import system_index
from tallymark.operators.keys import CODE, KEYS, NAME
from tallymark.operators.merge import reaggregate
from tallymark.plans.audit import audit_counts
from tallymark.plans.reports import (
    _figures,
    _stamped,
    build_report,
    build_reports,
    build_unindexed_report,
    index_of,
    ledgers_of,
)
from tallymark.plans.specs import COGS, GL, NSI, PHYSICAL, REPORTS


def fixture(spark, period=4):
    """Codes: 001 in all systems, 002 in the extract and a report, 003 in the view alone,
    004 without view volume, 005 in the extract with no report, 006 in the cube alone."""
    y, p = 2018, period
    return ledgers(
        spark,
        profitability=[
            (y, p, "001", "One", 100, 50, 30, 10, 40),
            (y, p, "003", "Three", 70, 20, 12, 5, 15),
            (y, p, "004", "Four", 0, 0, 0, 0, 0),
        ],
        extract=[
            (y, p, "001", 90, 9, 38, 37, 28),
            (y, p, "002", 60, 6, 21, 22, 11),
            (y, p, "004", 20, 2, 8, 7, 4),
            (y, p, "005", 5, 1, 1, 1, 1),
        ],
        cube=[(y, p, "001", -8, 29, -39), (y, p, "006", -1, 1, -1)],
        gl_export=[
            (y, p, "001", "One MM", 9.5, 41, 42, 43, 27),
            (y, p, "002", "Two MM", 6.5, 23, 24, 25, 10),
        ],
        physical_export=[(y, p, "001", "One MM", 95), (y, p, "002", "Two MM", 61)],
        summary=[(y, p, "001", 99, 8, 44, 26)],
    )


def test_index_rule_switches_after_the_cut(spark):
    before = plain_rows(index_of(fixture(spark, 4)), CODE, NAME, "System")
    assert before == [
        ("001", "One", "CONA"), ("002", "Two MM", "Legacy"), ("003", "Three", "CONA"),
    ]
    after = plain_rows(index_of(fixture(spark, 5)), CODE, NAME, "System")
    assert ("004", "Four", "CONA") in after and len(after) == 4


def test_physical_report(spark):
    report = build_reports(fixture(spark, 5), RUN_DATE, "YES")["physical"]
    assert report.columns == [
        "CODE", "COSTCENTER", "HANAVOLUME", "KOEXTTVOLUME", "KOEXTTVAR", "MMVOLUME", "MMVAR",
        "ZRVOLUME", "ZRVAR", "DATE", "PERIOD", "YEAR", "PERIODEND", "System",
    ]
    stamps = (RUN_DATE, 5, 2018, "YES")
    assert plain_rows(report) == [
        ("001", "One", 100.0, 90.0, 10.0, 95.0, 5.0, 99.0, 1.0, *stamps, "CONA"),
        ("002", "Two MM", None, 60.0, 0.0, 61.0, -1.0, 0.0, 0.0, *stamps, "Legacy"),
        # Absent from the extract and the reports: they count as 0; the summary does not.
        ("003", "Three", 70.0, 0.0, 70.0, 0.0, 70.0, 0.0, 0.0, *stamps, "CONA"),
        ("004", "Four", 0.0, 20.0, 0.0, 0.0, 20.0, 0.0, 0.0, *stamps, "CONA"),
    ]


def test_gl_report_needs_a_named_export_row(spark):
    report = build_reports(fixture(spark, 5), RUN_DATE, "NO")["gl"]
    figures = plain_rows(report, "CODE", *GL.figures, "System")
    assert figures == [
        ("001", 9.5, 9.0, -0.5, -8.0, 1.0, 8.0, 1.0, "CONA"),
        ("002", 6.5, 6.0, -0.5, 0.0, 0.0, 0.0, 0.0, "Legacy"),
    ]


def test_nsi_report(spark):
    report = build_reports(fixture(spark, 5), RUN_DATE, "NO")["nsi"]
    figures = {row[0]: row[1:] for row in plain_rows(report, "CODE", *NSI.figures)}
    assert figures["001"] == (
        40.0, 38.0, 2.0, 37.0, 3.0, 41.0, 42.0, 43.0, -1.0, -2.0, -3.0, -39.0, 1.0, 44.0, -4.0
    )
    assert figures["002"] == (
        0.0, 21.0, 0.0, 22.0, 0.0, 23.0, 24.0, 25.0, -1.0, -2.0, -3.0, 0.0, 0.0, 0.0, 0.0
    )
    # No extract row: its filled figure has a variance, the unfilled one does not.
    assert figures["003"][:5] == (15.0, 0.0, 15.0, 0.0, 0.0)


def test_cogs_report(spark):
    report = build_reports(fixture(spark, 5), RUN_DATE, "NO")["cogs"]
    figures = {row[0]: row[1:] for row in plain_rows(report, "CODE", *COGS.figures)}
    assert figures["001"] == (30.0, 28.0, 2.0, 27.0, 3.0, 29.0, 1.0, 26.0, 4.0)
    assert figures["002"] == (0.0, 11.0, 0.0, 10.0, 1.0, 0.0, 0.0, 0.0, 0.0)


def test_unindexed_report_keeps_every_code(spark):
    report = build_unindexed_report(fixture(spark), PHYSICAL, RUN_DATE, "YES")
    assert "System" not in report.columns
    figures = {row[0]: row[1:] for row in plain_rows(report, "CODE", "COSTCENTER", *PHYSICAL.figures)}
    assert set(figures) == {"001", "002", "003", "004", "005"}
    # Nothing is filled before the variances.
    assert figures["003"] == ("Three", 70.0, None, None, None, None, 0.0, 0.0)
    assert figures["002"] == (None, None, 60.0, 0.0, 61.0, -1.0, 0.0, 0.0)
    gl = build_unindexed_report(fixture(spark), GL, RUN_DATE, "YES")
    assert plain_rows(gl, "CODE", "COSTCENTER") == [("001", "One MM"), ("002", "Two MM")]
    cogs = build_unindexed_report(fixture(spark), COGS, RUN_DATE, "YES")
    assert {r[0] for r in plain_rows(cogs, "CODE")} == {"001", "002", "003", "004", "005", "006"}


def random_ledgers(spark, seed):
    """Random ledgers over two periods with absent sides, repeats, nulls and zeros."""
    rng = random.Random(seed)

    def figure():
        return rng.choice([None, 0, rng.randint(-9, 9), rng.randint(1, 99)])

    rows = {}
    for name, columns in LEDGER_COLUMNS.items():
        rows[name] = []
        for period in (4, 5):
            for code in range(1, 9):
                copies = rng.choice([0, 1, 1, 2]) if name in ("summary", "profitability") else rng.choice([0, 1])
                for copy in range(copies):
                    values = [
                        (f"{name[0]}{code}{copy}" if c == NAME else figure()) for c in columns
                    ]
                    rows[name].append((2018, period, f"{code:03d}", *values))
    return ledgers(spark, **rows)


def cascade(given, index, spec):
    """The report as a cascade of outer joins that the index joins last."""
    first, *others = spec.sides
    aligned = first.apply(_figures(given, first, NAME))
    for side in others:
        aligned = side.apply(full_outer_align(aligned, _figures(given, side), KEYS))
    if any(side.required for side in spec.sides):
        aligned = aligned.where(F.col(NAME).isNotNull())
    if spec.fill_rest:
        aligned = fill_zero_numeric(aligned)
    named = index.withColumnRenamed(NAME, "COSTCENTER").join(aligned.drop(NAME), KEYS)
    return _stamped(named, spec, RUN_DATE, "YES", "System")


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("spec", REPORTS, ids=lambda s: s.name)
def test_left_joins_from_the_index_equal_the_cascade(spark, spec, seed):
    given = random_ledgers(spark, seed)
    index = index_of(given)
    report = build_report(given, index, spec, RUN_DATE, "YES")
    assert plain_rows(report) == plain_rows(cascade(given, index, spec))


def test_report_reads_only_its_ledgers(spark):
    assert "cube" not in ledgers_of(PHYSICAL) and "physical_export" not in ledgers_of(NSI)


def test_codes_and_reaggregation(spark):
    a = spark.createDataFrame([("1", 1), ("1", 2), ("2", 3), (None, 4)], "k string, v int")
    b = spark.createDataFrame([("2", 5), (None, 6)], "k string, v int")
    assert plain_rows(codes_in(a, b, ["k"])) == [("2", 3)]
    assert plain_rows(codes_not_in(a, b, ["k"])) == [(None,), ("1",)]
    sums = plain_rows(reaggregate([a, b], ["k"], ["v"]))
    assert sums == [(None, 10), ("1", 3), ("2", 8)]
    renamed = b.withColumnRenamed("k", "other")
    aligned = full_outer_align(a, renamed.withColumnRenamed("v", "w"), ["k"], {"other": "k"})
    assert aligned.columns == ["k", "v", "w"] and aligned.count() == 5


def test_index_needs_only_its_three_ledgers(spark):
    given = fixture(spark)
    rows = system_index(given.profitability, given.extract, given.gl_export)
    assert rows.columns == [*KEYS, NAME, "System"]


def test_audit_counts(spark):
    counts = audit_counts({"a": spark.range(3), "b": spark.range(0)})
    assert plain_rows(counts) == [("a", 3, 1), ("b", 0, 1)]


def test_one_exchange_aligns_as_outer_joins_do(spark):
    """Repeated keys on several sides, keys that sides lack, null keys and null figures."""
    rng = random.Random(3)

    def side(name):
        rows = [(2018, rng.choice([1, 2, None]), rng.choice(["001", "002", "003", "004"]), rng.choice([None, 1, 2, 3])) for _ in range(14)]
        return settle(spark.createDataFrame(rows, f"YEAR int, PERIOD int, CODE string, {name} int"))

    sides = [side(n) for n in ("a", "b", "c", "d")]
    chain = sides[0]
    for other in sides[1:]:
        chain = full_outer_align(chain, other, KEYS)
    found = align_all(sides, KEYS)
    columns = [*KEYS, "a", "b", "c", "d"]
    assert sorted(map(str, found.select(columns).collect())) == sorted(map(str, chain.select(columns).collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_earlier_reports_take_one_exchange(spark):
    given = Samples(spark, "/root/testdata/sf0.001").ledgers(*[side.ledger for side in COGS.sides]).settled()
    plan = build_unindexed_report(given, COGS, dt.date(2020, 11, 30), "YES")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
