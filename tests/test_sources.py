from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from frames import APRIL, MAY, plain_rows
from tallymark.checks import oracles
from tallymark.functions.fiscal import FiscalPeriod
from tallymark.operators import rows
from tallymark.operators.rows import row_window
from tallymark.sources import dated, exports, schemas
from tallymark.sources.accounts import COGS, NSI, VOLUME, account_elements, default_account_map
from tallymark.sources.landing import (
    LandingZone,
    cube_slice,
    extract_table_name,
    fiscal_keys,
    in_periods,
    read_jdbc,
)
from tallymark.sources.workarea import decode_with_rejects, decode_work_area


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_account_map_has_the_listed_elements(spark):
    elements = account_elements()
    assert len(elements) == len({e for e, _ in elements})
    counts = {c: sum(k == c for _, k in elements) for c in (VOLUME, COGS, NSI)}
    assert counts == {VOLUME: 108, COGS: 104, NSI: 199}
    twin = {VOLUME: oracles.VOLUME_ELEMENTS, COGS: oracles.COGS_ELEMENTS, NSI: oracles.NSI_ELEMENTS}
    assert set(elements) == {(e, kind) for kind, listed in twin.items() for e in listed}
    known = dict(elements)
    assert known["899301623"] == VOLUME and known["505401502"] == COGS
    assert known["305701276"] == NSI and "405506276" not in known
    assert default_account_map(spark).count() == 411


def test_work_area_decode(spark):
    rows = [("011;12.50-;Cola  ;1,234",), ("012;abc;;",), ("013;7",), ("014;1;a;b;c",)]
    df = spark.createDataFrame(rows, "WA string")
    catalogue = [("CODE   ", "C"), ("AMOUNT", "P"), ("TEXT", "C"), ("COUNT", "I")]
    decoded = decode_work_area(df, catalogue)
    assert decoded.columns == ["CODE", "AMOUNT", "TEXT", "COUNT"]
    assert plain_rows(decoded) == [
        ("011", -12.5, "Cola", 1234.0),
        ("012", 0.0, "", 0.0),
        ("013", 7.0, None, 0.0),
        ("014", 1.0, "a", 0.0),
    ]


def test_work_area_fields_filter_and_window(spark):
    rows = [(f"{n:03d}|{n}",) for n in range(10)]
    df = spark.createDataFrame(rows, "WA string")
    page = decode_work_area(
        df, [("CODE", "C"), ("N", "N")], fields=["N"], condition=F.col("N") >= 2,
        order_by=["CODE"], nrows=3, skip=1, delimiter="|",
    )
    assert page.columns == ["N"]
    assert plain_rows(page) == [(3.0,), (4.0,), (5.0,)]


def test_row_window_skips_without_a_limit(spark):
    df = spark.range(1000).repartition(4)
    assert [r.id for r in row_window(df, ["id"], skip=990).orderBy("id").collect()] == list(
        range(990, 1000)
    )
    assert row_window(df, []) is df
    with pytest.raises(ValueError):
        row_window(df, [], nrows=5)


def test_row_window_keeps_ties_and_repeats(spark):
    rows = [(1, "b"), (1, "a"), (1, "a"), (2, "c"), (None, "z")] + [(3, f"{n:03d}") for n in range(200)]
    df = spark.createDataFrame(rows, "k int, v string").repartition(7)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))

    def window(**page):
        found = [tuple(r) for r in row_window(df, ["k"], **page).collect()]
        return sorted(found, key=ordered.index)

    for skip in (0, 1, 2, 3, 5, 100, 204, 205, 999):
        assert window(skip=skip, nrows=10_000) == ordered[skip:]
        assert skip == 0 or window(skip=skip) == ordered[skip:]
        assert window(skip=skip, nrows=3) == ordered[skip : skip + 3]
    assert row_window(df.limit(0), ["k"], nrows=3, skip=1).count() == 0


def test_export_csv_and_headers(spark, tmp_path):
    path = str(tmp_path / "report.csv")
    lines = [
        "Act.Cost.Cntr,Act.Cost.Cntr.host.code,[Cona.NSI.Simple]$Cona_Sales,NSI",
        "Draper,111,1.5,2",
        "Totals,,1.5,2",
    ]
    with open(path, "w") as file:
        file.write("\n".join(lines))
    names = lines[0].split(",")
    schema = ", ".join(f"`{n}` {'string' if i < 2 else 'double'}" for i, n in enumerate(names))
    raw = exports.read_export_csv(spark, path, schema)
    clean = exports.clean_export(raw)
    assert clean.columns == ["ActCostCntr", "ActCostCntrhostcode", "CONANSISimple", "MMNSI"]
    assert plain_rows(clean) == [("Draper", "111", 1.5, 2.0)]
    assert exports.upper_headers(clean).columns[0] == "ACTCOSTCNTR"


@pytest.mark.parametrize(
    "lines",
    [["COGS,NSI", "1,2"], ["NSI", "1"], ["NSI,COGS,MORE", "1,2,3"], ["NSI,COGS", "1,many"], ["NSI,COGS", "1"]],
)
def test_an_export_that_does_not_fit_stops_the_read(spark, tmp_path, lines):
    (tmp_path / "report.csv").write_text("\n".join(lines) + "\n")
    with pytest.raises(Exception):  # noqa: B017 - Spark's own, by kind of misfit
        exports.read_export_csv(spark, str(tmp_path / "report.csv"), "NSI double, COGS double").collect()


def test_export_flag_chooses_the_file(spark, tmp_path):
    row = {"Act.Cost.Cntr": "a  ", "Act.Cost.Cntr.host.code": "1", "Vol.Gross.Sales.Volume": 1.0}
    rows = [{**row, "YEAR": 2018, "PERIOD": p, "PERIOD_END": e} for p in (4, 5) for e in ("YES", "NO")]
    columns = [f.name for f in schemas.PHYSICAL_EXPORT.fields]
    df = spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], columns)
    df.write.partitionBy("YEAR", "PERIOD", "PERIOD_END").parquet(f"{tmp_path}/physical_export")
    zone = LandingZone(spark, str(tmp_path))
    chosen = zone.physical_export([APRIL], [MAY])
    assert plain_rows(chosen) == [("a", "1", 1.0, 2018, 4), ("a", "1", 1.0, 2018, 5)]
    assert "PERIOD_END" in plan_of(chosen).split("PartitionFilters: [")[1].split("]")[0]
    assert zone.physical_export([APRIL], []).count() == 1


def test_schema_is_checked_cast_and_trimmed(spark):
    df = spark.createDataFrame([("10  ", "001   ", 9)], "WHS string, plnt string, more int")
    landed = schemas.meet_schema(df, schemas.PLANT)
    assert plain_rows(landed) == [("10", "001")]
    with pytest.raises(ValueError, match="WHS"):
        schemas.meet_schema(df.drop("WHS"), schemas.PLANT)


def test_periods_prune_partitions(spark, tmp_path):
    root = str(tmp_path)
    rows = [("w", 2018, 4), ("w", 2018, 5), ("w", 2017, 5)]
    other = [f.name for f in schemas.EXTRACT.fields if f.name not in ("RSWHR", "year", "period")]
    df = spark.createDataFrame(rows, "RSWHR string, year int, period int").withColumns(
        {name: F.lit(None).cast(schemas.EXTRACT[name].dataType) for name in other}
    )
    df.write.partitionBy("year", "period").parquet(f"{root}/extract")
    zone = LandingZone(spark, root)
    assert zone.extract().count() == 3
    pair = zone.extract([APRIL, MAY])
    assert pair.count() == 2
    plan = plan_of(pair)
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in filters and "period" in filters


def test_snapshots_are_read_by_number(spark, tmp_path):
    row = [(1, "A", "001", 1.0, 2.0, 3.0, 4.0, 5.0, 2018, 5)]
    names = [f.name for f in schemas.SNAPSHOT.fields]
    df = spark.createDataFrame(row, names)
    df.write.partitionBy("Number").parquet(f"{tmp_path}/snapshots")
    read = LandingZone(spark, str(tmp_path)).snapshots([MAY])
    assert [(f.name, f.dataType) for f in read.schema.fields] == [
        (f.name, f.dataType) for f in schemas.SNAPSHOT.fields
    ]
    assert read.count() == 1


def test_key_and_period_filters(spark):
    df = spark.createDataFrame([("2018004", 2018, 4), ("2018005", 2018, 5)], "k string, y int, p int")
    assert df.where(fiscal_keys("k", [APRIL])).count() == 1
    assert df.where(in_periods("y", "p", [APRIL])).count() == 1
    assert df.where(in_periods("y", "p", None)).count() == 2
    assert df.where(in_periods("y", "p", [])).count() == 0


def test_cube_slice_selects_and_restricts(spark):
    df = spark.createDataFrame([("a", 1, 2, "x"), ("b", 3, 4, "y")], "c string, m int, n int, k string")
    assert plain_rows(cube_slice(df, ["c"], ["m"], F.col("k") == "y")) == [("b", 3)]


def test_extract_table_name(spark):
    df = spark.createDataFrame([(2018, 4, False), (2018, 12, False), (2018, 5, True)], "y int, p int, c boolean")
    names = df.select(extract_table_name(F.col("y"), F.col("p"), F.col("c")).alias("n"))
    assert [r.n for r in names.collect()] == ["KOEXT1804", "KOEXT1812", "KOEXTT"]


def test_jdbc_needs_bounds(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none", "select 1", partition_column="day")


def test_landing_zone_reads_calendar(spark, tmp_path):
    df = spark.createDataFrame([("4", dt.date(2018, 4, 30))], "period string, usadat date")
    df.write.parquet(f"{tmp_path}/calendar")
    calendar = LandingZone(spark, str(tmp_path)).calendar()
    assert plain_rows(calendar) == [(4, dt.date(2018, 4, 30))]


def test_row_window_counts_ranges_where_it_ends_late(spark, monkeypatch):
    """Only the ranges at the window's edges are sorted; nested columns, nulls and ties."""
    monkeypatch.setattr(rows, "TOP_ROWS", 10)
    values = [(k % 7 if k % 11 else None, [k % 3], "x" * (k % 5), {"m": 1}) for k in range(900)] + [(3, [1], "same", None)] * 300
    schema = "k int, a array<int>, s string, m map<string,int>"
    df = spark.createDataFrame(values, schema).repartition(5)
    plain = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    expected = sorted(map(plain, values), key=lambda r: (*r[:2], r[2], r[3]))
    for nrows, skip in [(400, 250), (-1, 1150), (1200, 0), (5, 1196), (-1, 5000), (50, 390)]:
        page = [plain((r.k, r.a, r.s)) for r in row_window(df, ["k"], nrows, skip).collect()]
        assert page == expected[skip:][: nrows if nrows >= 0 else None]


def test_row_window_that_ends_early_sorts_nothing_whole(spark):
    df = spark.range(100000).repartition(4)
    plan = row_window(df, ["id"], 500, 200)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan and "Scan ExistingRDD" not in plan


def test_dated_folders(spark, tmp_path):
    now = FiscalPeriod(2020, 1)
    name_of = dated.extract_folders(now)
    assert [name_of(p) for p in (now, now.prior(), FiscalPeriod(2018, 4))] == ["KOEXTT", "KOEXT1912", "KOEXT1804"]
    fields = [f for f in schemas.EXTRACT.fields if f.name not in ("year", "period", "RSEXAM")]
    columns = [F.lit("1").cast(f.dataType).alias(f.name) for f in fields]
    for name in ("KOEXTT", "KOEXT1912"):
        spark.range(2).select(*columns).write.parquet(f"{tmp_path}/{name}")
    zone = LandingZone(spark, str(tmp_path))
    found = zone.dated_extract([now, now.prior()], now)
    assert found.schema == schemas.EXTRACT or found.columns == [f.name for f in schemas.EXTRACT.fields]
    assert sorted(map(tuple, found.groupBy("year", "period", "RSEXAM").count().collect())) == [(2019, 12, None, 2), (2020, 1, None, 2)]
    with pytest.raises(LookupError, match=r"2018-04 \(KOEXT1804\), 2018-03 \(KOEXT1803\)"):
        zone.dated_extract([now, FiscalPeriod(2018, 4), FiscalPeriod(2018, 3)], now)
    spark.range(1).select(*[c for c in columns if "RSQTY" not in str(c)]).write.parquet(f"{tmp_path}/KOEXT1911")
    with pytest.raises(ValueError, match="RSQTY"):
        zone.dated_extract([FiscalPeriod(2019, 11)], now)
    year = [F.lit("1").cast(f.dataType).alias(f.name) for f in schemas.SUMMARY.fields if f.name not in ("fiscal_year", "PERIOD")]
    for name in ("ZRTLRS", "ZRTLRS2019"):
        spark.range(1, 4).select(*year, F.col("id").cast("int").alias("PERIOD")).write.parquet(f"{tmp_path}/{name}")
    rows = zone.yearly_summary([FiscalPeriod(2020, 2), FiscalPeriod(2019, 3), FiscalPeriod(2019, 1)], 2020)
    assert sorted((r.fiscal_year, r.PERIOD) for r in rows.collect()) == [(2019, 1), (2019, 3), (2020, 2)]


def test_rejects_name_row_field_and_reason(spark):
    lines = [(1, "12.50-;ok "), (2, "1,234;x"), (3, " ;x"), (4, "abc;x"), (5, "9" * 31 + ";x"), (6, "7"), (7, "1;x;more"), (8, "1-2-;x"), (9, None)]
    area = decode_with_rejects(spark.createDataFrame(lines, "row int, WA string"), [("N ", "P"), ("T", "C")], ["row"])
    assert {r.row: float(r.N) for r in area.rows.collect()} == {1: -12.5, 2: 1234, 3: 0, 4: 0, 5: 0, 6: 7, 7: 1, 8: 0, 9: 0}
    found = sorted((r.row, r.FIELD, r.TEXT, r.REASON) for r in area.rejects.collect())
    assert found == [(4, "N", "abc", "malformed"), (5, "N", "9" * 31, "too large"), (7, None, "more", "too many fields"), (8, "N", "1-2-", "malformed"), (9, "N", None, "missing")]
    plain = decode_work_area(spark.createDataFrame(lines, "row int, WA string"), [("N ", "P"), ("T", "C")])
    assert sorted(map(str, plain.collect())) == sorted(map(str, area.rows.collect()))
