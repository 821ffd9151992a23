from __future__ import annotations

from pyspark.sql import functions as F

from frames import plain_rows
from tallymark.operators import conform
from tallymark.operators.conform import (
    conform_cube,
    conform_extract,
    conform_extract_by_group,
    conform_gl_export,
    conform_physical_export,
    conform_profitability,
    conform_snapshot,
    conform_summary,
)
from tallymark.sources.accounts import default_account_map


def test_cube_sums_by_class(spark):
    rows = [
        ("1110000", "899301253", 10, 0, -5.0, "2018004"),
        ("1110000", "899301253", 10, 0, -6.0, "2018004"),
        ("1110000", "505201310", 10, 0, 2.5, "2018004"),
        ("0110000", "405506202", 10, 0, -9.0, "2018004"),
        ("1110000", "305701202", 10, 0, -1.0, "2018005"),
        ("1110000", "899301253", 20, 0, 100.0, "2018004"),  # other value type
        ("1110000", "899301253", 10, 1, 100.0, "2018004"),  # other version
        ("1110000", "777777777", 10, 0, 100.0, "2018004"),  # element of no class
        (None, "899301253", 10, 0, 100.0, "2018004"),
        ("ABC0000", "899301253", 10, 0, 100.0, "2018004"),  # not a cost centre
    ]
    cube = spark.createDataFrame(
        rows,
        "COSTCENTER string, COSTELMNT string, VTYPE int, VERSION int, AMOUNT double,"
        " FISCPER string",
    )
    got = plain_rows(conform_cube(cube, default_account_map(spark)))
    assert got == [
        (2018, 4, "011", None, None, -9.0),
        (2018, 4, "111", -11.0, 2.5, None),
        (2018, 5, "111", None, None, -1.0),
    ]
    # An element listed twice counts once.
    twice = default_account_map(spark).unionAll(default_account_map(spark))
    assert plain_rows(conform_cube(cube, twice)) == got


EXTRACT_SCHEMA = (
    "RSWHR string, RSART string, RSATP string, RSCLS string, RSMASG string, `RSAVV#` string,"
    " RSQTY double, RSSALTOT double, RSAVVTOT double, RSEXAM double, RSCOGTOT double,"
    " year int, period int"
)


def dimensions(spark):
    plant = spark.createDataFrame([("W1", "011   "), ("W2", "011   "), ("W3", "222")], "WHS string, PLNT string")
    article = spark.createDataFrame(
        [("A", 0.5, "1999", 1999999), ("A", 9.0, "1999", 1170101), ("B", 2.0, "7999", 1999999)],
        "AM01_ARTNUM string, AM01_ARTCNVFAC2 double, AMBCPPGRP string, AM01_EFTDAT int",
    )
    adjustment = spark.createDataFrame(
        [("S", "0"), ("R", "1"), ("X", "2")], "ADJTYP string, ADJCLS string"
    )
    return plant, article, adjustment


def test_extract_class_bounds_and_measures(spark):
    classes = ["00", "01", "50", "51", "W1", "W3", "W4"]
    rows = [("W1", "A", "S", c, "11", "99", 10.0, 100.0, 1.0, 3.0, 20.0, 2018, 4) for c in classes]
    rows += [
        ("W2", "B", "R", "01", "11", "10", 1.0, 50.0, 7.0, 2.0, 5.0, 2018, 4),  # discount field
        ("W3", "A", "X", "01", "11", "10", 1.0, 50.0, 7.0, 2.0, 5.0, 2018, 4),  # other class
        ("W9", "A", "S", "01", "11", "10", 1.0, 50.0, 7.0, 2.0, 5.0, 2018, 4),  # no plant
        ("W3", "A", "S", "01", "11", "76", 2.0, 8.0, None, 1.0, None, 2018, 5),
    ]
    extract = spark.createDataFrame(rows, EXTRACT_SCHEMA)
    got = plain_rows(conform_extract(extract, *dimensions(spark)))
    assert got == [
        (2018, 4, "011", 41.0, 22.0, 443.0, 436.0, 85.0),
        (2018, 5, "222", 2.0, 1.0, 8.0, 7.0, None),
    ]


def test_extract_by_group(spark):
    rows = [
        ("W1", "A", "S", "01", "11", "76", 10.0, 100.0, 4.0, 0.0, 0.0, 2018, 4),
        ("W2", "A", "S", "01", "41", "10", 1.0, 50.0, 7.0, 0.0, 0.0, 2018, 4),
        ("W1", "A", "S", "01", "30", "10", 6.0, 50.0, 7.0, 0.0, 0.0, 2018, 4),  # GL volume only
        ("W3", "B", "S", "01", "18", "99", 3.0, 9.0, 7.0, 0.0, 0.0, 2018, 4),  # no pack group
        ("W3", "A", "S", "01", "30", "99", 3.0, 9.0, 7.0, 0.0, 0.0, 2018, 5),  # no material group
    ]
    plant, article, _ = dimensions(spark)
    got = plain_rows(conform_extract_by_group(spark.createDataFrame(rows, EXTRACT_SCHEMA), plant, article))
    assert got == [(2018, 4, "011", 11.0, 8.5, 143.0, 4.0), (2018, 4, "222", 3.0, None, 9.0, 0.0)]


def view(spark, rows):
    fields = (conform.VIEW_VOLUME, *conform.VIEW_WHOLESALE, *conform.VIEW_COGS, *conform.VIEW_DISCOUNT)
    df = spark.createDataFrame(
        rows,
        "ProfitCenterText string, ProfitCenter string, FiscalYearPeriod string,"
        " MaterialAccountAssignmentGroup string, n int",
    )
    return df.select(
        "*", *[(F.col("n") * (i + 1)).cast("double").alias(f) for i, f in enumerate(fields)]
    ).drop("n")


def test_profitability_net_measures(spark):
    rows = [
        ("Draper", "P100111", "2018004", "11", 1),
        ("Draper", "P100111", "2018004", "18", 2),
        ("Draper", "P100111", "2018004", "30", 50),
        ("Provo", "P100 22", "2018005", "41", 1),
        ("Nowhere", None, "2018005", "41", 1),
        ("Provo", "P200 22", "2018005", "41", 1),  # other profit centre, same code
    ]
    # Fields 1..18: volume 1, wholesale 2+3, COGS 4..11, discount 12..18.
    cogs, discount = sum(range(4, 12)), sum(range(12, 19))
    got = plain_rows(conform_profitability(view(spark, rows)))
    assert got == [
        (2018, 4, "111", "Draper", 3.0, 15.0, 3.0 * cogs, 3.0 * discount, 3.0 * (5 - discount)),
        *[(2018, 5, "22", "Provo", 1.0, 5.0, 1.0 * cogs, 1.0 * discount, 1.0 * (5 - discount))] * 2,
    ]


def test_snapshot_takes_the_view_names(spark):
    snapshot = spark.createDataFrame(
        [(2, "Draper", "111 ", 1.0, 2.0, 3.0, 4.0, 5.0, 2018, 5)],
        "Number int, ProfitCenterName string, ProfitCenterCode string, Volume double,"
        " Wholesale double, COGS double, DISC double, NSI double, YEAR int, PERIOD int",
    )
    assert plain_rows(conform_snapshot(snapshot)) == [
        (2018, 5, "111", "Draper", 1.0, 2.0, 3.0, 4.0, 5.0)
    ]


def test_summary_grain_and_filters(spark):
    rows = [
        ("W1", "COLA", 5.0, 1.0, 10.0, 3.0, 2018, 4),
        ("W2", "COLA", 2.0, 1.0, 20.0, 4.0, 2018, 4),
        ("W1", "OTH CUPS", 9.0, 9.0, 9.0, 9.0, 2018, 4),
        ("W1", "OTH CO2 FULL ", 9.0, 9.0, 9.0, 9.0, 2018, 4),
        ("W1", "OTH CO2 FULL", 9.0, 9.0, 9.0, 9.0, 2018, 4),
        ("W1", None, 9.0, 9.0, 9.0, 9.0, 2018, 4),
        ("W3", "COLA", 5.0, 1.0, 1.0, 1.0, 2018, 4),
        ("W3", "COLA", -5.0, 1.0, 1.0, 1.0, 2018, 4),  # no volume left
    ]
    summary = spark.createDataFrame(
        rows,
        "RSWHR string, PRDDESC string, VOLPHYBCPP double, VOLGLUBCPP double, NSISM double,"
        " COGBCPP double, fiscal_year int, PERIOD int",
    )
    plant, _, _ = dimensions(spark)
    assert plain_rows(conform_summary(summary, plant)) == [(2018, 4, "011", 7.0, 2.0, 30.0, 7.0)]
    by_warehouse = plain_rows(conform_summary(summary, plant, by_warehouse=True), "CODE", "RSWHR", "ZRVOLUME")
    assert by_warehouse == [("011", "W1", 5.0), ("011", "W2", 2.0)]


def test_exports_lose_totals_and_codeless_rows(spark):
    gl = spark.createDataFrame(
        [("Draper", "111 ", 1.0, 2.0, 3.0, 4.0, 5.0), ("Totals", None, 1.0, 2.0, 3.0, 4.0, 5.0),
         ("Lost", None, 1.0, 2.0, 3.0, 4.0, 5.0)],
        "`Act.Cost.Cntr` string, `Act.Cost.Cntr.host.code` string, `Total.Gross.Vol` double,"
        " `NSI.Simple` double, `Cona.NSI.Simple[Cona_Sales]` double, NSI double,"
        " `COGS.Simple` double",
    ).withColumns({"YEAR": F.lit(2018), "PERIOD": F.lit(4)})
    gl = gl.withColumnRenamed("Cona.NSI.Simple[Cona_Sales]", "[Cona.NSI.Simple]Cona_Sales")
    assert plain_rows(conform_gl_export(gl)) == [(2018, 4, "111", "Draper", 1.0, 2.0, 3.0, 4.0, 5.0)]
    physical = gl.select(
        "YEAR", "PERIOD", "`Act.Cost.Cntr`", "`Act.Cost.Cntr.host.code`",
        F.lit(8.0).alias("Vol.Gross.Sales.Volume"),
    )
    assert plain_rows(conform_physical_export(physical)) == [(2018, 4, "111", "Draper", 8.0)]
