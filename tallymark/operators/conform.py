"""Each system's extract, brought to one row per fiscal period and cost-centre code.

Every step is scan -> filter -> join with the dimensions -> one grouped sum, so a
task sends on at most one row per (period, code) it has seen, however many invoice
lines it read and however many of them share a key. The period stays in the key:
one pass conforms any number of periods, and a caller who wants one or two prunes
the scan with :mod:`tallymark.sources.landing`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.measures import (
    MEASURE,
    MONEY,
    indicator,
    one_of,
    total,
    total_of_product,
    total_only_where,
    total_where,
)
from tallymark.functions.text import cost_centre_code, key_period, key_year, substr_span
from tallymark.operators.keys import CODE, KEYS, NAME, PERIOD, PERIOD_KEYS, YEAR
from tallymark.sources import accounts
from tallymark.sources.exports import clean_export

# Selections the systems apply.
CUBE_VALUE_TYPE, CUBE_VERSION = 10, 0
MATERIAL_GROUPS = ("11", "18", "41")
PACK_GROUPS = ("1999", "2999", "3999", "4999", "5999", "6999")
ADJUSTMENT_CLASSES = ("0", "1")
CURRENT_EFFECTIVE_DATE = 1999999
INVOICE_CLASS_RANGES = (("01", "50"), ("W1", "W3"))
COGS_VALUE_FIELDS = ("76", "78", "79", "80", "81", "82", "83", "84")
DISCOUNT_VALUE_FIELDS = ("10", "11", "13", "22", "23", "44", "63")
LEFT_OUT_PRODUCTS = ("OTH CO2 FULL", "OTH CUPS", "OTH LIDS", "OTH STRAWS")

# The value fields of the profitability view, by the measure they make up.
VIEW_VOLUME = "VV998QPhysicalCases"
VIEW_WHOLESALE = ("ERLOSRevenue", "VV004UpchargeChannel")
VIEW_COGS = (
    "VV076COGSPurchasedFG",
    "VV078COGSConcentrate",
    "VV079COGSIngredients",
    "VV080COGSContainers",
    "VV081COGSPackaging",
    "VV082COGSLaborActivity",
    "VV083COGSOtherOverheads",
    "VV084Reserve50CGS",
)
VIEW_DISCOUNT = (
    "VV010EDVChannelDiscount",
    "VV011EDVCustomer",
    "VV013EmployeeDiscounts",
    "VV022NMDOTHER",
    "VV044CRMTPMOnInv",
    "VV023VolumeDiscount",
    "VV063Reserve35Swire",
)


def _with_code(df: DataFrame) -> DataFrame:
    """A row without a code belongs to no cost centre."""
    return df.where(F.col(CODE).isNotNull())


def conform_cube(cube: DataFrame, account_map: DataFrame) -> DataFrame:
    """Ledger postings: volume, COGS and net sales by account class.

    A code with no posting of a class has null there.
    """
    postings = cube.where(
        f"VTYPE = {CUBE_VALUE_TYPE} and VERSION = {CUBE_VERSION} and COSTCENTER is not null"
    ).select(
        key_year("FISCPER").alias(YEAR),
        key_period("FISCPER").alias(PERIOD),
        cost_centre_code("COSTCENTER").alias(CODE),
        F.col("COSTELMNT").alias("element"),
        "AMOUNT",
    )
    classes = account_map.select("element", "account_class").distinct()

    def of_class(account_class: str) -> Column:
        return total_only_where(f"account_class = '{account_class}'", "AMOUNT")

    return (
        _with_code(postings)
        .join(classes, "element")
        .groupBy(*KEYS)
        .agg(
            of_class(accounts.VOLUME).alias("Volume"),
            of_class(accounts.COGS).alias("COGS"),
            of_class(accounts.NSI).alias("NSI"),
        )
    )


def _current_articles(article: DataFrame) -> DataFrame:
    return article.where(f"AM01_EFTDAT = {CURRENT_EFFECTIVE_DATE}").selectExpr(
        "AM01_ARTNUM RSART", "AM01_ARTCNVFAC2", "AMBCPPGRP"
    )


def _plants(plant: DataFrame) -> DataFrame:
    return plant.selectExpr("WHS RSWHR", f"trim(PLNT) {CODE}")


#: A sum of invoice lines: exact, and times a factor still within a decimal's digits.
LINE_SUM = "decimal(24,4)"
LINE_KEYS = ["RSWHR", "RSART", "RSATP"]


def invoice_sums(extract: DataFrame) -> DataFrame:
    """Invoice lines of both class ranges, summed by period, warehouse, article and type.

    Everything a dimension decides is constant within such a group, so sums can be taken
    before the dimensions are joined: a join beyond the broadcast size then moves sums and not
    lines. The two ranges do not overlap, so one scan with an OR takes the
    place of two scans whose sums are added afterwards.
    """
    in_ranges = " or ".join(f"RSCLS between '{a}' and '{b}'" for a, b in INVOICE_CLASS_RANGES)
    sums = {
        "QTY": total("RSQTY"),
        "SALES": total("RSSALTOT"),
        "DISCOUNT": total_where(one_of("RSAVV#", DISCOUNT_VALUE_FIELDS), "RSAVVTOT"),
        "EXAMINED": total("RSEXAM"),
        "COST": total("RSCOGTOT"),
    }
    return (
        extract.where(in_ranges)
        .withColumnsRenamed({"year": YEAR, "period": PERIOD})
        .groupBy(*PERIOD_KEYS, *LINE_KEYS)
        .agg(*[amount.cast(LINE_SUM).alias(name) for name, amount in sums.items()])
    )


def conform_extract(
    extract: DataFrame, plant: DataFrame, article: DataFrame, adjustment_type: DataFrame
) -> DataFrame:
    """Invoice extract: two volumes, net sales by two discount sources, COGS.

    A product with an article's factor is the factor times the article's sum.
    """
    adjustments = adjustment_type.where(one_of("ADJCLS", ADJUSTMENT_CLASSES))
    sums = _with_code(
        invoice_sums(extract)
        .join(adjustments.selectExpr("ADJTYP RSATP"), "RSATP")
        .join(_plants(plant), "RSWHR")
        .join(_current_articles(article), "RSART")
    )

    def added(amount: str) -> Column:
        return F.expr(f"cast(sum({amount}) as {MEASURE.simpleString()})")

    return sums.groupBy(*KEYS).agg(
        added("QTY").alias("VOLUMEPHYSICAL"),
        added("QTY * AM01_ARTCNVFAC2").alias("VOLUMEGLUNIT"),
        (added("SALES") - added("DISCOUNT")).cast(MEASURE).alias("NSIAVV"),
        (added("SALES") - added("EXAMINED")).cast(MEASURE).alias("NSIRSEXAM"),
        added("COST").alias("COGS"),
    )


def with_indicator_measures(extract: DataFrame) -> DataFrame:
    """COGS and discount amounts, by 0/1 indicators over the value field."""
    field, amount = F.col("RSAVV#"), F.col("RSAVVTOT").cast(MONEY)
    return extract.withColumns(
        {
            "COGSINDICATOR": indicator(field.isin(*COGS_VALUE_FIELDS)),
            "DISCINDICATOR": indicator(field.isin(*DISCOUNT_VALUE_FIELDS)),
        }
    ).withColumns(
        {
            "COGS": (amount * F.col("COGSINDICATOR")).cast(MONEY),
            "DISC": (amount * F.col("DISCINDICATOR")).cast(MONEY),
        }
    )


def conform_extract_by_group(
    extract: DataFrame, plant: DataFrame, article: DataFrame
) -> DataFrame:
    """Earlier form of the extract: figures by material group, GL volume by pack group.

    A code needs a line of the material groups to appear; its GL volume is null when
    it has none of the pack groups. Both sums come from one grouping.
    """
    lines = _with_code(
        with_indicator_measures(extract)
        .withColumnsRenamed({"year": YEAR, "period": PERIOD})
        .join(_plants(plant), "RSWHR")
        .join(_current_articles(article), "RSART")
    )
    by_material = one_of("RSMASG", MATERIAL_GROUPS)
    by_pack = F.expr(one_of("AMBCPPGRP", PACK_GROUPS))

    def of_material(col: str) -> Column:
        return total_only_where(by_material, col)

    gl_units = F.sum(F.when(by_pack, F.col("RSQTY").cast(MONEY) * F.col("AM01_ARTCNVFAC2")))
    return (
        lines.groupBy(*KEYS)
        .agg(
            of_material("RSQTY").alias("VOLUMEPHYSICAL"),
            gl_units.cast(MEASURE).alias("VOLUMEGLUNIT"),
            (of_material("RSSALTOT") - of_material("DISC")).cast(MEASURE).alias("NSI"),
            of_material("COGS").alias("COGS"),
            F.count_if(F.expr(by_material)).alias("material_lines"),
        )
        .where(F.col("material_lines") > 0)
        .drop("material_lines")
    )


def conform_profitability(view: DataFrame, *also_by: str) -> DataFrame:
    """Profitability view: volume, wholesale, discount, net sales and COGS.

    One row per profit centre; its code is a part of its number. ``also_by`` adds
    columns of the view to the grouping.
    """
    fields = (VIEW_VOLUME, *VIEW_WHOLESALE, *VIEW_COGS, *VIEW_DISCOUNT)
    sums = (
        view.where(one_of("MaterialAccountAssignmentGroup", MATERIAL_GROUPS))
        .groupBy("FiscalYearPeriod", "ProfitCenter", "ProfitCenterText", *also_by)
        .agg(*[total(field).alias(field) for field in fields])
    )

    def added(fields: tuple[str, ...]) -> Column:
        return F.expr(f"cast({' + '.join(fields)} as {MEASURE.simpleString()})")

    # Keys are taken apart after the grouping, once per profit centre and not per line.
    named = sums.select(
        key_year("FiscalYearPeriod").alias(YEAR),
        key_period("FiscalYearPeriod").alias(PERIOD),
        F.trim(substr_span("ProfitCenter", 5, 7)).alias(CODE),
        F.col("ProfitCenterText").alias(NAME),
        *also_by,
        F.col(VIEW_VOLUME).alias("Volume"),
        added(VIEW_WHOLESALE).alias("Wholesale"),
        added(VIEW_COGS).alias("COGS"),
        added(VIEW_DISCOUNT).alias("DISC"),
    )
    return _with_code(named).withColumn("NSI", added(("Wholesale", "-DISC")))


def conform_snapshot(snapshots: DataFrame) -> DataFrame:
    """Rows of a profitability snapshot under the names of the conformed view."""
    return _with_code(
        snapshots.select(
            *PERIOD_KEYS,
            F.trim("ProfitCenterCode").alias(CODE),
            F.col("ProfitCenterName").alias(NAME),
            *[F.col(c).cast(MEASURE) for c in ("Volume", "Wholesale", "COGS", "DISC", "NSI")],
        )
    )


SUMMARY_MEASURES = ("ZRVOLUME", "ZRGLVOLUME", "ZRNSI", "ZRCOGS")


def conform_summary(summary: DataFrame, plant: DataFrame, by_warehouse: bool = False) -> DataFrame:
    """Sales summary: volume, GL volume, net sales and COGS.

    A plant and warehouse without volume does not count. ``by_warehouse`` keeps that
    grain; joined to a report it repeats the cost centre once per warehouse.
    """
    # Fixed-width text: the origin ignores trailing blanks when it compares.
    left_out = ", ".join(f"'{product}'" for product in LEFT_OUT_PRODUCTS)
    warehouses = (
        _with_code(
            summary.where(f"rtrim(PRDDESC) not in ({left_out})")
            .withColumnRenamed("fiscal_year", YEAR)
            .join(_plants(plant), "RSWHR")
        )
        .groupBy(*KEYS, "RSWHR")
        .agg(
            total("VOLPHYBCPP").alias("ZRVOLUME"),
            total("VOLGLUBCPP").alias("ZRGLVOLUME"),
            total("NSISM").alias("ZRNSI"),
            total("COGBCPP").alias("ZRCOGS"),
        )
        .where(F.col("ZRVOLUME") != 0)
    )
    if by_warehouse:
        return warehouses
    return warehouses.groupBy(*KEYS).agg(
        *[F.sum(m).cast(MEASURE).alias(m) for m in SUMMARY_MEASURES]
    )


def _conform_export(export: DataFrame, measures: tuple[str, ...]) -> DataFrame:
    report = clean_export(export)
    return _with_code(
        report.select(
            *PERIOD_KEYS,
            F.trim("ActCostCntrhostcode").alias(CODE),
            F.col("ActCostCntr").alias(NAME),
            *[F.col(m).cast(MEASURE) for m in measures],
        )
    )


def conform_gl_export(export: DataFrame) -> DataFrame:
    """Exported GL-unit report, one row per cost centre already."""
    measures = ("TotalGrossVol", "NSISimple", "CONANSISimple", "MMNSI", "COGSSimple")
    return _conform_export(export, measures)


def conform_physical_export(export: DataFrame) -> DataFrame:
    """Exported physical-volume report, one row per cost centre already."""
    return _conform_export(export, ("VolGrossSalesVolume",))
