"""Registered queries: the library's operators over the sample tables, all rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.checks.standins import YEAR_SHIFT, Samples
from tallymark.functions import fiscal, measures, text
from tallymark.lineage import settle, settle_all, shared_folder
from tallymark.operators import conform
from tallymark.operators.align import codes_in, codes_not_in, full_outer_align
from tallymark.operators.control import (
    control_totals,
    nearest_snapshot,
    nearest_snapshot_numbers,
    period_volumes,
)
from tallymark.operators.history import HistoryStore, append_changed, merge_distinct
from tallymark.operators.keys import CODE, KEYS, PERIOD, PERIOD_KEYS, YEAR
from tallymark.operators.merge import reaggregate
from tallymark.operators.rows import row_window
from tallymark.operators.versions import (
    DATE,
    MOST_RECENT,
    RUN_NUMBER,
    flag_latest,
    prepare_batch,
    unseen_rows,
)
from tallymark.plans import specs
from tallymark.plans.audit import audit_counts
from tallymark.plans.refresh import CLOSED, OPEN, from_nearest_snapshot
from tallymark.plans.reports import (
    Ledgers,
    build_report,
    build_unindexed_report,
    index_of,
    ledgers_of,
    narrowed,
)
from tallymark.sources.accounts import COGS, NSI, VOLUME, default_account_map
from tallymark.sources.dated import extract_folders
from tallymark.sources.exports import clean_export, read_export_csv, upper_headers
from tallymark.sources.landing import (
    LandingZone,
    cube_slice,
    extract_table_name,
    fiscal_keys,
    in_periods,
)
from tallymark.sources.snapshots import SnapshotStore
from tallymark.sources.workarea import decode_with_rejects, decode_work_area

RUN_DATE = dt.date(2020, 11, 30)
RUN_TS = "2020-11-30 09:15:00"
EARLIER_TS = "2020-11-29 16:00:00"
CURRENT = fiscal.FiscalPeriod(2020, 11)

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}

def money(col: str) -> Column:
    return F.col(col).cast("decimal(18,2)")


# Ledgers that a report reads twice: for its figures and for the index.
SHARED = ("profitability", "extract", "gl_export")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates as epoch days and timestamps as text, for comparison."""

    def column(field: T.StructField) -> Column:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, T.DateType):
            col = fiscal.epoch_days(col)
        elif isinstance(field.dataType, T.TimestampType):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        return col.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def query(name: str, gaps: bool = False) -> Callable:
    """Register a query over the sample tables; ``gaps`` where missing codes are its point."""

    def register(build: Callable[[Samples], DataFrame]) -> Callable[[Samples], DataFrame]:
        REGISTERED[name] = lambda spark, folder: plain(build(Samples(spark, folder, gaps)))
        return build

    return register


# Sources


@query("scan_prune_partition")
def scan_prune_partition(s: Samples) -> DataFrame:
    """The scan of two periods, chosen by literal values."""
    is_current = (F.col("year") == CURRENT.year) & (F.col("period") == CURRENT.period)
    return (
        s.extract()
        .where(in_periods("year", "period", [CURRENT, CURRENT.prior()]))
        .groupBy("year", "period")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("RSQTY").alias("rsqty"))
        .withColumn("table_name", extract_table_name(F.col("year"), F.col("period"), is_current))
    )


@query("extract_table_names")
def extract_table_names(s: Samples) -> DataFrame:
    """The name each period's extract has at its origin, with its size."""
    is_current = (F.col("year") == CURRENT.year) & (F.col("period") == CURRENT.period)
    return (
        s.extract()
        .groupBy("year", "period")
        .agg(F.count(F.lit(1)).alias("n_lines"))
        .withColumn("table_name", extract_table_name(F.col("year"), F.col("period"), is_current))
    )


@query("dated_extract_periods")
def dated_extract_periods(s: Samples) -> DataFrame:
    """Three periods from three landed folders; the oldest lacks a column that came later."""
    root, periods = shared_folder(s.spark), [CURRENT, CURRENT.prior(), CURRENT.prior().prior()]
    extract = s.extract().where(in_periods("year", "period", periods))
    name_of = extract_folders(CURRENT)
    for period in periods:
        rows = extract.where(in_periods("year", "period", [period])).drop("year", "period")
        rows = rows.drop("RSEXAM") if period == periods[-1] else rows
        rows.write.parquet(f"{root}/{name_of(period)}")
    read = LandingZone(s.spark, root).dated_extract(periods, CURRENT)
    return read.groupBy("year", "period", "RSMASG").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("RSQTY").alias("rsqty"), F.sum("RSEXAM").alias("rsexam")
    )


@query("export_period_ends")
def export_period_ends(s: Samples) -> DataFrame:
    """CSV exports, two files a period: the closing one is read up to a period, then the running one."""
    root, export = shared_folder(s.spark), s.gl_export()
    figures = [c for c, kind in export.dtypes if kind.startswith("decimal")]
    running = export.withColumns({c: (F.col(f"`{c}`") * 2).cast(export.schema[c].dataType) for c in figures})
    files = {"YES": export, "NO": running}
    for flag, rows in files.items():
        rows.write.csv(f"{root}/{flag}", header=True)
    both = [
        read_export_csv(s.spark, f"{root}/{flag}", export.schema).withColumn("PERIOD_END", F.lit(flag))
        for flag in files
    ]
    landed = shared_folder(s.spark)
    both[0].unionByName(both[1]).write.partitionBy("PERIOD_END").parquet(f"{landed}/gl_export")
    months = [fiscal.FiscalPeriod(y, p) for y in range(2010, 2031) for p in range(1, 13)]
    zone = LandingZone(s.spark, landed)
    chosen = zone.gl_export([m for m in months if m < CURRENT], [m for m in months if m >= CURRENT])
    return conform.conform_gl_export(chosen)


@query("scan_prune_keys")
def scan_prune_keys(s: Samples) -> DataFrame:
    """The ledger cube restricted to two fiscal keys."""
    kept = s.cube().where(fiscal_keys("FISCPER", [CURRENT, CURRENT.prior()]))
    return kept.groupBy("FISCPER", "VTYPE").agg(F.sum("AMOUNT").alias("AMOUNT"))


@query("decode_work_area")
def decode_work_area_rows(s: Samples) -> DataFrame:
    quantity, price = money("l_quantity"), money("l_extendedprice")
    signed = F.concat(
        quantity.cast("string"), F.when(F.col("l_returnflag") == "R", "-").otherwise("")
    )
    note = F.when(F.col("l_linenumber") == 7, "n/a").when(F.col("l_linenumber") == 6, "")
    work_area = F.concat_ws(
        ";",
        F.col("l_orderkey").cast("string"),
        F.col("l_linenumber").cast("string"),
        F.rpad("l_returnflag", 4, " "),
        signed,
        F.format_number(price, 2),
        note.otherwise(money("l_tax").cast("string")),
    )
    catalogue = [
        ("ORDERKEY  ", "N"), ("LINE", "I"), ("FLAG", "C"), ("QTY", "P"), ("PRICE", "P"),
        ("RATE", "P"),
    ]
    return decode_work_area(s.table("lineitem").select(work_area.alias("WA")), catalogue)


@query("work_area_rejects")
def work_area_rejects(s: Samples) -> DataFrame:
    """Numbers of a work area that are none, and why; blank ones are no fault."""
    number, price = F.col("l_linenumber"), money("l_extendedprice")
    quantity = F.when(number == 5, F.repeat(F.lit("9"), 31)).otherwise(money("l_quantity").cast("string"))
    rate = F.when(number == 7, "n/a").when(number == 6, " ").otherwise(money("l_tax").cast("string"))
    whole = F.concat_ws(";", quantity, F.format_number(price, 2), rate)
    line = F.when(number == 1, quantity).when(number == 2, F.concat(whole, F.lit(";x;y"))).otherwise(whole)
    rows = s.table("lineitem").select("l_orderkey", "l_linenumber", line.alias("WA"))
    catalogue = [("QTY", "P"), ("PRICE", "P"), ("RATE", "P")]
    return decode_with_rejects(rows, catalogue, ["l_orderkey", "l_linenumber"]).rejects


@query("cube_slice")
def cube_slice_sums(s: Samples) -> DataFrame:
    posted = (
        (F.col("VTYPE") == conform.CUBE_VALUE_TYPE)
        & (F.col("VERSION") == conform.CUBE_VERSION)
        & F.col("COSTCENTER").isNotNull()
    )
    rows = cube_slice(
        s.cube(), ["FISCPER", "COSTCENTER", "COSTELMNT"], ["AMOUNT", "QUANTITY"], posted
    )
    return rows.groupBy("FISCPER", "COSTCENTER").agg(
        F.sum("AMOUNT").alias("AMOUNT"), F.sum("QUANTITY").alias("QUANTITY")
    )


@query("report_clean")
def report_clean(s: Samples) -> DataFrame:
    return upper_headers(clean_export(s.gl_export()))


@query("fiscal_lookup")
def fiscal_lookup(s: Samples) -> DataFrame:
    days = (
        s.table("lineitem")
        .select(F.add_months(F.col("l_shipdate").cast("date"), 12 * YEAR_SHIFT).alias("day"))
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )
    return (
        fiscal.with_fiscal_period(days, "day", s.calendar())
        .groupBy("YEAR", "PERIOD")
        .agg(F.sum("n_lines").alias("n_lines"))
    )


@query("prior_period")
def prior_period(s: Samples) -> DataFrame:
    year = F.year("USADAT")
    before_year = fiscal.prior_year(year, "PERIOD")
    before = fiscal.prior_period("PERIOD")
    return s.calendar().select(
        F.col("USADAT").alias("usadat"),
        year.alias("year"),
        F.col("PERIOD").alias("period"),
        before_year.alias("prior_year"),
        before.alias("prior_period"),
        text.period_key(year, "PERIOD").alias("period_key"),
        text.period_key(before_year, before).alias("prior_key"),
        fiscal.day_stamp("USADAT").alias("day_stamp"),
    )


@query("excel_serial_dates")
def excel_serial_dates(s: Samples) -> DataFrame:
    unix_to_serial = 25569
    serial = fiscal.epoch_days(F.col("o_orderdate").cast("date")) + unix_to_serial
    orders = s.table("orders").groupBy(serial.alias("serial"))
    return orders.agg(F.count(F.lit(1)).alias("n_orders")).withColumn(
        "day", fiscal.date_of_serial("serial")
    )


@query("scalar_functions")
def scalar_functions(s: Samples) -> DataFrame:
    size = F.col("p_size")
    price = money("p_retailprice")
    return s.table("part").select(
        "p_partkey",
        text.substr_span("p_name", 2, 4).alias("name_part"),
        F.length("p_name").alias("name_length"),
        text.right_trimmed(F.rpad("p_brand", 12, " ")).alias("brand"),
        F.upper("p_type").alias("type_upper"),
        text.number_or_null(F.regexp_replace("p_brand", "[^0-9]", ""), T.IntegerType()).alias(
            "brand_number"
        ),
        text.number_or_null("p_name", T.IntegerType()).alias("no_number"),
        text.cost_centre_code(F.concat(F.lpad(size.cast("string"), 3, "0"), F.lit("0000"))).alias(
            "centre_code"
        ),
        measures.one_decimal_floor(price / 7).cast("double").alias("price_floor"),
        F.round(price / 8, 2).cast("double").alias("price_rounded"),
        F.abs(size - 25).alias("size_distance"),
        measures.indicator(size.isin(1, 10, 11)).alias("small_lot"),
        F.coalesce(F.when(size > 25, size), F.lit(0)).alias("size_filled"),
    )


@query("row_window")
def row_window_page(s: Samples) -> DataFrame:
    orders = s.table("orders").select(
        F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderkey", "o_orderpriority"
    )
    return row_window(orders, ["o_orderdate", "o_orderkey"], nrows=500, skip=200)


@query("row_window_ties")
def row_window_ties(s: Samples) -> DataFrame:
    """A key with many ties: the rest of the columns decides."""
    orders = s.table("orders").select("o_orderpriority", "o_orderkey")
    return row_window(orders, ["o_orderpriority"], nrows=700, skip=300)


@query("row_window_rest")
def row_window_rest(s: Samples) -> DataFrame:
    orders = s.table("orders").select(
        F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderkey", "o_orderpriority"
    )
    return row_window(orders, ["o_orderdate", "o_orderkey"], skip=200)


# Conformed ledgers


@query("account_class_sums")
def account_class_sums(s: Samples) -> DataFrame:
    return s.ledger("cube")


@query("account_class_outer")
def account_class_aligned(s: Samples) -> DataFrame:
    """One sum per class, each summed by itself and then aligned by an outer join."""
    postings = (
        s.cube()
        .where((F.col("VTYPE") == 10) & (F.col("VERSION") == 0) & F.col("COSTCENTER").isNotNull())
        .join(default_account_map(s.spark).withColumnRenamed("element", "COSTELMNT"), "COSTELMNT")
        .groupBy("FISCPER", "COSTCENTER", "account_class")
        .agg(F.sum("AMOUNT").alias("amount"))
    )
    sums = settle(postings)

    def of(account_class: str, centre: str, name: str) -> DataFrame:
        return sums.where(F.col("account_class") == account_class).select(
            "FISCPER", F.col("COSTCENTER").alias(centre), F.col("amount").alias(name)
        )

    keys = ["FISCPER", "CostCenter"]
    aligned = full_outer_align(
        of(VOLUME, "CostCenter", "Volume"), of(COGS, "centre", "COGS"), keys,
        {"centre": "CostCenter"},
    )
    return full_outer_align(aligned, of(NSI, "centre", "NSI"), keys, {"centre": "CostCenter"})


@query("star_rollup")
def star_rollup(s: Samples) -> DataFrame:
    return s.ledger("extract")


@query("indicator_measures")
def indicator_measures(s: Samples) -> DataFrame:
    return conform.conform_extract_by_group(
        s.extract(), s.plant(), s.article()
    )


@query("copa_net_measures")
def copa_net_measures(s: Samples) -> DataFrame:
    return s.ledger("profitability")


@query("summary_rollup")
def summary_rollup(s: Samples) -> DataFrame:
    return conform.conform_summary(s.summary(), s.plant(), by_warehouse=True)


@query("summary_by_plant")
def summary_by_plant(s: Samples) -> DataFrame:
    return s.ledger("summary")


@query("physical_export_rows")
def physical_export_rows(s: Samples) -> DataFrame:
    return s.ledger("physical_export")


@query("union_reaggregate")
def union_reaggregate(s: Samples) -> DataFrame:
    invoiced = s.ledger("extract").select(
        *KEYS, F.col("VOLUMEPHYSICAL").alias("volume"), F.col("COGS").alias("cogs")
    )
    summarised = s.ledger("summary").select(
        *KEYS, F.col("ZRVOLUME").alias("volume"), F.col("ZRCOGS").alias("cogs")
    )
    return reaggregate([invoiced, summarised], KEYS, ["volume", "cogs"]).orderBy(*KEYS)


# Control totals and snapshots


@query("stray_period_volume")
def stray_period_volume(s: Samples) -> DataFrame:
    return period_volumes(s.extract())


def _controls(s: Samples) -> DataFrame:
    return control_totals(s.ledger("extract"), period_volumes(s.extract()))


@query("control_total")
def control_total(s: Samples) -> DataFrame:
    return _controls(s)


@query("nearest_snapshot_number")
def nearest_snapshot_number(s: Samples) -> DataFrame:
    return nearest_snapshot_numbers(s.snapshots(), _controls(s))


@query("nearest_snapshot")
def nearest_snapshot_rows(s: Samples) -> DataFrame:
    return nearest_snapshot(*settle_all([s.snapshots(), _controls(s)]))


@query("nearest_snapshot_stored")
def nearest_snapshot_stored(s: Samples) -> DataFrame:
    """The same from stored snapshots: chosen by their totals, read by partition."""
    store = SnapshotStore(s.spark, shared_folder(s.spark))
    store.add(s.snapshots())
    return store.nearest(_controls(s))


# Alignment


@query("system_index", gaps=True)
def system_index(s: Samples) -> DataFrame:
    return index_of(s.ledgers(*SHARED).settled("profitability"))


@query("code_membership", gaps=True)
def code_membership(s: Samples) -> DataFrame:
    ledgers = s.ledgers(*SHARED).settled(*SHARED)
    not_in_view = codes_not_in(ledgers.extract, ledgers.profitability, KEYS)
    not_in_extract = codes_not_in(ledgers.profitability, ledgers.extract, KEYS)
    named = codes_in(ledgers.gl_export, not_in_view, KEYS).select(*KEYS)

    def tagged(df: DataFrame, tag: str) -> DataFrame:
        return df.withColumn("found", F.lit(tag))

    return (
        tagged(not_in_view, "extract only")
        .unionByName(tagged(not_in_extract, "view only"))
        .unionByName(tagged(named, "extract only, named"))
    )


def _aligned(s: Samples) -> DataFrame:
    ledgers = s.ledgers("profitability", "extract", "cube")
    view = ledgers.profitability.select(*KEYS, F.col("Volume").alias("view_volume"))
    extract = ledgers.extract.select(*KEYS, F.col("VOLUMEPHYSICAL").alias("extract_volume"))
    cube = ledgers.cube.select(*KEYS, F.col("Volume").alias("cube_volume"))
    return full_outer_align(full_outer_align(view, extract, KEYS), cube, KEYS)


@query("full_outer_align", gaps=True)
def outer_align(s: Samples) -> DataFrame:
    aligned = _aligned(s).withColumn("no_view", measures.indicator(F.col("view_volume").isNull()))
    return measures.fill_zero(aligned, ["view_volume", "extract_volume"])


@query("variance_fallback", gaps=True)
def variance_fallback(s: Samples) -> DataFrame:
    return _aligned(s).withColumns(
        {
            "plain_var": measures.variance("view_volume", "extract_volume"),
            "fallback_var": measures.variance("view_volume", "cube_volume", "extract_volume"),
            "own_fallback_var": measures.variance(
                "view_volume", "extract_volume", "extract_volume"
            ),
            "opposite_var": measures.variance(
                "view_volume", "cube_volume", "extract_volume", sign=+1
            ),
        }
    )


# Reports



def report_of(s: Samples, spec: specs.ReportSpec) -> DataFrame:
    ledgers = narrowed(s.ledgers(*ledgers_of(spec)), spec).settled()
    return build_report(ledgers, index_of(ledgers), spec, RUN_DATE, CLOSED)


@query("report_physical", gaps=True)
def report_physical(s: Samples) -> DataFrame:
    return report_of(s, specs.PHYSICAL)


@query("report_gl", gaps=True)
def report_gl(s: Samples) -> DataFrame:
    return report_of(s, specs.GL)


@query("report_nsi", gaps=True)
def report_nsi(s: Samples) -> DataFrame:
    return report_of(s, specs.NSI)


@query("report_cogs", gaps=True)
def report_cogs(s: Samples) -> DataFrame:
    return report_of(s, specs.COGS)


def unindexed_report_of(s: Samples, spec: specs.ReportSpec) -> DataFrame:
    ledgers = s.ledgers(*[side.ledger for side in spec.sides])
    return build_unindexed_report(ledgers, spec, RUN_DATE, CLOSED)


@query("report_physical_old", gaps=True)
def report_physical_old(s: Samples) -> DataFrame:
    return unindexed_report_of(s, specs.PHYSICAL)


@query("report_gl_old", gaps=True)
def report_gl_old(s: Samples) -> DataFrame:
    return unindexed_report_of(s, specs.GL)


@query("report_nsi_old", gaps=True)
def report_nsi_old(s: Samples) -> DataFrame:
    return unindexed_report_of(s, specs.NSI)


@query("report_cogs_old", gaps=True)
def report_cogs_old(s: Samples) -> DataFrame:
    return unindexed_report_of(s, specs.COGS)


def _pair_of(s: Samples, spec: specs.ReportSpec) -> DataFrame:
    """Every period as a closed one and as an open one, as a run in each period would."""
    names = ledgers_of(spec)
    extract = s.ledger("extract")  # its volume also makes the control total
    ledgers = narrowed(s.ledgers(*names), spec)._replace(extract=extract)
    *settled, volumes, snapshots = settle_all(
        [*[getattr(ledgers, n) for n in names], period_volumes(s.extract()), s.snapshots()]
    )
    closed = Ledgers(**dict(zip(names, settled)))
    opened = from_nearest_snapshot(closed, volumes, snapshots).settled("profitability")
    ended = build_report(closed, index_of(closed), spec, RUN_DATE, CLOSED)
    running = build_report(opened, index_of(opened), spec, RUN_DATE, OPEN)
    return ended.unionByName(running)


@query("period_pair_physical", gaps=True)
def period_pair_physical(s: Samples) -> DataFrame:
    return _pair_of(s, specs.PHYSICAL)


@query("period_pair_gl", gaps=True)
def period_pair_gl(s: Samples) -> DataFrame:
    return _pair_of(s, specs.GL)


@query("period_pair_cogs", gaps=True)
def period_pair_cogs(s: Samples) -> DataFrame:
    return _pair_of(s, specs.COGS)


@query("period_pair_nsi", gaps=True)
def period_pair_nsi(s: Samples) -> DataFrame:
    return _pair_of(s, specs.NSI)


# History


@query("latest_flag")
def latest_flag(s: Samples) -> DataFrame:
    runs = (
        s.coded_lines()
        .groupBy(
            F.col("year").alias(YEAR),
            F.col("period").alias(PERIOD),
            F.col("code").alias(CODE),
            F.col("shipped").alias(DATE),
            F.col("l_linenumber").alias(RUN_NUMBER),
        )
        .agg(F.sum("quantity").alias("VOLUME"))
    )
    return flag_latest(settle(runs))


def _batch(s: Samples) -> DataFrame:
    """A report, with a line of a blank code for each of the code 001; blanks never count."""
    report = settle(report_of(s, specs.PHYSICAL))
    blank = report.where(F.col(CODE) == "001").withColumn(CODE, F.lit("   "))
    return report.unionByName(blank)


def _stored_before(batch: DataFrame) -> DataFrame:
    """A history the batch partly repeats; what differs depends on the period.

    1-3 same rows, 4-6 same figures a day earlier, 7-9 one cent off for the low
    codes, 10 a tenth of a cent off, 11 the high codes absent, 12 nothing stored.
    """
    period, low = F.col(PERIOD), F.col(CODE) < "010"
    moved = (
        F.when(period.between(7, 9) & low, F.col("HANAVOLUME") + F.lit("0.01").cast(measures.MONEY))
        .when(period == 10, F.col("HANAVOLUME") + F.lit("0.001").cast(measures.MONEY))
        .otherwise(F.col("HANAVOLUME"))
    )
    rows = prepare_batch(batch).where((period < 11) | ((period == 11) & low))
    return rows.withColumns(
        {
            "HANAVOLUME": moved.cast(measures.MEASURE),
            DATE: F.when(period.between(4, 6), F.date_sub(DATE, 1)).otherwise(F.col(DATE)),
            RUN_NUMBER: F.when(period.between(7, 9), 2).otherwise(1),
            MOST_RECENT: F.lit("YES"),
            "DATETIME": fiscal.timestamp_literal(EARLIER_TS),
        }
    )


@query("batch_is_new", gaps=True)
def batch_is_new(s: Samples) -> DataFrame:
    batch = _batch(s)
    prepared = prepare_batch(batch)
    unseen = unseen_rows(prepared, _stored_before(batch))
    counts = unseen.groupBy(*PERIOD_KEYS).agg(F.count(F.lit(1)).alias("n_unseen"))
    return (
        prepared.select(*PERIOD_KEYS)
        .distinct()
        .join(counts, PERIOD_KEYS, "left")
        .fillna(0, ["n_unseen"])
        .withColumn("is_new", F.when(F.col("n_unseen") > 0, "YES").otherwise("NO"))
    )


@query("history_append_changed", gaps=True)
def history_append_changed(s: Samples) -> DataFrame:
    batch = _batch(s)
    return append_changed(_stored_before(batch), batch, RUN_TS)


@query("history_append_same", gaps=True)
def history_append_same(s: Samples) -> DataFrame:
    batch = _batch(s)
    once = append_changed(_stored_before(batch), batch, EARLIER_TS)
    return append_changed(once, batch, RUN_TS)


@query("history_store_runs", gaps=True)
def history_store_runs(s: Samples) -> DataFrame:
    """Four runs on two dates through the stored history, and a rewriting of the first date."""
    batch = settle(_batch(s))
    stored = settle(_stored_before(batch).drop(MOST_RECENT, RUN_NUMBER, "DATETIME"))
    store, name = HistoryStore(s.spark, shared_folder(s.spark)), specs.PHYSICAL.name
    runs = [
        (stored.where(F.col(DATE) < RUN_DATE), RUN_DATE - dt.timedelta(days=1)),
        (stored.where(F.col(DATE) == RUN_DATE), RUN_DATE), (batch, RUN_DATE), (batch, RUN_DATE),
    ]
    for number, (rows, date) in enumerate(runs):
        store.append(name, rows, f"run{number}", date, dt.datetime.fromisoformat(RUN_TS))
    schema = prepare_batch(batch).schema
    store.compact(name, schema, RUN_DATE)
    return store.read(name, schema)


@query("distinct_merge")
def distinct_merge(s: Samples) -> DataFrame:
    """Stored sheet, its dates as spreadsheet serials, merged with a batch in epoch days."""
    sales = (
        s.coded_lines()
        .groupBy(
            F.col("year").alias(YEAR),
            F.col("period").alias(PERIOD),
            F.col("code").alias(CODE),
            F.col("l_returnflag").alias("flag"),
        )
        .agg(F.sum("quantity").alias("VOLUME"))
    )
    sales = settle(sales)
    serial = (F.col(PERIOD) + 43100).alias("serial")
    sheet = sales.where(F.col("flag") != "R").select(
        *KEYS, "VOLUME", fiscal.date_of_serial(serial).alias(DATE), F.lit(1).alias(RUN_NUMBER),
        F.lit("YES").alias(MOST_RECENT),
    )
    days = F.col(PERIOD) + 43100 - 25569 + F.when(F.col("flag") == "R", 1).otherwise(0)
    batch = sales.where(F.col("flag") != "A").select(
        *KEYS, "VOLUME", fiscal.date_of_epoch_days(days).alias(DATE), F.lit(1).alias(RUN_NUMBER),
        F.lit(None).cast("string").alias(MOST_RECENT),
    )
    return merge_distinct(sheet, batch)


@query("audit_counts")
def audit_table_counts(s: Samples) -> DataFrame:
    ledgers: Ledgers = s.ledgers()
    return audit_counts(ledgers._asdict())
