"""Scans of landed tables, with the period choice as a partition filter."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.fiscal import FiscalPeriod
from tallymark.functions.text import period_key_text
from tallymark.sources import schemas
from tallymark.sources.dated import DatedTables, extract_folders, summary_folders
from tallymark.sources.exports import of_period_ends
from tallymark.sources.schemas import meet_schema

Periods = Iterable[FiscalPeriod] | None
#: Columns that only some figures need and that older dated extracts may lack.
LATER_EXTRACT_COLUMNS = ("RSMATL", "RSDAT", "RSSPCQTY", "RSEXAM")


class LandingZone:
    """Folder of landed extracts; partitioned tables are pruned by period."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        return meet_schema(self.table(name), schema)

    def calendar(self) -> DataFrame:
        return self._read("calendar", schemas.CALENDAR)

    def cube(self, periods: Periods = None) -> DataFrame:
        rows = self.table("cube")
        return meet_schema(rows.where(fiscal_keys("FISCPER", periods)), schemas.CUBE)

    def account_map(self) -> DataFrame:
        return self._read("account_map", schemas.ACCOUNT_MAP)

    def extract(self, periods: Periods = None) -> DataFrame:
        rows = self.table("extract")
        return meet_schema(rows.where(in_periods("year", "period", periods)), schemas.EXTRACT)

    def dated_extract(self, periods: Iterable[FiscalPeriod], current: FiscalPeriod) -> DataFrame:
        """The extract where it landed as the origin's own tables, one folder per period."""
        tables = DatedTables(self.spark, self.root, extract_folders(current))
        return tables.read(periods, schemas.EXTRACT, ("year", "period"), LATER_EXTRACT_COLUMNS)

    def yearly_summary(self, periods: Iterable[FiscalPeriod], current_year: int) -> DataFrame:
        """The summary where it landed as one folder per year."""
        tables = DatedTables(self.spark, self.root, summary_folders(current_year))
        return tables.read(periods, schemas.SUMMARY, ("fiscal_year", "PERIOD"))

    def plant(self) -> DataFrame:
        return self._read("plant", schemas.PLANT)

    def article(self) -> DataFrame:
        return self._read("article", schemas.ARTICLE)

    def adjustment_type(self) -> DataFrame:
        return self._read("adjustment_type", schemas.ADJUSTMENT_TYPE)

    def summary(self, periods: Periods = None) -> DataFrame:
        rows = self.table("summary")
        kept = rows.where(in_periods("fiscal_year", "PERIOD", periods))
        return meet_schema(kept, schemas.SUMMARY)

    def profitability(self, periods: Periods = None, currency_type: str = "10") -> DataFrame:
        """The profitability view; its parameter is a filter on the landed rows."""
        rows = self.table("profitability").where(F.col("CurrencyType") == currency_type)
        kept = rows.where(fiscal_keys("FiscalYearPeriod", periods))
        return meet_schema(kept, schemas.PROFITABILITY)

    def gl_export(self, closed: Periods = None, opened: Periods = None) -> DataFrame:
        return self._export("gl_export", schemas.GL_EXPORT, closed, opened)

    def physical_export(self, closed: Periods = None, opened: Periods = None) -> DataFrame:
        return self._export("physical_export", schemas.PHYSICAL_EXPORT, closed, opened)

    def _export(
        self, name: str, schema: T.StructType, closed: Periods, opened: Periods
    ) -> DataFrame:
        """Exported report: closed periods from the period-end file, open ones from the other."""
        wanted = [in_periods("YEAR", "PERIOD", periods) for periods in (closed, opened)]
        return meet_schema(of_period_ends(self.table(name), *wanted), schema).drop("PERIOD_END")

    def snapshots(self, periods: Periods = None) -> DataFrame:
        """Numbered snapshots of the profitability figures, one partition per number."""
        rows = self.table("snapshots")
        return meet_schema(rows.where(in_periods("YEAR", "PERIOD", periods)), schemas.SNAPSHOT)


def in_periods(year_col: str, period_col: str, periods: Periods) -> Column:
    """Rows of the given periods, as literals so that partitions are pruned."""
    if periods is None:
        return F.lit(True)
    wanted = [(F.col(year_col) == p.year) & (F.col(period_col) == p.period) for p in periods]
    return reduce(lambda a, b: a | b, wanted, F.lit(False))


def fiscal_keys(key_col: str, periods: Periods) -> Column:
    """Rows whose YYYYPPP key is one of the given periods."""
    if periods is None:
        return F.lit(True)
    return F.col(key_col).isin([period_key_text(p.year, p.period) for p in periods])


def cube_slice(
    cube: DataFrame, characteristics: list[str], key_figures: list[str], restriction: Column
) -> DataFrame:
    """Chosen characteristics and key figures of the cube rows that meet a restriction."""
    return cube.where(restriction).select(*characteristics, *key_figures)


def extract_table_name(year: Column, period: Column, is_current: Column) -> Column:
    """Name under which the origin keeps a period: the live extract or a dated copy."""
    two_digit_year = F.substring(year.cast("string"), 3, 2)
    dated = F.concat(F.lit("KOEXT"), two_digit_year, F.lpad(period.cast("string"), 2, "0"))
    return F.when(is_current, F.lit("KOEXTT")).otherwise(dated)


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    num_partitions: int = 1,
    **options: str,
) -> DataFrame:
    """Query a database directly, split over tasks when a partition column is given."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column is None:
        return reader.option("query", query).load()
    if bounds is None:
        raise ValueError("a partition column needs its lower and upper bound")
    return (
        reader.option("dbtable", f"({query}) landed")
        .option("partitionColumn", partition_column)
        .option("lowerBound", bounds[0])
        .option("upperBound", bounds[1])
        .option("numPartitions", num_partitions)
        .load()
    )
