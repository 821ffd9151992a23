"""Landed folders that hold one period or one year each, under the names of the origin.

The origin keeps the running period (or year) in a live table and every earlier one in a
dated copy. Copies were made over years, so a folder may lack columns that came later.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.fiscal import FiscalPeriod
from tallymark.sources.schemas import meet_schema

# The names of the live tables, which the dated ones begin with.
EXTRACT_NAME, EXTRACT_LIVE = "KOEXT", "KOEXTT"
SUMMARY_NAME = "ZRTLRS"

Naming = Callable[[FiscalPeriod], str]


def extract_folders(current: FiscalPeriod) -> Naming:
    """Folder of a period's invoice extract: the live one, or a copy named by year and period."""

    def name(period: FiscalPeriod) -> str:
        if period == current:
            return EXTRACT_LIVE
        return f"{EXTRACT_NAME}{period.year % 100:02d}{period.period:02d}"

    return name


def summary_folders(current_year: int) -> Naming:
    """Folder of a period's sales summary: the live one of a year, or a copy named by its year."""

    def name(period: FiscalPeriod) -> str:
        return SUMMARY_NAME + ("" if period.year == current_year else str(period.year))

    return name


class DatedTables:
    """Landed folders by period."""

    def __init__(self, spark: SparkSession, root: str, name_of: Naming):
        self.spark, self.root, self.name_of = spark, root.rstrip("/"), name_of

    def _folder(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def read(
        self, periods: Iterable[FiscalPeriod], schema: T.StructType, keys: tuple[str, str],
        optional: Collection[str] = (),
    ) -> DataFrame:
        """Rows of the periods from their folders.

        ``keys`` are the year and period columns of ``schema``. A folder without a period column
        holds one period and its rows get it; one with such a column is filtered by it.
        Columns in ``optional`` that a folder lacks are null; others must be there. Every
        folder that is missing is named in one error.
        """
        year_col, period_col = keys
        wanted: dict[str, list[FiscalPeriod]] = {}
        for period in dict.fromkeys(periods):
            wanted.setdefault(self.name_of(period), []).append(period)
        if not wanted:
            return self.spark.createDataFrame([], schema)
        found = {name: self._folder(name) for name in wanted}
        missing = [f"{p.year}-{p.period:02d} ({name})" for name, ps in wanted.items() if found[name] is None for p in ps]
        if missing:
            raise LookupError(f"no landed folder in {self.root} for {', '.join(missing)}")
        parts = []
        for name, of_folder in wanted.items():
            rows, year = found[name], of_folder[0].year
            present = {c.lower() for c in rows.columns}
            if period_col.lower() in present:
                rows = rows.where(F.col(period_col).isin([p.period for p in of_folder]))
            elif len(of_folder) > 1:
                raise ValueError(f"{name} stands for several periods but has no column {period_col}")
            else:
                rows = rows.withColumn(period_col, F.lit(of_folder[0].period))
            absent = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name in optional and f.name.lower() not in present}
            parts.append(meet_schema(rows.withColumn(year_col, F.lit(year)).withColumns(absent), schema))
        return reduce(DataFrame.unionByName, parts)
