"""Assembly of the reports from conformed ledgers."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.measures import fill_zero_numeric
from tallymark.lineage import settle_all
from tallymark.operators.align import align_all
from tallymark.operators.index import system_index
from tallymark.operators.keys import CODE, KEYS, NAME, PERIOD, YEAR
from tallymark.plans.specs import REPORTS, ReportSpec, Side


class Ledgers(NamedTuple):
    """The conformed frames of the five systems, keyed by year, period and code.

    A plan that needs only some of them may leave the others out.
    """

    profitability: DataFrame | None = None
    extract: DataFrame | None = None
    cube: DataFrame | None = None
    gl_export: DataFrame | None = None
    physical_export: DataFrame | None = None
    summary: DataFrame | None = None

    def settled(self, *names: str) -> Ledgers:
        """Compute the named ledgers once (all by default) for the plans that share them.

        A report reads a ledger for its figures and, through the index, for its codes.
        Left lazy, each use would scan that system's whole extract again.
        """
        present = [n for n in names or self._fields if getattr(self, n) is not None]
        settled = settle_all([getattr(self, n) for n in present])
        return self._replace(**dict(zip(present, settled)))


# Columns the index reads besides the keys.
INDEX_COLUMNS = {"profitability": (NAME, "Volume"), "extract": (), "gl_export": (NAME,)}


def columns_of(spec: ReportSpec) -> dict[str, list[str]]:
    """Ledgers a report and its index read, with the columns they take besides the keys."""
    columns = {name: list(index_columns) for name, index_columns in INDEX_COLUMNS.items()}
    for side in spec.sides:
        taken = columns.setdefault(side.ledger, [])
        taken.extend(c for c in side.figures if c not in taken)
    return columns


def ledgers_of(spec: ReportSpec) -> list[str]:
    """Ledgers a report and its index read."""
    return list(columns_of(spec))


def narrowed(ledgers: Ledgers, spec: ReportSpec) -> Ledgers:
    """Only what one report reads, so that the scans beneath leave out the rest.

    Worth it before settling the ledgers for a single report; a run of all four
    reports needs every column anyway.
    """
    return Ledgers(
        **{
            name: getattr(ledgers, name).select(*KEYS, *columns)
            for name, columns in columns_of(spec).items()
        }
    )


def _figures(ledgers: Ledgers, side: Side, *also: str) -> DataFrame:
    ledger = getattr(ledgers, side.ledger)
    return ledger.select(*KEYS, *also, *[F.col(c).alias(out) for c, out in side.figures.items()])


def _stamped(
    df: DataFrame, spec: ReportSpec, run_date: dt.date, period_end: str, *tags: str
) -> DataFrame:
    """Report columns in their order, stamped with the run."""
    stamps: list[Column | str] = [
        F.lit(run_date).alias("DATE"), PERIOD, YEAR, F.lit(period_end).alias("PERIODEND"),
    ]
    return df.select(CODE, "COSTCENTER", *spec.figures, *stamps, *tags)


def build_report(
    ledgers: Ledgers, index: DataFrame, spec: ReportSpec, run_date: dt.date, period_end: str
) -> DataFrame:
    """One report: the index's cost centres with every ledger's figures and variances.

    Every code of the index is in the profitability view or the extract, so left
    joins from the index give the rows that outer-joining all ledgers and keeping
    the indexed codes would.
    """
    aligned = index.withColumnRenamed(NAME, "COSTCENTER")
    for side in spec.sides:
        if side.required:
            named = getattr(ledgers, side.ledger).where(F.col(NAME).isNotNull())
            ledger = _figures(ledgers._replace(**{side.ledger: named}), side)
            aligned = aligned.join(ledger, KEYS, "inner")
        else:
            aligned = aligned.join(_figures(ledgers, side), KEYS, "left")
        aligned = side.apply(aligned)
    if spec.fill_rest:
        aligned = fill_zero_numeric(aligned)
    return _stamped(aligned, spec, run_date, period_end, "System")


def build_reports(
    ledgers: Ledgers, run_date: dt.date, period_end: str
) -> dict[str, DataFrame]:
    """All four reports over one set of ledgers."""
    index = index_of(ledgers)
    return {
        spec.name: build_report(ledgers, index, spec, run_date, period_end) for spec in REPORTS
    }


def index_of(ledgers: Ledgers) -> DataFrame:
    return system_index(ledgers.profitability, ledgers.extract, ledgers.gl_export)


def build_unindexed_report(
    ledgers: Ledgers, spec: ReportSpec, run_date: dt.date, period_end: str
) -> DataFrame:
    """Earlier form of a report: every code of any ledger, without the index and its tag.

    Figures are not filled before the variances, and the name is the first ledger's.
    """
    first, *others = spec.sides
    named = _figures(ledgers, first, NAME).withColumnRenamed(NAME, "COSTCENTER")
    aligned = align_all([named, *[_figures(ledgers, side) for side in others]], KEYS)
    there = F.lit(False)
    for number, side in enumerate(spec.sides):
        # A step holds for rows of the sides so far; rows of later ones do not know it.
        there |= F.col(f"IN_{number}")
        made = [v.name for v in side.variances] + list(side.zeroed)
        aligned = side.apply(aligned, fill=False)
        aligned = aligned.withColumns({c: F.when(there, F.col(c)) for c in made}) if made else aligned
    if any(side.required for side in spec.sides):
        aligned = aligned.where(F.col("COSTCENTER").isNotNull())
    if spec.fill_rest:
        aligned = fill_zero_numeric(aligned)
    return _stamped(aligned, spec, run_date, period_end)
