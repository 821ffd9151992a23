"""Measures are exact decimals, so a sum does not depend on task order or retries.

That matters for the history: a batch is appended when a figure rounded to two
digits differs, and a floating sum that moves in its last bit between two runs of
the same data could cross a rounding edge and append a batch for nothing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str

MONEY = T.DecimalType(18, 4)  # a landed amount or quantity
FACTOR = T.DecimalType(12, 6)  # a landed conversion factor
MEASURE = T.DecimalType(28, 8)  # a conformed or derived figure


def as_column(col: ColumnLike) -> Column:
    return F.col(col) if isinstance(col, str) else col


def total(col: str) -> Column:
    """SUM that skips nulls and is null over no rows."""
    return _sum_as_measure(_money(col))


def total_of_product(amount: str, factor: str) -> Column:
    return _sum_as_measure(f"{_money(amount)} * cast(`{factor}` as {FACTOR.simpleString()})")


def total_where(condition: str, col: str) -> Column:
    """SUM over the rows that meet a condition; 0 where none does."""
    return _sum_as_measure(f"case when {condition} then {_money(col)} else 0BD end")


def total_only_where(condition: str, col: str) -> Column:
    """SUM over the rows that meet a condition; null where none does."""
    return _sum_as_measure(f"case when {condition} then {_money(col)} end")


def _money(col: str) -> str:
    return f"cast(`{col}` as {MONEY.simpleString()})"


def _sum_as_measure(amount: str) -> Column:
    return F.expr(f"cast(sum({amount}) as {MEASURE.simpleString()})")


def one_of(col: str, values: Iterable[str]) -> str:
    """SQL condition: the column holds one of the texts."""
    listed = ", ".join(f"'{v}'" for v in values)
    return f"`{col}` in ({listed})"


def indicator(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def missing_or_zero(col: ColumnLike) -> Column:
    column = as_column(col)
    return column.isNull() | (column == 0)


def variance(
    base: ColumnLike, other: ColumnLike, fallback: ColumnLike | None = None, sign: int = -1
) -> Column:
    """``base + sign * other``, with ``fallback`` in place of an absent or zero base.

    ``sign`` is +1 for a ledger that books with the opposite sign. Giving ``other``
    itself as fallback yields 0 where the base is absent, and null where both are.
    """
    base, other = as_column(base), as_column(other)

    def against(reference: Column) -> Column:
        return (reference - other if sign < 0 else reference + other).cast(MEASURE)

    if fallback is None:
        return against(base)
    return F.when(missing_or_zero(base), against(as_column(fallback))).otherwise(against(base))


def one_decimal_floor(col: ColumnLike) -> Column:
    return F.floor(as_column(col) * 10) / 10


def fill_zero(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Null -> 0 in the named columns."""
    columns = list(columns)
    return df.fillna(0, subset=columns) if columns else df


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def fill_zero_numeric(df: DataFrame) -> DataFrame:
    """Null -> 0 in every numeric column; text nulls stay null."""
    return fill_zero(df, numeric_columns(df))


def round_figures(df: DataFrame, digits: int = 2) -> DataFrame:
    """Round every fractional column half away from zero; the column types stay."""
    fractional = (T.DecimalType, T.DoubleType, T.FloatType)
    rounded = {
        f.name: F.round(F.col(f.name), digits).cast(f.dataType)
        for f in df.schema.fields
        if isinstance(f.dataType, fractional)
    }
    return df.withColumns(rounded) if rounded else df
