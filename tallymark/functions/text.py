"""Text and number parsing as column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.measures import ColumnLike, as_column

# Thirty whole digits and eight decimals. A number with more whole digits does not fit
# and counts as malformed; a packed decimal has 31 digits, its decimals among them.
PARSED = T.DecimalType(38, 8)


def substr_span(col: ColumnLike, first: int, last: int) -> Column:
    """Characters ``first`` to ``last``, both included, counted from 1."""
    return F.substring(as_column(col), first, last - first + 1)


def number_or_null(col: ColumnLike, dtype: T.DataType = PARSED) -> Column:
    """Text to number; text that is not a number becomes null instead of an error."""
    return as_column(col).try_cast(dtype)


def _sign_first(col: ColumnLike) -> Column:
    """Exported number text without clutter, a trailing minus moved to the front."""
    # The two patterns.
    digits = F.regexp_replace(as_column(col), r"[^\d.\-]", "")
    # Few numbers carry a trailing minus; the others are spared the second pattern.
    moved = F.regexp_replace(digits, r"([0-9.]+)-$", "-$1")
    return F.when(digits.endswith("-"), moved).otherwise(digits)


def signed_number(col: ColumnLike, dtype: T.DataType = PARSED) -> Column:
    """Exported number text to number: strip clutter, move a trailing minus, bad -> 0."""
    return F.coalesce(number_or_null(_sign_first(col), dtype), F.lit(0).cast(dtype))


MALFORMED, TOO_LARGE, MISSING = "malformed", "too large", "missing"


def number_fault(col: ColumnLike, dtype: T.DataType = PARSED) -> Column:
    """Why a text is no number though :func:`signed_number` makes it 0; null if it is one.

    Null is a field the line does not have. A blank text is an empty number, not a fault.
    """
    text, cleaned = as_column(col), _sign_first(col)
    fault = F.when(cleaned.rlike(r"^-?\d+\.?\d*$"), TOO_LARGE).otherwise(MALFORMED)
    parsed = (F.trim(text) == "") | number_or_null(cleaned, dtype).isNotNull()
    return F.when(text.isNull(), MISSING).when(~parsed, fault)


def right_trimmed(col: ColumnLike) -> Column:
    return F.regexp_replace(as_column(col), r"\s+$", "")


def cost_centre_code(col: ColumnLike) -> Column:
    """Three-digit code from the front of a longer cost-centre number.

    Zeros in front are kept, so ``0110000`` meets plant ``011``. A prefix that is
    no number has no code: it becomes null and the conform step drops the row.
    """
    number = substr_span(col, 1, 3).try_cast("int")
    return F.lpad(number.cast("string"), 3, "0")


def period_key(year: ColumnLike, period: ColumnLike, width: int = 3) -> Column:
    """Fiscal key: year, then the period padded with zeros (``2018004``)."""
    padded = F.lpad(as_column(period).cast("string"), width, "0")
    return F.concat(as_column(year).cast("string"), padded)


def period_key_text(year: int, period: int, width: int = 3) -> str:
    return f"{year}{period:0{width}d}"


def key_year(key: ColumnLike) -> Column:
    return substr_span(key, 1, 4).try_cast("int")


def key_period(key: ColumnLike) -> Column:
    return substr_span(key, 5, 7).try_cast("int")
