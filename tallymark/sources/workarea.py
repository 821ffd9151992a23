"""Decode of delimited work areas: one text column, typed by a field catalogue."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.text import number_fault, right_trimmed, signed_number
from tallymark.lineage import settle
from tallymark.operators.rows import row_window

# Catalogue types that hold a number.
NUMERIC_TYPES = ("N", "I", "P")
TOO_MANY = "too many fields"
_FAULTS = "__faults"


class CatalogueField(NamedTuple):
    name: str
    type: str


class WorkArea(NamedTuple):
    """Decoded rows, and for each number that did not parse its row, field, text and reason."""

    rows: DataFrame
    rejects: DataFrame


def _parts(text_col: str, delimiter: str) -> Column:
    return F.split(F.col(f"`{text_col}`"), re.escape(delimiter), -1)


def _typed(part: Column, kind: str) -> Column:
    return signed_number(part) if kind in NUMERIC_TYPES else right_trimmed(part)


def decode_with_rejects(
    rows: DataFrame,
    catalogue: Iterable[tuple[str, str]],
    row_keys: Sequence[str],
    text_col: str = "WA",
    delimiter: str = ";",
) -> WorkArea:
    """The rows of :func:`decode_work_area`, and a table of what became 0 because it is no number.

    ``row_keys`` are columns that name a row in the rejects. A number is rejected as
    malformed, as too large, or as missing when the line ends before it; a line
    with fields beyond the catalogue's is rejected once, as having too many. The text is split and
    parsed once; both tables read the decoded rows.
    """
    listed = [CatalogueField(name.rstrip(), kind) for name, kind in catalogue]
    parts = _parts(text_col, delimiter)
    numbers = [(i, f.name) for i, f in enumerate(listed) if f.type in NUMERIC_TYPES]
    faults = [
        F.struct(F.lit(name).alias("FIELD"), F.get(parts, F.lit(i)).alias("TEXT"), number_fault(F.get(parts, F.lit(i))).alias("REASON"))
        for i, name in numbers
    ]
    beyond = F.slice(parts, len(listed) + 1, F.greatest(F.size(parts) - len(listed), F.lit(0)))
    surplus = F.when(F.size(parts) > len(listed), F.lit(TOO_MANY))
    faults.append(F.struct(F.lit(None).cast("string").alias("FIELD"), F.array_join(beyond, delimiter).alias("TEXT"), surplus.alias("REASON")))
    carried = [F.col(f"`{c}`") for c in rows.columns if c != text_col]
    found = F.filter(F.array(*faults), lambda f: f["REASON"].isNotNull())
    decoded = settle(rows.select(*carried, *[_typed(F.get(parts, F.lit(i)), f.type).alias(f.name) for i, f in enumerate(listed)], found.alias(_FAULTS)))
    rejects = decoded.select(*row_keys, F.explode(_FAULTS).alias("f")).select(*row_keys, "f.*")
    return WorkArea(decoded.drop(_FAULTS), rejects)


def decode_work_area(
    rows: DataFrame,
    catalogue: Iterable[tuple[str, str]],
    fields: Sequence[str] | None = None,
    condition: Column | None = None,
    order_by: Sequence[str] = (),
    nrows: int = -1,
    skip: int = 0,
    text_col: str = "WA",
    delimiter: str = ";",
) -> DataFrame:
    """Split ``text_col`` into the catalogue's fields and give each its type.

    The catalogue lists the fields in the order they stand in the text. Numbers
    that do not parse become 0, text loses its trailing blanks, and the raw column
    is dropped. ``nrows`` and ``skip`` need ``order_by`` columns that identify a row.
    """
    listed = [CatalogueField(name.rstrip(), kind) for name, kind in catalogue]
    parts = _parts(text_col, delimiter)
    carried = [F.col(f"`{c}`") for c in rows.columns if c != text_col]
    decoded = rows.select(
        *carried, *[_typed(F.get(parts, F.lit(i)), f.type).alias(f.name) for i, f in enumerate(listed)]
    )
    if condition is not None:
        decoded = decoded.where(condition)
    decoded = row_window(decoded, order_by, nrows, skip)
    return decoded if fields is None else decoded.select(*fields)
