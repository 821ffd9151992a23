"""Row windows over an ordered frame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import takewhile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.lineage import settle

_PLACE, _RANGE = "__place", "__range"
#: Windows that end within so many rows are kept by each task while it reads.
TOP_ROWS = 100_000
#: Rows sampled for the bounds of ranges, and ranges made of them.
SAMPLED, RANGES = 2048, 32


def row_window(df: DataFrame, order_by: Sequence[str], nrows: int = -1, skip: int = 0) -> DataFrame:
    """Skip rows, then keep ``nrows`` of them; -1 keeps all the rest.

    Rows that tie on ``order_by`` follow their other columns, so the window is the same
    in every run, and rows equal in every column are told apart by number only.

    A window that ends early is a top-n: each task keeps its first rows, and nothing is
    sorted or stored whole. Otherwise bounds of about equal ranges are taken from a bounded
    sample and the rows of each range are counted; ranges before and after the window drop
    out, ranges inside it pass as they are, and only the range at an edge (where
    rows may all be equal) is cut by position.
    """
    skip = max(skip, 0)
    if nrows < 0 and skip == 0:
        return df
    if not order_by:
        raise ValueError("a row window needs columns that order the rows")
    sortable = {f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))}
    order = [*order_by, *[c for c in df.columns if c in sortable and c not in order_by]]
    columns = [F.col(f"`{c}`") for c in order]
    if 0 <= nrows <= TOP_ROWS - skip:
        return df.orderBy(*columns).offset(skip).limit(nrows)
    ranged, sizes = _ranged(df, columns)
    end = None if nrows < 0 else skip + nrows
    parts, begin = [], 0
    for number, size in sizes:
        first, last = max(skip - begin, 0), size if end is None else min(end - begin, size)
        rows = ranged.where(F.col(_RANGE) == number).drop(_RANGE)
        if first < last:
            parts.append((number, None if (first, last) == (0, size) else _cut(rows, columns, first, last)))
        begin += size
    whole = ranged.where(F.col(_RANGE).isin([n for n, cut in parts if cut is None])).drop(_RANGE)
    cuts = [cut for _, cut in parts if cut is not None]
    return reduce(DataFrame.unionByName, cuts, whole).orderBy(*columns)


def _ranged(df: DataFrame, columns: list[Column]) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Rows with the number of their range, and the ranges' sizes in order."""
    # Nested values are left to the sort within a range.
    plain = list(takewhile(lambda f: not isinstance(f.dataType, (T.ArrayType, T.StructType)), df.select(*columns).schema.fields))
    leading, number = columns[: len(plain)], F.lit(0)
    if leading:
        # The rows of the least hashes: a sample that is bounded, and the same in every run.
        sampled = df.select(*leading).orderBy(F.xxhash64(*leading)).limit(SAMPLED)
        picked = sampled.orderBy(*leading).collect()
        bounds = [picked[len(picked) * i // RANGES] for i in range(1, RANGES)] if picked else []
        for bound in dict.fromkeys(bounds):
            at = F.struct(*[F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(bound, plain, strict=True)])
            number = number + (F.struct(*leading) >= at).cast("int")
    ranged = df.withColumn(_RANGE, number)
    return ranged, sorted((r[0], r[1]) for r in ranged.groupBy(_RANGE).count().collect())


def _cut(rows: DataFrame, columns: list[Column], first: int, last: int) -> DataFrame:
    """Positions ``first`` to ``last`` (left out) of the rows of one range.

    The rows are sorted by ranges of their own and settled, and counted in each; so no
    task holds more than one of these. Rows that are equal in every column stay together.
    """
    placed = settle(
        rows.repartitionByRange(*columns).sortWithinPartitions(*columns)
        .withColumn(_RANGE, F.spark_partition_id()).withColumn(_PLACE, F.monotonically_increasing_id())
    )
    sizes = placed.groupBy(_RANGE).agg(F.min(_PLACE).alias("least"), F.count(F.lit(1)).alias("n")).collect()
    window, begin = F.lit(False), 0
    for number, least, size in sorted(map(tuple, sizes)):
        a, b = max(first - begin, 0), min(last - begin, size)
        if a < b:
            window |= (F.col(_RANGE) == number) & F.col(_PLACE).between(least + a, least + b - 1)
        begin += size
    return placed.where(window).drop(_RANGE, _PLACE)
