"""Alignment of ledgers by key.

No join here carries a broadcast hint. Spark broadcasts a side on its own when its
size, from file statistics or measured at run time, is under the session's
threshold, and otherwise sort-merges and splits a partition that a hot key fills.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def full_outer_align(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    right_keys: Mapping[str, str] | None = None,
) -> DataFrame:
    """Full outer equi-join with one merged key, whatever the right side calls it.

    ``right_keys`` maps the right side's key names to those in ``on``.
    """
    if right_keys:
        right = right.withColumnsRenamed(dict(right_keys))
    return left.join(right, list(on), "full_outer")


def codes_in(df: DataFrame, codes: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs among ``codes``."""
    return df.join(codes.select(*on), list(on), "left_semi")


def codes_not_in(df: DataFrame, codes: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys of ``df`` that do not occur among ``codes``."""
    return df.select(*on).join(codes.select(*on), list(on), "left_anti").distinct()


def align_all(sides: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """All sides by key in one exchange, as a chain of full outer joins would align them.

    ``IN_0``, ``IN_1``, ... say which sides a row comes from. The sides are stacked, each
    row under its side's number, and grouped once; what a side repeats of a key
    is put into as many rows, times the repeats of the other sides. A group is held in memory, so
    this is for sides with a row, or a few, per key. Apart from keys the sides' columns have
    different names. As in a join, a row with a null in its key meets no other.
    """
    keys = [F.col(f"`{k}`") for k in on]
    figures = [[c for c in side.columns if c not in on] for side in sides]
    kinds = [T.StructType([side.schema[c] for c in columns]) for side, columns in zip(sides, figures, strict=True)]
    lone = reduce(lambda a, b: a | b, [k.isNull() for k in keys])

    def stacked(number: int, side: DataFrame) -> DataFrame:
        held = [
            (F.struct(*[F.col(f"`{c}`") for c in columns]) if at == number else F.lit(None).cast(kind)).alias(f"S{at}")
            for at, (columns, kind) in enumerate(zip(figures, kinds, strict=True))
        ]
        # A number of its own keeps a row without a whole key apart.
        own = F.when(lone, F.monotonically_increasing_id() * len(sides) + number)
        return side.select(*keys, own.alias("OWN"), *held)

    wide = reduce(DataFrame.unionByName, [stacked(n, side) for n, side in enumerate(sides)])
    grouped = wide.groupBy(*keys, "OWN").agg(*[F.collect_list(f"S{n}").alias(f"S{n}") for n in range(len(sides))])
    for n in range(len(sides)):
        grouped = grouped.withColumn(f"S{n}", F.explode_outer(f"S{n}"))
    present = [F.col(f"S{n}").isNotNull().alias(f"IN_{n}") for n in range(len(sides))]
    return grouped.select(*keys, *[F.col(f"S{n}.`{c}`") for n, columns in enumerate(figures) for c in columns], *present)
