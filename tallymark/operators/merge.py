"""Adding up partial sums."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reaggregate(
    parts: Sequence[DataFrame], keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """One sum per key over frames that each hold partial sums."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
