"""Size of the stored tables, as counted around a write."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.operators.history import HistoryStore
from tallymark.operators.versions import VERSION_COLUMNS
from tallymark.plans.specs import REPORTS


def audit_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column count of every table, one line each."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("N_ROWS")).select(
            F.lit(name).alias("TABLE_NAME"), "N_ROWS", F.lit(len(df.columns)).alias("N_COLUMNS")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def history_counts(store: HistoryStore) -> DataFrame:
    """Row and column count of the four history tables; the log knows the rows."""
    lines = []
    for spec in REPORTS:
        stored = [f.name for f in spec.stored_schema().fields if f.name not in VERSION_COLUMNS]
        columns = F.lit(len(stored) + len(VERSION_COLUMNS)).alias("N_COLUMNS")
        name = F.lit(spec.name).alias("TABLE_NAME")
        lines.append(store.rows_logged(spec.name).select(name, "N_ROWS", columns))
    return reduce(DataFrame.unionByName, lines)
