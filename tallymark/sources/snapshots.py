"""Stored snapshots of the profitability figures, with their totals beside them.

Totals are made once, when a snapshot is stored. The choice of the nearest snapshot
reads them alone: one row per snapshot instead of one per cost centre; of the rows
only the chosen numbers' partitions are listed and read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.measures import MEASURE, total
from tallymark.lineage import settle
from tallymark.operators.control import nearest_totals
from tallymark.operators.keys import PERIOD, PERIOD_KEYS, YEAR

NUMBER, VOLUME = "Number", "SNAPSHOTVOLUME"
TOTALS = T.StructType(
    [*[T.StructField(c, T.IntegerType()) for c in (*PERIOD_KEYS, NUMBER)], T.StructField(VOLUME, MEASURE)]
)


class SnapshotStore:
    """A folder with ``rows`` (a partition per period and number) and ``totals``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def add(self, snapshots: DataFrame) -> None:
        """Store snapshots and their totals; a number stored before is replaced.

        Rows go first: a run that dies before the totals leaves rows no choice leads to,
        and can be repeated. The totals of a period are one small sorted file.
        """
        rows, keys = settle(snapshots), [*PERIOD_KEYS, NUMBER]
        made = rows.groupBy(*keys).agg(total("Volume").alias(VOLUME))
        touched = made.select(*PERIOD_KEYS).distinct()
        before = self.totals().join(touched, PERIOD_KEYS, "left_semi").join(made, keys, "left_anti")
        totals = settle(before.unionByName(made)).repartition(*PERIOD_KEYS).sortWithinPartitions(*PERIOD_KEYS, VOLUME, NUMBER)
        spread = rows.repartition(*keys)
        for name, frame, by in (("rows", spread, keys), ("totals", totals, PERIOD_KEYS)):
            writer = frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(*by).parquet(f"{self.root}/{name}")

    def totals(self) -> DataFrame:
        """One row per snapshot; none before the first is stored."""
        try:
            stored = self.spark.read.schema(TOTALS).parquet(f"{self.root}/totals")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], TOTALS)
        return stored.select(*PERIOD_KEYS, NUMBER, VOLUME)

    def nearest(self, controls: DataFrame) -> DataFrame:
        """Rows of the snapshot nearest to each period's control total.

        One number per period asked for comes to the driver, and names the partitions.
        """
        chosen = nearest_totals(self.totals(), controls).collect()
        wanted = [
            (F.col(YEAR) == r[YEAR]) & (F.col(PERIOD) == r[PERIOD]) & (F.col(NUMBER) == r[NUMBER])
            for r in chosen
        ]
        rows = self.spark.read.parquet(f"{self.root}/rows")
        return rows.where(reduce(lambda a, b: a | b, wanted, F.lit(False)))
