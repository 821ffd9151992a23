"""Control totals and the choice of the snapshot that comes nearest to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.measures import MEASURE, total
from tallymark.functions.text import period_key
from tallymark.operators.conform import MATERIAL_GROUPS
from tallymark.operators.keys import PERIOD, PERIOD_KEYS, YEAR


def period_volumes(extract: DataFrame) -> DataFrame:
    """Volume per posting period found in each period's extract, stray ones marked.

    A line is stray when its posting period is not the period of the extract it is in.
    """
    return (
        extract.where(F.col("RSMASG").isin(*MATERIAL_GROUPS))
        .withColumnsRenamed({"year": YEAR, "period": PERIOD})
        .groupBy(*PERIOD_KEYS, "RSPERD")
        .agg(total("RSQTY").alias("RSQTY"))
        .withColumn("STRAY", F.col("RSPERD") != period_key(YEAR, PERIOD))
    )


def control_totals(conformed_extract: DataFrame, volumes: DataFrame) -> DataFrame:
    """Total volume per period, less its stray volume when it holds several periods."""
    totals = conformed_extract.groupBy(*PERIOD_KEYS).agg(
        F.sum("VOLUMEPHYSICAL").cast(MEASURE).alias("TOTALVOLUME")
    )
    strays = volumes.groupBy(*PERIOD_KEYS).agg(
        F.count("RSPERD").alias("PERIODKEYS"),
        F.sum(F.when(F.col("STRAY"), F.col("RSQTY"))).cast(MEASURE).alias("STRAYVOLUME"),
    )
    stray = F.when(F.col("PERIODKEYS") > 1, F.coalesce("STRAYVOLUME", F.lit(0)))
    adjusted = F.col("TOTALVOLUME") - F.coalesce(stray, F.lit(0))
    return totals.join(strays, PERIOD_KEYS, "left").select(
        *PERIOD_KEYS,
        "TOTALVOLUME",
        F.coalesce("PERIODKEYS", F.lit(0)).alias("PERIODKEYS"),
        "STRAYVOLUME",
        adjusted.cast(MEASURE).alias("CONTROLTOTAL"),
    )


def nearest_snapshot_numbers(snapshots: DataFrame, controls: DataFrame) -> DataFrame:
    """Per period, the snapshot whose volume is nearest to the control total."""
    totals = snapshots.groupBy(*PERIOD_KEYS, "Number").agg(total("Volume").alias("SNAPSHOTVOLUME"))
    return nearest_totals(totals, controls)


def nearest_totals(totals: DataFrame, controls: DataFrame) -> DataFrame:
    """The same from one row per snapshot with its total volume.

    Of snapshots equally near the lowest number wins. The choice is an aggregate
    over one row per snapshot, so no period's snapshots gather in one task.
    """
    distance = F.abs(F.col("SNAPSHOTVOLUME") - F.col("CONTROLTOTAL")).cast(MEASURE)
    return (
        totals.join(controls.select(*PERIOD_KEYS, "CONTROLTOTAL"), PERIOD_KEYS)
        .withColumn("DISTANCE", distance)
        .where(F.col("DISTANCE").isNotNull())
        .groupBy(*PERIOD_KEYS)
        .agg(F.min(F.struct("DISTANCE", "Number")).alias("nearest"))
        .select(*PERIOD_KEYS, "nearest.Number", "nearest.DISTANCE")
    )


def nearest_snapshot(snapshots: DataFrame, controls: DataFrame) -> DataFrame:
    """Rows of the nearest snapshot of every period."""
    chosen = nearest_snapshot_numbers(snapshots, controls)
    on = [*PERIOD_KEYS, "Number"]
    return snapshots.join(chosen.select(*on), on, "left_semi")
