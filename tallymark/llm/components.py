"""Connected components of a graph held in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.store import settle


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the least node of its component; nodes with an edge only.

    ``edges`` has columns ``u`` and ``v``. Each step takes the least label among a node's
    neighbours and then the label of that label, so a path of length n takes about log n
    steps. Minima are grouped with a partial step and the joins have one row per node on
    one side, so a node with a third of all edges stays spread.
    """
    both = settle(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = settle(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("label")))
    while True:
        offers = both.join(labels, F.col("u") == F.col("node")).select(F.col("v").alias("node"), "label")
        near = offers.unionByName(labels).groupBy("node").agg(F.min("label").alias("near"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("far"))
        stepped = near.join(jump, F.col("near") == F.col("at"), "left").select("node", F.least("near", F.coalesce("far", "near")).alias("label"))
        before = labels
        labels = settle(stepped)
        moved = labels.join(before.select("node", F.col("label").alias("was")), "node").where(F.col("label") != F.col("was"))
        if moved.limit(1).count() == 0:
            return labels
