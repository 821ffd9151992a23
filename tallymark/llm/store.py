"""Where intermediate results are kept, and joins back to a table by its id."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def settle(frame: DataFrame) -> DataFrame:
    """Write a frame to the shared checkpoint folder and go on from there.

    The folder is the one that ``spark.checkpoint.dir`` names. Only a local session
    that names none (tests) gets a temporary folder of its own.
    """
    spark: SparkSession = frame.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return frame.checkpoint(eager=True)


def numbered(docs: DataFrame) -> DataFrame:
    """The same rows under the names c0, c1, ..., so that no helper column can clash."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Two columns, ``__id`` and ``__text``, whatever else the table holds."""
    return docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text"))


def pieces_of(total: int, size: int) -> int:
    """How many pieces of about ``size`` hold ``total``; at least one."""
    return max(1, -(-int(total or 0) // size))
