"""Cutting lineage with reliable checkpoints."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")

_naming = threading.Lock()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the checkpoint folder the cluster names; make one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="tallymark-checkpoint-")
    context.setCheckpointDir(named)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the checkpoint folder, for tables that are written to be read again."""
    with _naming:
        ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/tables-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute a frame once and keep its rows in the shared checkpoint folder.

    For frames that several later plans read: one row per cost centre each, while
    the scan beneath may be the whole extract. The rows are on reliable storage, so
    losing an executor costs a re-read, not a re-scan.
    """
    with _naming:
        ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def settle_all(frames: Sequence[DataFrame]) -> list[DataFrame]:
    """Settle frames that do not depend on each other; their jobs run side by side."""
    if not frames:
        return []
    return side_by_side(frames[0].sparkSession, [partial(settle, frame) for frame in frames])


def side_by_side(spark: SparkSession, actions: Sequence[Callable[[], Result]]) -> list[Result]:
    """Run independent Spark actions at once, under the caller's job settings."""
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        # Each gets its own copy of the settings; Spark keeps per-query state in them.
        started = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
        return [job.result() for job in started]
