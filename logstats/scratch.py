"""Intermediate tables in the folder that the session names.

The folder is ``spark.checkpoint.dir``; where that is unset, as in tests, one inside
``spark.sql.warehouse.dir``. Both are shared by the driver and all executors, and the
choice does not depend on the size of the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session, set if it has none yet."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a path through the file system it lies in."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A fresh path that is deleted at the end."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        remove_path(spark, path)


def checkpointed(rows: DataFrame) -> DataFrame:
    """The rows with their lineage cut by a reliable checkpoint.

    Set ``spark.cleaner.referenceTracking.cleanCheckpoints`` to have it removed once
    nothing refers to it.
    """
    checkpoint_folder(rows.sparkSession)
    return rows.checkpoint()
