"""Folders that survive the loss of an executor."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


_SHUFFLES_REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of each query that runs in here when it ends.

    Else they stay until the driver collects garbage, the later the less it holds.
    For frames that are run once.
    """
    before = spark.conf.get(_SHUFFLES_REMOVED, None)
    spark.conf.set(_SHUFFLES_REMOVED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES_REMOVED)
        else:
            spark.conf.set(_SHUFFLES_REMOVED, before)


def shared_folder(spark: SparkSession, *parts: str) -> str:
    """A path below ``spark.checkpoint.dir``, or else below the warehouse.

    All executors share both; a folder of one machine never serves.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if not warehouse:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{warehouse.rstrip('/')}/sortilex-work"
    return "/".join((root.rstrip("/"), *parts))


def run_folder(spark: SparkSession, name: str) -> str:
    """A shared path that no earlier call returned."""
    return shared_folder(spark, f"{name}-{uuid.uuid4().hex}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what it holds, if it is there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
