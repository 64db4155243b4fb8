"""Shared folders for intermediate tables."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_WAREHOUSE = "spark.sql.warehouse.dir"
_named: list[str] = []


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below `spark.checkpoint.dir`, else below the warehouse.

    Both are seen by all machines of a cluster.  `clear` removes the folders.
    """
    shared = spark.conf.get(_SETTING, None) or f"{spark.conf.get(_WAREHOUSE)}/scratch"
    folder = f"{shared.rstrip('/')}/forecourt-{purpose}-{uuid.uuid4().hex}"
    _named.append(folder)
    return folder


def release(spark: SparkSession, folder: str) -> None:
    """Delete one folder, or a folder in it, that no frame reads any more."""
    if folder in _named:
        _named.remove(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished writes.

    It does so once the driver's heap is collected, which may not happen during a run.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def clear(spark: SparkSession) -> None:
    """Delete the folders named so far; frames that still read them end with it."""
    while _named:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_named.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
