"""Intermediate tables in the folders a cluster shares, and small helpers on frames.

Whatever cuts lineage here is a written table: a lost executor costs the tasks
it ran, never the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_MADE: dict[str, list[tuple[str, str]]] = {}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below `spark.checkpoint.dir`, or below the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(("folder", path))
    return path


def address(spark: SparkSession, folder: str) -> str:
    """The folder's whole address on the file system where Spark itself puts it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    whole = path.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()
    return f"file://{whole.removeprefix('file:')}" if whole.startswith("file:/") and "://" not in whole else whole


def stage(df: DataFrame, purpose: str, codec: str = "zstd") -> DataFrame:
    """The rows of df, written once and read again."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_by(df: DataFrame, key: str, purpose: str, codec: str = "zstd") -> DataFrame:
    """As stage, bucketed by key: a join on the key need not move these rows again."""
    spark = df.sparkSession
    name = f"{purpose}_{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(("table", name))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("compression", codec).bucketBy(buckets, key).saveAsTable(name)
    return spark.table(name)


def stage_alone(spark: SparkSession, make: Callable[[], DataFrame], purpose: str) -> DataFrame:
    """The rows of make(), staged; what make staged on its way is deleted, as nothing else reads it."""
    made = _MADE.setdefault(spark.sparkContext.applicationId, [])
    earlier = len(made)
    out = stage(make(), purpose)
    passing = made[earlier:-1]
    del made[earlier:-1]
    _drop(spark, passing)
    return out


def release(spark: SparkSession) -> None:
    """Delete every intermediate table of this session; results still reading them end with it."""
    _drop(spark, _MADE.pop(spark.sparkContext.applicationId, []))


def _drop(spark: SparkSession, made: list[tuple[str, str]]) -> None:
    jvm = spark.sparkContext._jvm
    for kind, name in made:
        if kind == "table":
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        else:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """df without the columns that would clash with names (upper and lower case alike)."""
    clash = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in clash])


def quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def running_total(df: DataFrame, order: list[Column], value: str, out: str, inclusive: bool = False) -> DataFrame:
    """Adds `out`: the sum of `value` over all rows before (and, inclusive, with) this one in order.

    Rows are range-partitioned and written; only one sum per partition goes
    through a single task, so no partition sees another's rows.  Ties keep the
    order in which they were written.
    """
    slice_, row = "__slice", "__row"
    placed = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn(slice_, F.spark_partition_id())
        .withColumn(row, F.monotonically_increasing_id()),
        "ordered",
    )
    sums = placed.groupBy(slice_).agg(F.sum(value).alias("__sum"))
    before = Window.orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(slice_, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"))
    upto = Window.partitionBy(slice_).orderBy(row).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    return (
        placed.join(offsets, slice_)
        .withColumn(out, F.col("__base") + F.coalesce(F.sum(value).over(upto), F.lit(0)))
        .drop(slice_, row, "__base")
    )
