"""Reading stored tables by catalog name or path."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def is_path(target: str) -> bool:
    return "/" in target


def read_table(
    spark: SparkSession,
    target: str,
    schema: T.StructType | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    if not is_path(target):
        return spark.table(target)
    reader = spark.read.format(file_format)
    if schema is not None and file_format != "delta":
        reader = reader.schema(schema)
    return reader.load(target)


def spread(scan: DataFrame) -> DataFrame:
    """A scan of fewer splits than cores, dealt to all cores.

    Costly work on a few files (a small table, one row group a file) would keep the other
    cores idle; a table of many splits stays as it is.  Only for plain scans: counting the
    splits of anything else would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def at(spark: SparkSession, folder: str) -> tuple:
    """(file system, path) of a folder or file."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, target: str) -> bool:
    if not is_path(target):
        return spark.catalog.tableExists(target)
    system, path = at(spark, target)
    return system.exists(path)


def forget_empty(spark: SparkSession, folder: str) -> None:
    """Take away a folder that holds nothing but the marker of a finished write.

    Nothing is deleted recursively: where another writer has put its files meanwhile, they stay.
    """
    system, path = at(spark, folder)
    if not system.exists(path) or [s.getPath().getName() for s in system.listStatus(path)] != ["_SUCCESS"]:
        return
    system.delete(at(spark, f"{folder.rstrip('/')}/_SUCCESS")[1], False)
    try:
        system.delete(path, False)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() not in ("IOException", "PathIsNotEmptyDirectoryException"):
            raise


_MARK = "_replacing"


def mark(spark: SparkSession, target: str) -> None:
    """Note on a table that parts of it are being replaced."""
    if is_path(target):
        system, path = at(spark, f"{target.rstrip('/')}/{_MARK}")
        system.create(path, True).close()
    else:
        spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ('{_MARK}' = 'true')")


def unmark(spark: SparkSession, target: str) -> None:
    if is_path(target):
        system, path = at(spark, f"{target.rstrip('/')}/{_MARK}")
        system.delete(path, False)
    else:
        spark.sql(f"ALTER TABLE {target} UNSET TBLPROPERTIES IF EXISTS ('{_MARK}')")


def marked(spark: SparkSession, target: str) -> bool:
    if is_path(target):
        return exists(spark, f"{target.rstrip('/')}/{_MARK}")
    return any(r.key == _MARK for r in spark.sql(f"SHOW TBLPROPERTIES {target}").collect())


def optional_table(
    spark: SparkSession,
    target: str,
    schema: T.StructType | None = None,
    file_format: str = "parquet",
) -> DataFrame | None:
    """The table, or None when it does not exist; any other failure surfaces."""
    if not is_path(target):
        return spark.table(target) if spark.catalog.tableExists(target) else None
    try:
        return read_table(spark, target, schema, file_format)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
