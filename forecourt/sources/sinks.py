"""Writing tables and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from forecourt.sources.tables import is_path


def create_schema(spark: SparkSession, table: str) -> None:
    """Create the schema a three-part (or two-part) table name points to."""
    schema, _, _ = table.rpartition(".")
    if schema:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def save(writer: DataFrameWriter, spark: SparkSession, target: str) -> None:
    """To a path, or to a catalog table whose schema is created if it is missing."""
    if is_path(target):
        writer.save(target)
    else:
        create_schema(spark, target)
        writer.saveAsTable(target)


def write_by_date(
    df: DataFrame,
    target: str,
    date_column: str,
    gather: bool = False,
    replace: bool = False,
    file_format: str = "parquet",
) -> int:
    """Append to (or replace the dates of) a table with one folder per date.

    `gather` brings the rows of a date together first.  The rebalance hint
    lets the adaptive planner merge small dates and split a date that holds
    most of the rows.  The row count is observed while writing.
    """
    if gather:
        df = df.hint("rebalance", date_column)
    written = Observation()
    rows = df.observe(written, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.format(file_format)
    if replace:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        if not is_path(target) and df.sparkSession.catalog.tableExists(target):
            # An existing catalog table keeps its own partitioning.
            ordered = rows.select(*df.sparkSession.table(target).columns)
            (ordered.write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").insertInto(target))
            return written.get["rows"]
    else:
        writer = writer.mode("append")
    save(writer.partitionBy(date_column), df.sparkSession, target)
    return written.get["rows"]


def overwrite(df: DataFrame, target: str, file_format: str = "parquet") -> None:
    """Replace a table, schema included."""
    writer = df.write.format(file_format).mode("overwrite")
    if file_format == "delta":
        writer = writer.option("overwriteSchema", "true")
    save(writer, df.sparkSession, target)


def append(df: DataFrame, target: str, file_format: str = "parquet") -> None:
    save(df.write.format(file_format).mode("append"), df.sparkSession, target)


def write_report(df: DataFrame, path: str) -> None:
    """CSV with a header line, written by the executors."""
    df.write.mode("overwrite").option("header", True).csv(path)
