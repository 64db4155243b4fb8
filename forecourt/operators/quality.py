"""Profiles, audits and guards of a layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions.exact import exact_corr, fixed_point
from forecourt.operators.percentiles import counted_values, percentiles_of

AUDITED = ["marca", "tipo_normalizado", "km_bucket", "anio", "edad_anios", "km", "precio"]


def value_counts(
    df: DataFrame, column: str, top: int | None = None, keep_null: bool = False
) -> DataFrame:
    """Rows per value, most frequent first (ties by value)."""
    if not keep_null:
        df = df.filter(F.col(column).isNotNull())
    counts = (
        df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.col(column).asc_nulls_last())
    )
    return counts if top is None else counts.limit(top)


def counts_by_label(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, ordered by value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(column)


def describe_number(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact interpolated quartiles.

    The values are counted once; everything else comes from the counts.
    """
    counted = counted_values(df, column)
    v, n = F.col("v"), F.col("n")
    whole = counted.agg(F.try_divide(F.sum(fixed_point(v) * n).cast("double"), F.sum(n)).alias("mean"))
    mean = whole.select("mean").scalar()
    spread = counted.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("count"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        F.sum(fixed_point((v - mean) * (v - mean)) * n).cast("double").alias("squares"),
    )
    quartiles = percentiles_of(counted, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    packed = quartiles.select(F.struct("p25", "p50", "p75")).scalar()
    deviation = F.sqrt(F.try_divide(F.col("squares"), F.col("count") - 1))
    return spread.withColumn("_q", packed).select(
        "count", mean.alias("mean"), deviation.alias("std"), "min", "_q.p25", "_q.p50", "_q.p75", "max"
    )


def price_stats(df: DataFrame, column: str = "precio") -> DataFrame:
    """Extremes, mean and quartiles (values of the column), the same in any order of the rows.

    The values are counted once; everything else comes from the counts.
    """
    counted = counted_values(df, column)
    v, n = F.col("v"), F.col("n")
    quartiles = percentiles_of(counted, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, discrete=True)
    packed = quartiles.select(F.struct("p25", "p50", "p75")).scalar()
    return counted.agg(
        F.min("v").alias("min"), F.max("v").alias("max"),
        F.try_divide(F.sum(fixed_point(v) * n).cast("double"), F.sum(n)).alias("media"),
    ).withColumn("_q", packed).select("min", "_q.p25", "_q.p50", "_q.p75", "max", "media")


def null_audit(df: DataFrame, columns: Sequence[str] = AUDITED) -> DataFrame:
    """NULLs per column from one pass, as (column, nulls) rows."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column", "nulls")


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson correlation of each pair, all in one pass and in any order of the rows."""
    return df.agg(*[exact_corr(F.col(a), F.col(b)).alias(f"corr_{a}_{b}") for a, b in pairs])


def preview(df: DataFrame, order_by: Sequence[str], n: int = 20) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*order_by).limit(n)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Stop with an error when there is nothing to work on."""
    if df.isEmpty():
        raise ValueError(message)
    return df
