"""Clean layer: one typed, normalised, in-range row per listing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt import schema


def union_listings(first: DataFrame, *others: DataFrame | None) -> DataFrame:
    """Union by column name; absent frames are skipped, missing columns are NULL."""
    return reduce(
        lambda done, df: done.unionByName(df, allowMissingColumns=True),
        [df for df in others if df is not None],
        first,
    )


def cast_numbers(df: DataFrame) -> DataFrame:
    """Mileage, year and engine size to INT, price to FLOAT; unreadable -> NULL."""
    return df.withColumns({
        "km": F.col("km").try_cast("int"),
        "anio": F.col("anio").try_cast("int"),
        "precio": F.col("precio").try_cast("float"),
        "cilindrada_cc": F.col("cilindrada_cc").try_cast("int"),
    })


def normalise_names(df: DataFrame) -> DataFrame:
    return df.withColumns({"marca": F.upper(F.trim("marca")), "modelo": F.trim("modelo")})


def require_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with NULL (or NaN) in a required column."""
    return df.na.drop(subset=columns or schema.REQUIRED)


def latest_per_key(
    df: DataFrame, key: str = schema.KEY, newest: str = schema.DATE
) -> DataFrame:
    """One row per key: the newest, ties broken by every other column.

    Asking for row number 1 lets Spark keep one row per key in each task
    before the shuffle, so a key with a third of all rows sends one row per
    task.  NULL keys count as one key.  Rows are sorted by a hash of the key first: addresses
    begin alike, and a number that differs settles most comparisons at once.
    """
    ties = [F.col(c).asc_nulls_first() for c in df.columns if c not in (key, newest)]
    window = Window.partitionBy("_hash", key).orderBy(F.col(newest).desc_nulls_last(), *ties)
    return (
        df.withColumn("_hash", F.xxhash64(key)).withColumn("_rank", F.row_number().over(window))
        .filter("_rank = 1").drop("_rank", "_hash")
    )


def as_of(year: int | None) -> Column:
    return F.year(F.current_date()) if year is None else F.lit(year)


def within_ranges(df: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """Price, year and mileage within their ranges, bounds included."""
    return df.filter(
        F.col("precio").between(*fixed.PRICE_RANGE)
        & F.col("anio").between(F.lit(fixed.MIN_VALID_YEAR), as_of(as_of_year))
        & (F.col("km") >= 0)
    )


def to_silver(
    bronze: DataFrame, *more: DataFrame | None, as_of_year: int | None = None
) -> DataFrame:
    """Raw tables -> clean table.

    The range filter comes after the choice of the latest row on purpose: a
    listing whose latest copy is out of range is gone, older copies do not
    come back.
    """
    typed = normalise_names(cast_numbers(union_listings(bronze, *more)))
    return within_ranges(latest_per_key(require_columns(typed)), as_of_year)
