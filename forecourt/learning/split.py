"""Training rows and their repeatable split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt import schema
from forecourt.functions.hashing import hash_fold, hash_fraction

FOLD = "fold"


class TooFewRows(Exception):
    """There are not enough rows to train on."""


def training_rows(gold: DataFrame, source: str | None = "all") -> DataFrame:
    """Feature rows with all numbers present, optionally of one source only."""
    rows = gold.na.drop(subset=[*fixed.NUMERIC_COLUMNS, fixed.TARGET_COLUMN])
    wanted = (source or "all").lower()
    return rows if wanted == "all" else rows.filter(F.col("origen") == wanted)


def require_min_rows(rows: DataFrame, minimum: int) -> int:
    """Number of rows; raises TooFewRows below the minimum."""
    total = rows.count()
    if total < minimum:
        raise TooFewRows(f"{total} rows to train on, at least {minimum} are needed")
    return total


def mark_test(
    rows: DataFrame, test_size: float = 0.2, seed: int = 42, key: str = schema.KEY
) -> DataFrame:
    """Add `is_test`, decided by the row's key alone."""
    return rows.withColumn("is_test", hash_fraction(F.col(key), seed) < F.lit(test_size))


def split(
    rows: DataFrame, test_size: float = 0.2, seed: int = 42, key: str = schema.KEY
) -> tuple[DataFrame, DataFrame]:
    """(training rows, held-out rows)."""
    marked = mark_test(rows, test_size, seed, key)
    return (
        marked.filter(~F.col("is_test")).drop("is_test"),
        marked.filter("is_test").drop("is_test"),
    )


def with_fold(
    rows: DataFrame, folds: int = 3, seed: int = 42, key: str = schema.KEY
) -> DataFrame:
    return rows.withColumn(FOLD, hash_fold(F.col(key), seed, folds))
