"""Layout-independent pseudo-random numbers from a key.

`rand()` and `randomSplit` depend on how rows are spread over partitions; an
md5 of the key does not, so a row always lands on the same side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digest_number(key: Column, salt: str, first_digit: int) -> Column:
    digest = F.md5(F.concat(F.lit(f"{salt}|"), F.coalesce(key, F.lit(""))))
    return F.conv(F.substring(digest, first_digit, 8), 16, 10).cast("bigint")


def hash_fraction(key: Column, seed: int) -> Column:
    """Uniform number in [0, 1) with 32 bits."""
    return _digest_number(key, str(seed), 1) / F.lit(float(1 << 32))


def hash_fold(key: Column, seed: int, folds: int) -> Column:
    """Fold number 0 .. folds-1, independent of `hash_fraction`."""
    return (_digest_number(key, str(seed), 9) % folds).cast("int")


def hash_order(key: Column, seed: int) -> Column:
    """Sort key of a repeatable random sample."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(key, F.lit(""))))
