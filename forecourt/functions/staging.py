"""Keeping an expensive value computed once.

Column expressions are trees: using a value three times copies it three times,
and a filter on a computed column is copied below the projection that computes
it.  Whole-stage code generation shares copies in many places, but not inside
array functions and not across operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def settle(df: DataFrame, *columns: Column | str) -> DataFrame:
    """A select whose columns later filters use as they are.

    The generator between the two keeps filters from being copied below and
    computing the columns a second time; each row yields exactly one row.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))
