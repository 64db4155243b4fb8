"""Exact interpolated percentiles without bringing all values to one task.

`percentile` merges every distinct value into one task.  Here the values are
counted first (a normal aggregate), then cut into slices of about equal depth
at approximate quantiles; slice totals give each slice its starting rank, and
only the few slices that hold a wanted rank are sorted.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.sources import sinks, tables
from forecourt.sources.scratch import scratch_folder

#: Distinct values a slice holds, about.
SLICE_VALUES = 100_000


def counted_values(df: DataFrame, column: str) -> DataFrame:
    """(v, n): how often each value occurs; NULL is left out.  Written, since it is read several times."""
    counted = (
        df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL")
        .groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    )
    folder = scratch_folder(df.sparkSession, "values")
    sinks.overwrite(counted, folder)
    return tables.read_table(df.sparkSession, folder)


def _cuts_below(cuts: Column, value: Column, slices: int) -> Column:
    """How many of the ascending cuts are below the value, by halving steps."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(slices.bit_length()))])
    return F.aggregate(
        steps, F.lit(0),
        lambda found, step: F.when(
            F.try_element_at(cuts, found + step) < value, found + step
        ).otherwise(found),
    )


def exact_percentiles(df: DataFrame, column: str, points: Mapping[str, float]) -> DataFrame:
    """One row with the linearly interpolated percentile of each point."""
    return percentiles_of(counted_values(df, column), points)


def percentiles_of(counted: DataFrame, points: Mapping[str, float], discrete: bool = False) -> DataFrame:
    """The same from counted values.  Slices keep their size however many values there are.

    discrete: the first value with at least that share of all values up to it, in place of
    an interpolated one.
    """
    slices = counted.count() // SLICE_VALUES + 2
    # A sketch over the distinct values.  Any cuts give the exact result; good
    # ones only keep the slices even.
    cuts = counted.agg(
        F.array_distinct(
            F.percentile_approx("v", [i / slices for i in range(1, slices)], 10 * slices)
        )
    ).scalar()
    sliced = counted.select("v", "n", cuts.alias("cuts")).select(
        "v", "n", _cuts_below(F.col("cuts"), F.col("v"), slices).alias("slice")
    )

    # One row a slice, so a window without partitions is small.
    by_slice = Window.orderBy("slice")
    before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_slice.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = sliced.groupBy("slice").agg(F.sum("n").alias("depth")).select(
        "slice", "depth",
        F.coalesce(F.sum("depth").over(before), F.lit(0)).alias("start"),
        F.sum("depth").over(everything).alias("total"),
    )
    places = {
        name: F.greatest(F.ceil(F.lit(float(p)) * F.col("total")) - 1, F.lit(0)).cast("double") if discrete
        else F.lit(float(p)) * (F.col("total") - 1)
        for name, p in points.items()
    }
    ranks = [edge(place) for place in places.values() for edge in (F.floor, F.ceil)]
    wanted = totals.filter(
        F.exists(
            F.array(*ranks),
            lambda rank: (rank >= F.col("start")) & (rank < F.col("start") + F.col("depth")),
        )
    )
    inside = Window.partitionBy("slice").orderBy("v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ranked = sliced.join(wanted, "slice").withColumn(
        "upto", F.col("start") + F.sum("n").over(inside)
    )

    def value_at(rank: Column) -> Column:
        holds = (F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto"))
        return F.max(F.when(holds, F.col("v")))

    results = []
    for name, place in places.items():
        low, high = value_at(F.floor(place)), value_at(F.ceil(place))
        results.append((low + (high - low) * F.max(place - F.floor(place))).alias(name))
    return ranked.agg(*results)
