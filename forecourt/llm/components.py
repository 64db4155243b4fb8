"""Connected components of links, by alternating large-star and small-star steps.

Each step groups links by node and points the neighbours at the smallest node;
links shrink to stars in a few rounds.  Every round is written, so a lost
executor repeats one round at most.  The neighbours of a node are never
gathered: a step is a minimum (summed up before the shuffle) and a join, which
the adaptive plan splits where one node has very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import staging


def _least(links: DataFrame) -> DataFrame:
    """For each node: the least of itself and its neighbours."""
    return links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (
        both.join(_least(both), both["a"] == F.col("node")).filter("b > a")
        .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    joined = down.join(_least(down), down["a"] == F.col("node"))
    return (
        joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(joined.select("a", F.col("m").alias("b"))).filter("a != b").distinct()
    )


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the least node it reaches."""
    links = staging.stage(links.filter("a != b").distinct(), "links")
    before = _state(links)
    while before[0]:
        links = staging.stage(_small_star(_large_star(links)), "links")
        now = _state(links)
        if now == before:
            break
        before = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
