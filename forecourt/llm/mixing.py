"""Mixing sources to target weights by entropy balancing.

Every document starts with one copy's worth of weight.  The mix is the set of
rates closest to that in entropy under which each source gives its target of
tokens and no document exceeds `most` copies.  Its dual is convex with one
multiplier a source, and the rates are tilted exponentially by size:

    rate = min(most, exp(multiplier * size / mean size of the source))

Newton's method solves the dual.  Rates depend on source and size alone, so the
iterations run over the counted sizes of each source, not over documents: one
step is one aggregation of that table, the multipliers stay a table too.  Each source
keeps the multipliers known to give too little and too much; a step that leaves them,
starts where every document is at its limit (slope 0) or did not halve the residual
is replaced by their middle.  Running out of steps is an error.

Rates become copies without drift.  For each source the counted sizes are taken
from the largest to the smallest; each gives the nearest number of whole copies
to its share plus what the larger ones still owe, so the source ends within
about its smallest document of the target.  Copies of one size are dealt to its
documents by a hash of their number, in slices, so that no size of a hot source
is ranked in one task.

Targets: sources in code point order (null last) have the repeating weights and
share all tokens; a target stops at `most` times its source's tokens and the
excess is shared again by weight.

Defined cases: null and empty texts have size 0, take nothing and get one copy
(they cost no tokens); a source of no tokens has target 0; an empty table gives
an empty mix; repeated rows are documents of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from forecourt.llm import staging

WEIGHTS = (5, 2, 1)
MOST = 3
STEPS = 60
CLOSE = 1e-6
#: Documents of one source and size that are ranked together, about; the root of their number where that is more.
SLICE = 500


def sizes(text: str) -> Column:
    """Words of a text: runs of anything but ASCII white space."""
    column = staging.quoted(text).cast("string")
    return F.coalesce(F.regexp_count(column, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(by_source: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """by_source (source, total) with its target."""
    ranked = staging.running_total(
        by_source.withColumn("one", F.lit(1)).withColumn("last", F.col("source").isNull()),
        [F.col("last"), F.col("source")], "one", "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    held = staging.stage(
        ranked.select("source", "total", weight.alias("weight"), (F.col("total") * F.lit(float(most))).alias("limit")),
        "weights")
    total = held.agg(F.sum("total")).first()[0] or 0
    # A source at its limit stays there, since what it leaves is shared by the others.
    full = F.lit(False)
    level, known = 0.0, -1
    while True:
        row = held.agg(
            F.sum(F.when(full, F.lit(0.0)).otherwise(F.col("weight"))),
            F.sum(F.when(full, F.col("limit")).otherwise(0.0)), F.sum(full.cast("int"))).first()
        if row[2] is None or row[2] == known or not row[0]:
            break
        known, level = row[2], (total - row[1]) / row[0]
        full = F.col("weight") * level >= F.col("limit")
    return held.select(
        "source", "total", F.when(full, F.col("limit")).otherwise(F.col("weight") * level).alias("target"))


def multipliers(cells: DataFrame, wanted: DataFrame, most: float = MOST, steps: int = STEPS) -> DataFrame:
    """(source, total, target, mean, multiplier) from the counted sizes (source, size, count).

    One Newton step for all sources is one aggregation; a source that is within
    CLOSE of its target keeps its multiplier.
    """
    means = cells.groupBy("source").agg(
        F.greatest(F.sum(F.col("size") * F.col("count")) / F.sum("count"), F.lit(1e-9)).alias("mean"))
    nowhere = F.lit(None).cast("double")
    state = wanted.withColumnRenamed("source", "s").join(
        means, F.col("s").eqNullSafe(F.col("source"))).select(
        "source", "total", "target", "mean", nowhere.alias("low"), nowhere.alias("high"), F.lit(0.0).alias("multiplier"),
        F.lit(float("inf")).alias("residual"), (F.col("target") >= most * F.col("total")).alias("done"))
    state = staging.stage(state, "multipliers")
    for _ in range(steps):
        joined = cells.withColumnRenamed("source", "s").join(state, F.col("s").eqNullSafe(F.col("source")))
        rate = F.least(F.lit(float(most)), F.exp(F.least(F.col("multiplier") * F.col("size") / F.col("mean"), F.lit(50.0))))
        free = rate < most
        one = joined.groupBy("source", "total", "target", "mean", "low", "high", "multiplier", "residual", "done").agg(
            F.sum(rate * F.col("size") * F.col("count")).alias("given"),
            F.sum(F.when(free, rate * F.col("size") * F.col("size") / F.col("mean") * F.col("count")).otherwise(0.0))
            .alias("slope"))
        off = F.abs(F.col("given") - F.col("target"))
        short = F.col("given") < F.col("target")
        one = one.select(
            "source", "total", "target", "mean", "multiplier", "residual", off.alias("off"),
            F.when(short, F.col("multiplier")).otherwise(F.col("low")).alias("low"),
            F.when(short, F.col("high")).otherwise(F.col("multiplier")).alias("high"),
            F.when(F.col("slope") > 0, F.col("multiplier") - (F.col("given") - F.col("target")) / F.col("slope")).alias("newton"),
            (F.col("done") | (off <= CLOSE * F.greatest(F.col("target"), F.lit(1.0)))).alias("done"))
        # Without one of the two (null), all steps of Newton's are inside and none is too slow.
        inside = F.coalesce(F.col("newton") > F.col("low"), F.lit(True)) & F.coalesce(F.col("newton") < F.col("high"), F.lit(True))
        middle = (F.col("low") + F.col("high")) / 2
        slow = F.col("newton").isNull() | ~inside | (F.col("off") > F.col("residual") / 2)
        state = staging.stage(one.select(
            "source", "total", "target", "mean", "low", "high",
            F.when(F.col("done"), F.col("multiplier")).when(slow & middle.isNotNull(), middle).otherwise(F.col("newton"))
            .alias("multiplier"),
            F.col("off").alias("residual"), "done"), "multipliers")
        if state.filter(~F.col("done")).isEmpty():
            return state
    left = state.filter(~F.col("done")).agg(F.count("*")).first()[0]
    if left:
        raise RuntimeError(f"{left} sources are not at their targets after {steps} steps")
    return state


def _deal(cells: pd.DataFrame, most: int) -> pd.DataFrame:
    """Whole copies for the counted sizes of one source, largest first; what is owed is carried on."""
    cells = cells.sort_values("size", ascending=False, kind="stable")
    owed, copies = 0.0, []
    for size, count, rate in zip(cells["size"], cells["count"], cells["rate"], strict=True):
        share = owed + rate * size * count
        n = int(min(max(np.floor(share / size + 0.5), 0), most * count)) if size else int(count)
        owed = share - n * size
        copies.append(n)
    return cells.assign(copies=copies)[["source", "size", "count", "copies"]]


def _named(key: str, text: str, source: str) -> list[Column]:
    return [
        staging.quoted(key).cast("long").alias("id"), F.xxhash64(staging.quoted(text)).alias("h"),
        staging.quoted(source).cast("string").alias("source")]


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, most: int = MOST,
) -> DataFrame:
    """Per row of docs: id, h (hash of the text), size, source, source_size, target, copies, taken."""
    rows = staging.stage(docs.select(*_named(key, text, source), sizes(text).alias("size")), "sizes")
    cells = staging.stage(rows.groupBy("source", "size").agg(F.count("*").alias("count")), "cells")
    totals = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("count")).alias("total"))
    state = multipliers(cells, targets(totals, weights, most), most).withColumnRenamed("source", "s")
    rate = F.when(F.col("target") >= most * F.col("total"), F.lit(float(most))).otherwise(
        F.least(F.lit(float(most)), F.exp(F.least(F.col("multiplier") * F.col("size") / F.col("mean"), F.lit(50.0)))))
    priced = cells.join(state, F.col("s").eqNullSafe(F.col("source"))).select(
        "source", "size", "count", rate.alias("rate"))

    def deal(group: pd.DataFrame) -> pd.DataFrame:
        return _deal(group, most)

    # One source's counted sizes: at most as many as its longest document has words.
    dealt = priced.groupBy("source").applyInPandas(deal, "source STRING, size BIGINT, count BIGINT, copies BIGINT")
    dealt = staging.stage(dealt, "dealt")
    per_cell = dealt.select(
        F.col("source").alias("c_source"), F.col("size").alias("c_size"), F.expr("copies div count").alias("each"),
        (F.col("copies") % F.col("count")).alias("extra"),
        F.ceil(F.col("count") / F.greatest(F.lit(SLICE), F.sqrt("count"))).cast("long").alias("slices"))
    chance = F.xxhash64("id", "h")
    sliced = rows.join(per_cell, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("size") == F.col("c_size"))) \
        .withColumn("slice", F.pmod(chance, F.col("slices"))).withColumn("chance", F.xxhash64(F.lit(1), "id", "h"))
    members = sliced.groupBy("source", "size", "slice").agg(F.count("*").alias("members"))
    before = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    members = members.withColumn("before", F.coalesce(F.sum("members").over(before), F.lit(0))).select(
        F.col("source").alias("m_source"), F.col("size").alias("m_size"), F.col("slice").alias("m_slice"), "before")
    within = Window.partitionBy("source", "size", "slice").orderBy("chance", "id", "h")
    ranked = sliced.withColumn("rank", F.row_number().over(within)).join(
        members, F.col("source").eqNullSafe(F.col("m_source")) & (F.col("size") == F.col("m_size"))
        & (F.col("slice") == F.col("m_slice")))
    copies = F.col("each") + (F.col("before") + F.col("rank") <= F.col("extra")).cast("long")
    known = state.select("s", F.col("total").alias("source_size"), "target")
    return ranked.withColumn("copies", copies).join(known, F.col("source").eqNullSafe(F.col("s"))).select(
        "id", "h", "size", "source", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with all their columns.

    Ranks and copies are settled on keys alone; the rows themselves join the numbers of copies
    once.  Rows of one key, text and source share their copies evenly.
    """
    same = ["id", "h", "source"]
    planned = staging.stage_alone(
        docs.sparkSession, lambda: mix(docs, key, text, source, **options).groupBy(*same)
        .agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
        .select(*[F.col(c).alias(f"p_{c}") for c in same], "copies", "rows"), "copies")
    whole = F.struct(*[staging.quoted(c) for c in docs.columns]).alias("row")
    joined = docs.select(*_named(key, text, source), whole).join(
        planned, [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in same]).drop(*[f"p_{c}" for c in same])

    def repeated(rows: DataFrame, copies: Column) -> DataFrame:
        return rows.select(
            "row", F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias("copy")).select("row.*")

    out = repeated(joined.filter("rows = 1"), F.col("copies"))
    if planned.filter("rows > 1").isEmpty():
        return out
    placed = staging.stage(staging.running_total(
        joined.filter("rows > 1").withColumn("one", F.lit(1)), [F.col(c) for c in same], "one", "place"), "placed")
    first = placed.groupBy(*same).agg(F.min("place").alias("first")).select(
        *[F.col(c).alias(f"p_{c}") for c in same], "first")
    several = placed.join(first, [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in same])
    extra = (F.col("place") - F.col("first") < F.col("copies") % F.col("rows")).cast("long")
    return out.unionByName(repeated(several, F.expr("copies div rows") + extra))


def query(spark, sf_dir: str) -> DataFrame:
    """Every document of the table with the words the mix takes of it."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
