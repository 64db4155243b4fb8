import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecourt.operators import quality
from forecourt.operators.percentiles import exact_percentiles

POINTS = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}


def both_ways(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE").repartition(5)
    ours = exact_percentiles(df, "x", POINTS).first()
    plain = df.agg(F.percentile("x", list(POINTS.values()))).first()[0]
    return list(ours), plain


@settings(max_examples=4, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50).map(float), min_size=1, max_size=200))
def test_percentiles_equal_the_built_in(spark, values):
    ours, plain = both_ways(spark, values)
    assert ours == pytest.approx(plain, abs=1e-9)


def test_percentiles_of_a_skewed_column(spark):
    draw = random.Random(1)
    values = [7.0] * 4000 + [draw.lognormvariate(0, 6) for _ in range(9000)]
    ours, plain = both_ways(spark, values)
    assert ours == pytest.approx(plain, rel=1e-12)


def test_percentiles_skip_null_and_may_be_empty(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x DOUBLE")
    assert exact_percentiles(df, "x", {"p50": 0.5}).first()[0] == 2.0
    assert exact_percentiles(df.filter("x > 9"), "x", {"p50": 0.5}).first()[0] is None


def test_describe(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "x DOUBLE")
    row = quality.describe_number(df, "x").first()
    assert (row["count"], row["mean"], row["min"], row["p25"], row["p50"], row["p75"], row["max"]) == (
        4, 2.5, 1.0, 1.75, 2.5, 3.25, 4.0)
    assert row["std"] == pytest.approx(1.2909944487)


def test_value_counts_order_and_null(spark):
    df = spark.createDataFrame([(v,) for v in ("b", "a", "c", "c", None, None, None)], "x STRING")
    assert [tuple(r) for r in quality.value_counts(df, "x").collect()] == [
        ("c", 2), ("a", 1), ("b", 1)]
    assert [tuple(r) for r in quality.value_counts(df, "x", 2, keep_null=True).collect()] == [
        (None, 3), ("c", 2)]


def test_null_audit_is_one_pass(spark):
    df = spark.createDataFrame([(None, 1), (None, None), ("x", 2)], "a STRING, b INT")
    audit = quality.null_audit(df, ["a", "b"])
    plan = audit._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
    assert {r["column"]: r["nulls"] for r in audit.collect()} == {"a": 2, "b": 1}


def test_correlation_pairs(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, -1.0 * i) for i in range(9)],
                               "a DOUBLE, b DOUBLE, c DOUBLE")
    row = quality.correlations(df, [("a", "b"), ("a", "c")]).first()
    assert (round(row.corr_a_b, 9), round(row.corr_a_c, 9)) == (1.0, -1.0)


def test_guard(spark):
    df = spark.range(1)
    assert quality.require_rows(df, "none") is df
    with pytest.raises(ValueError, match="none"):
        quality.require_rows(df.limit(0), "none")


def test_preview_is_ordered(spark):
    df = spark.range(50).repartition(7)
    assert [r.id for r in quality.preview(df, ["id"], 3).collect()] == [0, 1, 2]


def test_profiles_are_bit_equal_in_any_layout(spark):
    draw = random.Random(2)
    rows = [(draw.lognormvariate(8, 2), float(draw.randrange(10**6)) / 100, i % 50) for i in range(5000)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "x DOUBLE, precio FLOAT, km INT").cache()
    found = set()
    for n in (1, 7, 200):
        some = df.repartition(n)
        found.add((tuple(quality.price_stats(some).first()), tuple(quality.describe_number(some, "x").first()),
                   tuple(quality.correlations(some, [("x", "precio"), ("km", "precio")]).first())))
    assert len(found) == 1
    stats, described, corr = found.pop()
    values = sorted(r.precio for r in df.collect() if r.precio is not None)
    assert stats[:5] == (values[0], values[1249], values[2499], values[3749], values[-1])
    assert stats[5] == pytest.approx(sum(values) / 5000, rel=1e-12)
    plain = df.agg(F.corr("x", "precio"), F.corr("km", "precio")).first()
    assert corr == pytest.approx(tuple(plain), rel=1e-6)


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 9.0)], "a DOUBLE, b DOUBLE")
    assert quality.correlations(df, [("a", "b")]).first()[0] is None
