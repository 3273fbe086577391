from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from riskmill.operators.order_stats import (
    exact_quantiles,
    range_splits,
    running_totals,
    values_at_ranks,
)


def x():
    return F.col("x")


def test_quantiles_match_numpy_on_any_doubles(spark):
    @settings(max_examples=10, deadline=None)
    @given(
        st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=60),
        st.sampled_from([0.5, 0.25, 0.9]),
    )
    def check(values, probability):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        ordered = sorted(values)
        position = probability * (len(values) - 1)
        low, high = ordered[math.floor(position)], ordered[math.ceil(position)]
        got = exact_quantiles(df, {"x": x()}, probability, small_distinct=0)["x"]
        assert low <= got <= high
        if low == high:
            assert got == low

    check()


def test_both_routes_agree(spark):
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.normal(size=501), np.full(300, 0.25), rng.lognormal(8, 3, 400)])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    columns = {"x": x(), "tail": F.when(x() > 10, x()), "none": F.when(x() > 1e300, x())}
    for limit in (10**6, 0):
        got = exact_quantiles(df, columns, small_distinct=limit)
        assert got["x"] == pytest.approx(np.median(values), rel=1e-12)
        assert got["tail"] == pytest.approx(np.median(values[values > 10]), rel=1e-12)
        assert got["none"] is None


def test_ranks_of_long_ids_are_exact(spark):
    base = 2**60
    df = spark.range(1000).select((F.lit(base) + F.col("id") * 3).alias("x"))
    got = values_at_ranks(df, {r: (x(), r) for r in (0, 1, 500, 999, 1000)}, bins=8)
    assert got == {0: base, 1: base + 3, 500: base + 1500, 999: base + 2997, 1000: None}


def test_ranks_with_infinities_and_wide_range(spark):
    values = [-math.inf, -1.7e308, 0.0, 5e-324, 1.7e308, math.inf, math.inf]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = values_at_ranks(df, {r: (x(), r) for r in range(7)}, bins=4)
    assert [got[r] for r in range(7)] == values


def test_running_totals_do_not_depend_on_the_ranges(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), float(s), int(n)) for g, s, n in zip(
        rng.integers(0, 2, 400), rng.beta(0.5, 0.5, 400).round(3), rng.integers(1, 5, 400))]
    df = spark.createDataFrame(rows, "g int, s double, n int")
    per_value = df.groupBy("g", "s").agg(F.sum("n").alias("n"))
    tables = []
    for ranges in (1, 2, 9, 100):
        splits = range_splits(df, "s", ranges)
        out = running_totals(per_value, "s", ["n"], ["g"], splits)
        tables.append(sorted((r["g"], r["s"], r["n"], r["cum_n"]) for r in out.collect()))
    assert tables[0] == tables[1] == tables[2] == tables[3]
    for g, s, _, total in tables[0]:
        assert total == sum(n for h, t, n in rows if h == g and t >= s)


def test_hot_value_leaves_balanced_ranges(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(1)).alias("s")
    )
    splits = range_splits(df, "s", 10)
    assert splits == sorted(set(splits)) and len(splits) >= 6


def test_number_of_ranges_follows_the_row_count(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("s"))
    assert range_splits(df, "s") == []
    assert len(range_splits(df, "s", rows_per_range=10)) == 9


@pytest.mark.parametrize("name", ["impute_scale", "fit_stats", "repair_distribution"])
def test_medians_take_few_jobs(spark, small, name):
    from riskmill.plans import catalog

    spark.sparkContext.setJobGroup(name, name)
    try:
        catalog.QUERIES[name](spark, small).collect()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(name)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(jobs) <= 12


def test_a_bracket_that_misses_is_narrowed(spark, monkeypatch):
    from riskmill.operators import order_stats

    monkeypatch.setattr(order_stats, "SKETCH_ERROR", -0.2)  # a bracket that cannot hold the rank
    df = spark.range(5001).select(F.col("id").cast("double").alias("x"))
    assert exact_quantiles(df, {"x": x()}, 0.5)["x"] == 2500.0
    assert exact_quantiles(df, {"x": x()}, 0.4)["x"] == 2000.0
