from __future__ import annotations

import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from riskmill.functions.numeric import (
    is_out_of_scale,
    missing_if_nan,
    repair_scale,
    safe_ratio,
    shortfall,
    text_to_double,
)

#: In scale, on the limit, a lost point of every size, both signs.
VALUES = [sign * scale * value for value in (0.0, 3.125, 19.75, 20.0) for scale in (1.0, 1e2, 1e7, 1e15) for sign in (1, -1)]


def divided(value: float, limit: float = 20.0) -> float:
    """Repeated division, as a plain loop."""
    for _ in range(64):
        if abs(value) <= limit:
            break
        value /= 10.0
    return value


def test_repair_known_values(table):
    df = table("x double", *VALUES)
    for row in df.withColumn("got", repair_scale(F.col("x"), 20)).collect():
        assert row["got"] == divided(row["x"]) and abs(row["got"]) <= 20


def test_repair_is_idempotent_and_bit_exact(spark):
    @settings(max_examples=15, deadline=None)
    @given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=50))
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        once = repair_scale(F.col("x"), 20)
        rows = df.select("x", once.alias("once"), repair_scale(once, 20).alias("twice")).collect()
        for row in rows:
            assert row["once"] == divided(row["x"])
            assert row["twice"] == divided(row["once"])

    check()


def test_repair_keeps_missing_and_infinite(table):
    rows = table("x double", None, math.inf).select(repair_scale(F.col("x"), 20)).collect()
    assert [r[0] for r in rows] == [None, math.inf]


@pytest.mark.parametrize(
    "text, want",
    [
        ("14.0", 14.0), (" 7.25 ", 7.25), ("\t3\n", 3.0), ("-1e3", -1000.0), (".5", 0.5),
        ("880.5", 880.5), ("", None), ("   ", None), ("abc", None), ("nan", None),
        ("1.0d", None), ("1_0", None), ("inf", math.inf), (None, None), ("5.", 5.0),
    ],
)
def test_text_to_double(table, text, want):
    assert table("s string", text).select(text_to_double(F.col("s"))).first()[0] == want


def test_out_of_scale_flag(table):
    values = [*VALUES, math.inf, None, math.nan]
    df = table("i int, x double", *enumerate(values)).orderBy("i")
    got = [r[0] for r in df.select(is_out_of_scale(missing_if_nan(F.col("x")), 20)).collect()]
    assert got == [v is not None and abs(v) > 20 for v in values]


def test_safe_ratio_and_shortfall(table):
    df = table("a double, b double", (3.0, 6.0), (1.0, 0.0), (None, 4.0), (5.0, None), (5.0, 2.0))
    got = df.select(
        safe_ratio(F.col("a"), F.col("b")).alias("r"), shortfall(F.col("a"), F.col("b")).alias("s")
    ).collect()
    assert [r["r"] for r in got] == [0.5, 0.0, 0.0, 0.0, 2.5]
    assert [r["s"] for r in got] == [3.0, 0.0, 0.0, 0.0, 0.0]
