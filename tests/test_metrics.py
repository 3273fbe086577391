from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskmill.functions.risk import RISK_BANDS, is_at_risk, recommendation, risk_band
from riskmill.operators import metrics


def brute_auc(y, s):
    pairs = [(a, b) for a, u in zip(s, y) if u for b, v in zip(s, y) if not v]
    return sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs)


def brute_ap(y, s):
    total = 0.0
    for t in sorted(set(s), reverse=True):
        hits = sum(1 for a, u in zip(s, y) if u and a == t)
        tp = sum(1 for a, u in zip(s, y) if u and a >= t)
        total += hits / sum(y) * tp / sum(a >= t for a in s)
    return total


@pytest.fixture
def scores(spark):
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, 300)
    s = np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1).round(2)
    s[::3] = 0.5  # a hot score with a third of the rows
    return y.tolist(), s.tolist(), spark.createDataFrame(
        [(int(i % 2), int(a), float(b)) for i, (a, b) in enumerate(zip(y, s))],
        "g int, y int, s double",
    )


@pytest.mark.parametrize("ranges", [1, 7])
def test_rank_metrics_match_brute_force(scores, ranges):
    y, s, df = scores
    row = metrics.rank_metrics(df, "y", "s", ranges=ranges).first()
    assert row["roc_auc"] == pytest.approx(brute_auc(y, s), abs=1e-12)
    assert row["average_precision"] == pytest.approx(brute_ap(y, s), abs=1e-12)
    assert row["baseline"] == pytest.approx(sum(y) / len(y))
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="s", labelCol="y", metricName="areaUnderROC", numBins=0
    )
    assert row["roc_auc"] == pytest.approx(
        evaluator.evaluate(df.withColumn("y", F.col("y").cast("double"))), abs=1e-9
    )


def test_rank_metrics_per_group(scores):
    y, s, df = scores
    for row in metrics.rank_metrics(df, "y", "s", by=["g"], ranges=4).collect():
        part = [(a, b) for i, (a, b) in enumerate(zip(y, s)) if i % 2 == row["g"]]
        assert row["roc_auc"] == pytest.approx(brute_auc(*zip(*part)), abs=1e-12)


def test_one_class_has_no_auc(table):
    row = metrics.rank_metrics(table("y int, s double", (1, 0.3), (1, 0.4)), "y", "s").first()
    assert row["roc_auc"] is None and row["average_precision"] == 1.0


def test_curves(scores):
    y, s, df = scores
    roc = metrics.roc_points(df, "y", "s", ranges=5).collect()
    assert len(roc) == len(set(s)) + 1
    for point in roc:
        cut = math.inf if point["threshold"] is None else point["threshold"]
        tp = sum(1 for a, u in zip(s, y) if u and a >= cut)
        fp = sum(1 for a, u in zip(s, y) if not u and a >= cut)
        assert point["tpr"] == pytest.approx(tp / sum(y))
        assert point["fpr"] == pytest.approx(fp / (len(y) - sum(y)))
    pr = metrics.pr_points(df, "y", "s", ranges=5).collect()
    assert any(p["precision"] == 1.0 and p["recall"] == 0.0 for p in pr)
    grouped = metrics.roc_points(df, "y", "s", by=["g"]).groupBy("g").count().collect()
    assert len(grouped) == 2


def test_confusion_and_metrics(table, records):
    df = table("y int, s double", (0, 0.1), (0, 0.6), (1, 0.7), (1, 0.2))
    row = records(metrics.metrics_at(df, "y", "s", 0.5))[0]
    assert [row[c] for c in ("tn", "fp", "fn", "tp")] == [1, 1, 1, 1]
    assert row["recall"] == 0.5 and row["f2"] == 0.5 and row["accuracy"] == 0.5
    shares = records(metrics.confusion_shares(df, "y", "s", 0.5))
    assert all(cell["share"] == 0.5 for cell in shares)


def test_no_positive_prediction_gives_zero(table, records):
    row = records(metrics.metrics_at(table("y int, s double", (0, 0.1), (1, 0.2)), "y", "s", 0.9))[0]
    assert row["precision"] == row["recall"] == row["f1"] == row["f2"] == 0.0


def test_threshold_table_in_groups(scores, records):
    y, s, df = scores
    rows = records(metrics.threshold_table(df, "y", "s", (0.4, 0.5), by=["g"]))
    assert len(rows) == 4
    for row in rows:
        part = [(a, b) for i, (a, b) in enumerate(zip(y, s)) if i % 2 == row["g"]]
        assert row["tp"] == sum(1 for a, b in part if a and b >= row["threshold"])
        assert sum(row[c] for c in ("tn", "fp", "fn", "tp")) == len(part)


def test_threshold_ties(table):
    """Of equal metrics the threshold nearest one half wins, of two as near the lower one."""
    points = [(t / 16, 0.75 if t in (3, 6, 10) else 0.5) for t in range(1, 16)]
    best = metrics.best_threshold(table("threshold double, f2 double", *points))
    assert best.first()["threshold"] == 6 / 16
    assert metrics.best_threshold(table("threshold double, f2 double")).first()["threshold"] == 0.5


def test_f2_formula(spark):
    @settings(max_examples=20, deadline=None)
    @given(st.tuples(*[st.integers(0, 50)] * 4))
    def check(counts):
        tn, fp, fn, tp = counts
        df = spark.createDataFrame([counts], "tn int, fp int, fn int, tp int")
        rates = metrics.rate_metrics(*[F.col(c) for c in df.columns])
        got = df.select(*[v.alias(k) for k, v in rates.items()]).first()
        precision = tp / (tp + fp) if tp + fp else 0.0
        recall = tp / (tp + fn) if tp + fn else 0.0
        for beta, name in ((1, "f1"), (2, "f2")):
            bottom = beta**2 * precision + recall
            want = (1 + beta**2) * precision * recall / bottom if bottom else 0.0
            assert got[name] == pytest.approx(want)

    check()


def test_class_weights(table, records):
    rows = table("y int", 1, 0, 0, 0, None)
    got = {r["y"]: r for r in records(metrics.class_weights(rows, "y"))}
    assert got[1]["weight"] == 2.0 and got[0]["weight"] == pytest.approx(4 / 6)
    assert got[1]["prior"] == 0.25


@pytest.mark.parametrize("p", [None, math.nan, *(i / 40 for i in range(41))])
def test_risk_bands(table, p):
    row = table("p double", p).select(
        risk_band(F.col("p")).alias("b"), recommendation(F.col("p")).alias("r"),
        is_at_risk(F.col("p"), 0.35).alias("a"),
    ).first()
    value = 0.0 if p is None or math.isnan(p) else p
    reached = [(name, advice) for bound, name, advice in RISK_BANDS if value >= bound][-1]
    assert (row["b"], row["r"]) == reached and row["a"] is (value >= 0.35)


@pytest.mark.parametrize("ranges", [1, 8])
def test_missing_scores_are_left_out(table, records, ranges):
    known = [(i % 2, i / 20) for i in range(20)]
    gaps = [(1, math.nan), (0, math.nan), (1, None), (None, 0.5)]
    plain, holed = table("y int, s double", *known), table("y int, s double", *known, *gaps)
    for measure in (metrics.rank_metrics, metrics.roc_points, metrics.pr_points):
        got = [sorted(map(repr, measure(df, "y", "s", ranges=ranges).collect())) for df in (plain, holed)]
        assert got[0] == got[1]
    for measure in (metrics.threshold_table, lambda df, y, s: metrics.confusion_at(df, y, s, 0.4)):
        assert sorted(map(repr, measure(plain, "y", "s").collect())) == sorted(map(repr, measure(holed, "y", "s").collect()))
