"""Classifier metrics as queries over a scored table.

Inputs have a 0/1 label and a score column; ``by`` names grouping columns, so all
folds, parts or models are measured in one query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskmill.functions.durable import materialize
from riskmill.functions.numeric import count_where, missing_if_nan, ratio_or_null, ratio_or_zero
from riskmill.operators.order_stats import range_splits, running_totals
from riskmill.spec import METRICS, THRESHOLDS

_ALL = "_all"


def rate_metrics(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """Accuracy, precision, recall, F1 and F2 of confusion counts; 0/0 is 0."""
    return {
        "accuracy": ratio_or_zero(tp + tn, tp + tn + fp + fn),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(tp * 2, tp * 2 + fp + fn),
        "f2": ratio_or_zero(tp * 5, tp * 5 + fn * 4 + fp),
    }


def _with_rates(counts: DataFrame, keep: Sequence[str]) -> DataFrame:
    cells = [F.col(c) for c in ("tn", "fp", "fn", "tp")]
    rates = rate_metrics(*cells)
    return counts.select(*keep, *[rate.alias(name) for name, rate in rates.items()], *cells)


def present_score(score: str) -> Column:
    """The score as a number; NaN and null are one missing value."""
    return missing_if_nan(F.col(score).cast("double"))


def confusion_counts(
    df: DataFrame, label: str, predicted: Column, by: Sequence[str] = ()
) -> DataFrame:
    """Counts tn, fp, fn, tp for a 0/1 prediction."""
    y = F.col(label)
    return df.groupBy(*by).agg(
        count_where((y == 0) & (predicted == 0)).alias("tn"),
        count_where((y == 0) & (predicted == 1)).alias("fp"),
        count_where((y == 1) & (predicted == 0)).alias("fn"),
        count_where((y == 1) & (predicted == 1)).alias("tp"),
    )


def confusion_at(
    df: DataFrame, label: str, score: str, threshold: float, by: Sequence[str] = ()
) -> DataFrame:
    """Confusion counts for the rule ``score >= threshold``; missing scores are not counted."""
    predicted = (present_score(score) >= F.lit(float(threshold))).cast("int")
    return confusion_counts(df, label, predicted, by)


def confusion_shares(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """Confusion matrix as rows, each cell also as a share of its actual class."""
    counts = confusion_at(df, label, score, threshold)
    cells = [
        F.struct(
            F.lit(actual).alias("actual"),
            F.lit(predicted).alias("predicted"),
            F.col(cell).alias("n"),
            ratio_or_zero(F.col(cell), F.col(cell) + F.col(other)).alias("share"),
        )
        for actual, predicted, cell, other in (
            (0, 0, "tn", "fp"),
            (0, 1, "fp", "tn"),
            (1, 0, "fn", "tp"),
            (1, 1, "tp", "fn"),
        )
    ]
    return counts.select(F.inline(F.array(*cells)))


# --- rank metrics ----------------------------------------------------------

def score_counts(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, score, p, n): positives and negatives per distinct score, written once.

    Hot scores are merged here on the map side; all rank metrics then read this table alone.
    """
    y, s = F.col(label), present_score(score)
    counts = (
        df.where(s.isNotNull() & y.isNotNull())
        .groupBy(*by, s.alias("score"))
        .agg(count_where(y == 1).alias("p"), count_where(y == 0).alias("n"))
    )
    return materialize(counts, "score-counts")


def cumulative_counts(counts: DataFrame, by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """``score_counts`` with cum_p and cum_n, the counts of scores at least as high."""
    return running_totals(counts, "score", ("p", "n"), by, range_splits(counts, "score", ranges))


def rank_metrics(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """ROC AUC (ties count half), average precision and prevalence.

    Sums over the distinct scores of running counts. With a single class AUC is
    null.
    """
    return rank_metrics_of(score_counts(df, label, score, by), by, ranges)


def rank_metrics_of(counts: DataFrame, by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """``rank_metrics`` from a written table (by, score, p, n)."""
    totals = cumulative_counts(counts, by, ranges)
    p, n = F.col("p").cast("double"), F.col("n").cast("double")
    cum_p, cum_n = F.col("cum_p").cast("double"), F.col("cum_n").cast("double")
    sums = totals.groupBy(*by).agg(
        F.sum(n * (cum_p - p / 2.0)).alias("_pairs"),
        F.sum(p * cum_p / (cum_p + cum_n)).alias("_precision"),
        F.sum("p").alias("n_positive"),
        F.sum("n").alias("n_negative"),
    )
    positive, negative = F.col("n_positive").cast("double"), F.col("n_negative").cast("double")
    none = F.lit(0.0)
    return sums.select(
        *by,
        (F.col("_pairs") / F.nullif(positive * negative, none)).alias("roc_auc"),
        (F.col("_precision") / F.nullif(positive, none)).alias("average_precision"),
        (positive / F.nullif(positive + negative, none)).alias("baseline"),
        "n_positive",
        "n_negative",
    )


def _class_sizes(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    return counts.groupBy(*by).agg(F.sum("p").alias("_p"), F.sum("n").alias("_n"))


def _with_end(points: DataFrame, groups: DataFrame, by: Sequence[str], **end: float) -> DataFrame:
    """Append the end point of a curve to every group; no score belongs to it."""
    last = groups.select(
        *by,
        *[F.lit(value).alias(name) for name, value in end.items()],
        F.lit(None).cast("double").alias("threshold"),
    )
    return points.unionByName(last)


def roc_points(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """ROC curve: (fpr, tpr) at every distinct score, and the origin."""
    counts = score_counts(df, label, score, by)
    totals, sizes = cumulative_counts(counts, by, ranges), _class_sizes(counts, by)
    points = _attach(totals, sizes, by).select(
        *by,
        ratio_or_null(F.col("cum_n"), F.col("_n")).alias("fpr"),
        ratio_or_null(F.col("cum_p"), F.col("_p")).alias("tpr"),
        F.col("score").cast("double").alias("threshold"),
    )
    return _with_end(points, sizes, by, fpr=0.0, tpr=0.0)


def pr_points(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """Precision and recall at every distinct score, and the final point (1, 0)."""
    counts = score_counts(df, label, score, by)
    totals, sizes = cumulative_counts(counts, by, ranges), _class_sizes(counts, by)
    points = _attach(totals, sizes, by).select(
        *by,
        ratio_or_null(F.col("cum_p"), F.col("cum_p") + F.col("cum_n")).alias("precision"),
        ratio_or_null(F.col("cum_p"), F.col("_p")).alias("recall"),
        F.col("score").cast("double").alias("threshold"),
    )
    return _with_end(points, sizes, by, precision=1.0, recall=0.0)


def _attach(rows: DataFrame, totals: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add group totals to the rows of each group; without groups, as subqueries."""
    extra = [c for c in totals.columns if c not in set(by)]
    if by:
        return rows.join(totals, list(by))
    return rows.withColumns({c: totals.select(c).scalar() for c in extra})


# --- metrics at thresholds -------------------------------------------------

def threshold_table(
    df: DataFrame,
    label: str,
    score: str,
    thresholds: Sequence[float] = THRESHOLDS,
    by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """All metrics at several thresholds.

    One aggregate counts positives and predictions for every threshold while the
    table is read once; rows are not multiplied. AUC does not depend on the
    threshold and is computed once.
    """
    y, s = F.col(label), present_score(score)
    aggregates = [count_where(y == 1).alias("_p"), count_where(y == 0).alias("_n")]
    for i, threshold in enumerate(thresholds):
        reached = s >= F.lit(float(threshold))
        aggregates += [
            count_where((y == 1) & reached).alias(f"_tp{i}"),
            count_where((y == 0) & reached).alias(f"_fp{i}"),
        ]
    counted = df.where(s.isNotNull() & y.isNotNull()).groupBy(*by).agg(*aggregates)
    rows = [
        F.struct(
            F.lit(float(threshold)).alias("threshold"),
            (F.col("_n") - F.col(f"_fp{i}")).alias("tn"),
            F.col(f"_fp{i}").alias("fp"),
            (F.col("_p") - F.col(f"_tp{i}")).alias("fn"),
            F.col(f"_tp{i}").alias("tp"),
        )
        for i, threshold in enumerate(thresholds)
    ]
    table = _with_rates(counted.select(*by, F.inline(F.array(*rows))), [*by, "threshold"])
    auc = rank_metrics(df, label, score, by, ranges).select(*by, "roc_auc")
    return _attach(table, auc, by).select(
        *by, "threshold", *METRICS, "tn", "fp", "fn", "tp"
    )


def metrics_at(
    df: DataFrame, label: str, score: str, threshold: float, by: Sequence[str] = ()
) -> DataFrame:
    """All metrics at one threshold."""
    return threshold_table(df, label, score, (threshold,), by)


def best_threshold(
    table: DataFrame, metric: str = "f2", by: Sequence[str] = ()
) -> DataFrame:
    """Threshold with the best metric; ties go to the one nearest 0.5, then the lowest."""
    order = (F.struct(
        -F.col(metric), F.abs(F.col("threshold") - F.lit(0.5)), F.col("threshold")
    ))
    best = table.groupBy(*by).agg(F.min_by("threshold", order).alias("threshold"))
    return best.select(*by, F.coalesce("threshold", F.lit(0.5)).alias("threshold"))


def prediction_metrics(
    df: DataFrame,
    label: str,
    score: str,
    predicted: str,
    by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """All metrics per group for a classifier's own prediction, AUC from its score."""
    counts = confusion_counts(df, label, F.col(predicted), by)
    rates = _with_rates(counts, list(by))
    auc = rank_metrics(df, label, score, by, ranges).select(*by, "roc_auc")
    return _attach(rates, auc, by).select(*by, *METRICS, "tn", "fp", "fn", "tp")


def counted_metrics(counts: DataFrame, by: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``prediction_metrics`` from a written table (by, score, y, predicted, rows), one row per distinct score and outcome."""
    y, predicted, rows = F.col("y"), F.col("predicted"), F.col("rows")
    total = lambda where, name: F.coalesce(F.sum(F.when(where, rows)), F.lit(0)).alias(name)
    cells = counts.groupBy(*by).agg(
        total((y == 0) & (predicted == 0), "tn"),
        total((y == 0) & (predicted == 1), "fp"),
        total((y == 1) & (predicted == 0), "fn"),
        total((y == 1) & (predicted == 1), "tp"),
    )
    rates = _with_rates(cells, list(by))
    s = present_score("score")
    per_score = counts.where(s.isNotNull() & y.isNotNull()).groupBy(*by, s.alias("score")).agg(
        total(y == 1, "p"), total(y == 0, "n")
    )
    auc = rank_metrics_of(materialize(per_score, "score-counts"), by, ranges).select(*by, "roc_auc")
    return _attach(rates, auc, by).select(*by, *METRICS, "tn", "fp", "fn", "tp")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows, prior and balanced weight ``n / (classes * n_class)`` per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n_rows"))
    whole = counts.agg(F.sum("n_rows").alias("_total"), F.count("*").alias("_classes"))
    total = F.col("_total").cast("double")
    return _attach(counts, whole, ()).select(
        label,
        "n_rows",
        (F.col("n_rows") / total).alias("prior"),
        (total / (F.col("_classes") * F.col("n_rows"))).alias("weight"),
    )
