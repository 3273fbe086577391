"""Operators on result tables: one row per scenario, model, stage and metric.

These tables are small by nature (their size is models x scenarios x metrics), so
the optimizer's own choice of join and sort is the right one here.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskmill.spec import GAP_TOLERANCE, METRICS, SIMPLICITY_MARGIN

# Column order of a result table, then any extra columns.
RESULT_COLUMNS = (
    "scenario",
    "scenario_label",
    "target",
    "stage",
    "model",
    "metric",
    "train_mean",
    "cv_mean",
    "cv_std",
    "gap",
)
BASELINE = "dummy_prior"
KEY_METRICS = ("f2", "recall", "precision", "f1", "roc_auc", "accuracy")


def summarize_folds(
    folds: DataFrame,
    keys: Sequence[str],
    cv_value: str = "cv_value",
    train_value: str = "train_value",
) -> DataFrame:
    """Fold values to mean, population deviation, training mean and their gap."""
    summary = folds.groupBy(*keys).agg(
        F.avg(train_value).alias("train_mean"),
        F.avg(cv_value).alias("cv_mean"),
        F.stddev_pop(cv_value).alias("cv_std"),
    )
    return summary.withColumn("gap", F.col("train_mean") - F.col("cv_mean"))


def result_table(parts: Sequence[DataFrame], columns: Sequence[str] = RESULT_COLUMNS) -> DataFrame:
    """Append result rows by name: canonical columns first, extra ones after them."""
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    known = [c for c in columns if c in table.columns]
    return table.select(*known, *[c for c in table.columns if c not in set(columns)])


def filter_results(
    table: DataFrame,
    target: str | None = None,
    stage: str | None = None,
    scenario: str | None = None,
    metrics: Sequence[str] = (),
    baseline: str | None = None,
) -> DataFrame:
    """Rows of one target, stage or scenario, some metrics, without the baseline."""
    conditions = [
        F.col(name) == value
        for name, value in (("target", target), ("stage", stage), ("scenario", scenario))
        if value is not None
    ]
    if metrics:
        conditions.append(F.col("metric").isin(list(metrics)))
    if baseline is not None:
        conditions.append(F.col("model") != baseline)
    return table.where(reduce(lambda a, b: a & b, conditions, F.lit(True)))


def top_results(table: DataFrame, n: int, keys: Sequence[str] = ("scenario", "model")) -> DataFrame:
    """The ``n`` best rows by cross-validated value."""
    return table.orderBy(F.desc("cv_mean"), *keys).limit(n)


def largest_gaps(
    table: DataFrame, n: int = 20, keys: Sequence[str] = ("scenario", "model")
) -> DataFrame:
    """The ``n`` rows with the largest distance between training and validation."""
    return table.orderBy(F.desc("gap"), *keys).limit(n)


def model_order(table: DataFrame) -> DataFrame:
    """Mean value per model, best first."""
    return (
        table.groupBy("model").agg(F.avg("cv_mean").alias("mean_value"))
        .orderBy(F.desc("mean_value"), "model")
    )


def pivot_metric(table: DataFrame, models: Sequence[str], row: str = "scenario_label") -> DataFrame:
    """Scenarios as rows and models as columns for the rows of one metric."""
    return table.groupBy(row).pivot("model", list(models)).agg(F.avg("cv_mean"))


def key_table(
    table: DataFrame, row: str = "scenario_label", metrics: Sequence[str] = KEY_METRICS
) -> DataFrame:
    """One row per scenario and model: every metric as a column and the F2 gap."""
    wide = (
        table.where(F.col("metric").isin(list(metrics)))
        .groupBy(row, "model")
        .pivot("metric", list(metrics))
        .agg(F.avg("cv_mean"))
    )
    gaps = table.where(F.col("metric") == "f2").select(row, "model", F.col("gap").alias("gap_f2"))
    return (
        wide.join(gaps, [row, "model"], "left")
        .select(row, "model", "gap_f2", *metrics)
        .orderBy(F.desc("f2"), row, "model")
    )


def gap_long(table: DataFrame, row: str = "scenario_label") -> DataFrame:
    """Training and validation values as rows, labelled "scenario | model"."""
    names = F.create_map(
        F.lit("train_mean"), F.lit("Treino"), F.lit("cv_mean"), F.lit("Validacao cruzada")
    )
    return (
        table.select(F.concat_ws(" | ", row, "model").alias("label"), "train_mean", "cv_mean")
        .unpivot("label", ["train_mean", "cv_mean"], "part", "value")
        .select("label", names[F.col("part")].alias("part"), "value")
    )


def distinct_parameters(
    table: DataFrame, columns: Sequence[str] = ("scenario", "model", "best_params")
) -> DataFrame:
    return table.select(*columns).distinct()


# Reasons recorded with a selection.
REASON_BEST = "Melhor F2 na validacao cruzada."
REASON_TIE = (
    "Empate tecnico dentro da margem de {margin:.2f} em F2; escolhido o modelo com menor gap "
    "treino-CV (mais estavel e mais interpretavel)."
)


def select_candidates(
    table: DataFrame,
    margin: float = SIMPLICITY_MARGIN,
    by: Sequence[str] = ("scenario",),
    baseline: str = BASELINE,
    target: str = "principal",
    stage: str = "tuned",
) -> DataFrame:
    """Final model per scenario: among those close to the best F2, the smallest gap.

    All scenarios are solved in one query.
    """
    rows = filter_results(table, target, stage, metrics=("f2",), baseline=baseline)
    best = rows.groupBy(*by).agg(
        F.max("cv_mean").alias("best_f2"),
        F.min_by("model", F.struct(-F.col("cv_mean"), F.col("model"))).alias("best_by_f2"),
    )
    near = rows.join(best, list(by)).where(F.col("cv_mean") >= F.col("best_f2") - F.lit(margin))
    first = F.struct("gap", -F.col("cv_mean"), "model")
    chosen = near.groupBy(*by).agg(
        F.first("best_by_f2").alias("best_by_f2"),
        F.first("best_f2").alias("best_f2"),
        F.min_by(F.struct("model", "cv_mean", "gap"), first).alias("_chosen"),
        F.sort_array(F.collect_set("model")).alias("within_margin"),
    )
    model = F.col("_chosen.model")
    return chosen.select(
        *by,
        "best_by_f2",
        "best_f2",
        model.alias("chosen_model"),
        F.col("_chosen.cv_mean").alias("chosen_f2"),
        F.col("_chosen.gap").alias("chosen_gap"),
        F.lit(margin).alias("margin"),
        "within_margin",
        F.when(model == F.col("best_by_f2"), F.lit(REASON_BEST))
        .otherwise(F.lit(REASON_TIE.format(margin=margin)))
        .alias("reason"),
    )


def select_final_candidate(
    table: DataFrame, scenario: str, margin: float = SIMPLICITY_MARGIN, **options
) -> dict:
    """The selection for one scenario as a record; no results is an error."""
    row = select_candidates(table.where(F.col("scenario") == scenario), margin, **options).first()
    if row is None:
        raise ValueError(f"no tuned results for scenario {scenario!r}")
    return row.asDict()


# Names and explanations of the diagnoses.
DIAGNOSES = {
    "overfitting": (
        "O desempenho no treino e bem superior ao da validacao cruzada: "
        "o modelo memoriza o treino."
    ),
    "underfitting": (
        "Treino e validacao tem desempenho baixo e proximos: o modelo e "
        "simples demais para o problema."
    ),
    "ajuste_adequado": (
        "Treino e validacao ficam proximos e em nivel util: nao ha sinal "
        "relevante de overfitting nem de underfitting."
    ),
}


def diagnosis(train: Column, cv: Column, tolerance: float = GAP_TOLERANCE) -> Column:
    """Name of the fit diagnosis for a training and a validation value."""
    low = F.lit(0.5)
    return (
        F.when(train - cv > F.lit(tolerance), F.lit("overfitting"))
        .when((train < low) & (cv < low), F.lit("underfitting"))
        .otherwise(F.lit("ajuste_adequado"))
    )


def diagnose_fit(
    table: DataFrame,
    train: str = "train_mean",
    cv: str = "cv_mean",
    test: str = "test_value",
    tolerance: float = GAP_TOLERANCE,
) -> DataFrame:
    """Add both gaps, the diagnosis and its explanation to every row."""
    texts = F.create_map(*[F.lit(part) for pair in DIAGNOSES.items() for part in pair])
    return table.withColumns(
        {
            "gap_train_cv": F.col(train) - F.col(cv),
            "gap_cv_test": F.col(cv) - F.col(test),
            "tolerance": F.lit(tolerance),
            "diagnosis": diagnosis(F.col(train), F.col(cv), tolerance),
        }
    ).withColumn("explanation", texts[F.col("diagnosis")])


def metrics_long(
    folds: DataFrame, keys: Sequence[str], part: str = "part", metrics: Sequence[str] = METRICS
) -> DataFrame:
    """Fold metrics (one row per fold and part) to fold values per metric.

    The result has the training and the validation value side by side.
    """
    long = folds.unpivot([*keys, part], list(metrics), "metric", "value")
    return (
        long.groupBy(*keys, "metric")
        .pivot(part, ["train", "validation"])
        .agg(F.first("value"))
        .withColumnsRenamed({"train": "train_value", "validation": "cv_value"})
    )
