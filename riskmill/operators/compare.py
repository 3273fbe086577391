"""Cross-validation, grid search and model comparison.

Each fit is a distributed Spark job; the driver only loops over folds, models and
parameters. Preprocessing is fitted for all folds in the same reads, each on its training rows, for the columns
of all scenarios together: every column's statistics stand alone, so a scenario just
picks its own. Boosting candidates that differ in rounds alone are prefixes of one fit.
A forest is scored alone as soon as it is fitted and then dropped, since its nodes are sent to every task from the driver;
all other candidates of a fold are scored in one pass. What is written is the
number of rows per score and outcome, not the rows.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from riskmill.functions.durable import materialize, take_bounded
from riskmill.functions.parallel import run_together
from riskmill.operators import metrics
from riskmill.operators.forest import GrownForestModel
from riskmill.operators.models import (
    DEFAULTS,
    FAMILY_ORDER,
    GRIDS,
    MODELS,
    boosted_prefix,
    build_pipeline,
    classifier,
    expand_grid,
    preprocessor,
)
from riskmill.operators.results import metrics_long, result_table, summarize_folds
from riskmill.operators.scenarios import resolve_scenario
from riskmill.operators.split import (
    stratified_folds,
    stratified_split,
    training_prefixes,
)
from riskmill.operators.unions import fit_unions
from riskmill.spec import CURVE_SHARES, FOLDS, METRICS, TARGETS, THRESHOLDS, Scenario, TableSpec


@dataclass(frozen=True)
class Candidate:
    """A model family with parameters, under a name, on all or some final columns of the training."""

    name: str
    family: str
    settings: Mapping = field(default_factory=dict)
    columns: tuple[str, ...] = ()  # none named: all


@dataclass(frozen=True)
class Training:
    """Training rows with id, label and fold, and what to do with them."""

    rows: DataFrame
    columns: tuple[str, ...]  # final columns of the scenario
    spec: TableSpec
    row_id: str
    label: str = "label"
    fold: str = "fold"
    folds: int = FOLDS
    parallelism: int = 1  # fits at the same time within a fold
    fold_parallelism: int = 1  # folds at the same time; each keeps its features cached
    #: Preprocessing and small models that were fitted on the folds, for the next call with the same candidate.
    fits: dict = field(default_factory=dict, init=False, repr=False, compare=False)


def prepare_training(
    df: DataFrame,
    spec: TableSpec,
    scenario: str,
    target: str,
    row_id: str,
    folds: int = FOLDS,
    parallelism: int = 1,
    fold_parallelism: int = 1,
    **fold_options,
) -> Training:
    """Labelled rows of a scenario with their folds, written once for all fits."""
    inputs, final = resolve_scenario(df, spec.scenarios[scenario], spec.roles)
    labelled = df.where(F.col(target).isNotNull()).select(
        row_id, F.col(target).cast("double").alias("label"), *inputs
    )
    rows = stratified_folds(labelled, "label", row_id, folds, **fold_options)
    return Training(
        materialize(rows, "training"), tuple(final), spec, row_id, folds=folds,
        parallelism=parallelism, fold_parallelism=fold_parallelism,
    )


#: Bytes of features in one partition, about: few rows make few, not tiny tasks.
PARTITION_BYTES = 64 << 20
#: Bytes, about, that folds fitted at the same time may keep: the features of each, and once more for each of its
#: fits at work. A fold beyond that fills all cores alone.
TOGETHER_BYTES = 8 << 30
#: Families whose models are a few numbers, so that those of all folds are kept and not fitted again.
SMALL_MODELS = ("logistic", "logistic_balanced", "dummy_prior")


def _feature_bytes(rows: int, columns: int) -> int:
    return rows * columns * 16


def _compact(features: DataFrame, rows: int, columns: int) -> DataFrame:
    """``features`` in no more partitions than their size asks for. Every round of a fit is a job over all of them."""
    return features.coalesce(max(1, -(-_feature_bytes(rows, columns) // PARTITION_BYTES)))


def _fit_groups(candidates: Sequence[Candidate]) -> list[list[Candidate]]:
    """Candidates that share one fit: boosting on the same columns that differs in the number of rounds."""
    groups: dict[tuple, list[Candidate]] = {}
    for i, c in enumerate(candidates):
        settings = {**DEFAULTS[c.family], **c.settings}
        if c.family == "hist_gradient_boosting":
            settings.pop("max_iter")
            key = (c.columns, json.dumps(settings, sort_keys=True))
        else:
            key = (i,)
        groups.setdefault(key, []).append(c)
    return list(groups.values())


def _rounds(candidate: Candidate) -> int:
    return int({**DEFAULTS[candidate.family], **candidate.settings}["max_iter"])


def _fit_group(group: Sequence[Candidate], rows: DataFrame, sizes: Mapping, label: str) -> dict:
    """Model per candidate name of one group of ``_fit_groups``."""
    longest = group[0] if len(group) == 1 else max(group, key=_rounds)
    model = classifier(longest.family, longest.settings, label).fit_sized(rows, sizes)
    if len(group) == 1:
        return {longest.name: model}
    return {c.name: boosted_prefix(model, _rounds(c)) for c in group}


def _with_outcomes(features: DataFrame, models: Mapping, keep: Sequence[Column]) -> DataFrame:
    """(keep, candidate, score, predicted): all models applied in one pass over the rows."""
    outcomes = []
    for i, (name, model) in enumerate(models.items()):
        features = model.transform(features)
        features = features.withColumnsRenamed({"probability": f"_probability{i}", "prediction": f"_prediction{i}"}).drop("rawPrediction")
        outcomes.append(
            F.struct(
                F.lit(name).alias("candidate"),
                vector_to_array(F.col(f"_probability{i}"))[1].alias("score"),
                F.col(f"_prediction{i}").cast("int").alias("predicted"),
            )
        )
    return features.select(*keep, F.inline(F.array(*outcomes)))


def _each_fold(
    training: Training, candidates: Sequence[Candidate], finish: Callable, held_out: bool = False
) -> list:
    """Fit all candidates on every fold and hand the scored rows to ``finish``; its results.

    Scored rows are (candidate, fold, part, row id, y, score, predicted), with ``held_out`` only
    those of the validation part. They come in several parts for a fold, each candidate whole in one of them.
    ``finish`` must run its job, because the features of a fold are released afterwards.
    """
    *prepare, _ = preprocessor(training.columns, training.spec).getStages()
    sets = {c.columns or training.columns: None for c in candidates}
    assemblers = {columns: preprocessor(columns, training.spec).getStages()[-1] for columns in sets}
    slots = sorted({c for a in assemblers.values() for c in a.getInputCols()})
    others = {holdout: [f for f in range(training.folds) if f != holdout] for holdout in range(training.folds)}
    if "prepared" not in training.fits:
        training.fits["prepared"] = fit_unions(prepare, training.rows, training.fold, training.folds, others)
        training.fits["sizes"] = _fold_sizes(training)
    prepared, sizes_of = training.fits["prepared"], training.fits["sizes"]
    count = sum(sum(sizes.values()) for sizes in sizes_of.values())
    # A prior reads no features: Spark leaves them out, unless they are kept.
    kept = any(c.family != "dummy_prior" for c in candidates)

    def run(holdout: int):
        shared = prepared[holdout].transform(training.rows).select(training.row_id, training.label, training.fold, *slots)
        shared = _compact(shared, count, len(slots))
        if kept:
            shared = shared.persist()
        try:
            of_set = {
                columns: a.transform(shared).select(training.row_id, training.label, training.fold, "features")
                for columns, a in assemblers.items()
            }
            sizes = Counter()
            for fold in others[holdout]:
                sizes.update(sizes_of.get(fold, {}))

            part = F.when(F.col(training.fold) == holdout, "validation").otherwise("train")
            keep = [
                F.lit(holdout).alias("fold"),
                part.alias("part"),
                F.col(training.row_id),
                F.col(training.label).cast("int").alias("y"),
            ]

            def score(columns, models):
                features = of_set[columns]
                rows = features.where(F.col(training.fold) == holdout) if held_out else features
                return _with_outcomes(rows, models, keep)

            def fit(group):
                """Models of the group, or what ``finish`` made of a forest."""
                columns = group[0].columns or training.columns
                known = (holdout, columns, group[0].family, json.dumps({**DEFAULTS[group[0].family], **group[0].settings}, sort_keys=True))
                if known in training.fits:
                    return {group[0].name: training.fits[known]}, []
                models = _fit_group(group, of_set[columns].where(F.col(training.fold) != holdout), sizes, training.label)
                if group[0].family in SMALL_MODELS:
                    training.fits[known] = models[group[0].name]
                if group[0].family.startswith("random_forest"):
                    results = [finish(score(columns, models))]
                    for model in models.values():
                        if isinstance(model, GrownForestModel):
                            model.release(shared.sparkSession)
                    return {}, results
                return models, []

            groups = _fit_groups(candidates)
            # Long fits first, so that none is left over at the end.
            order = sorted(groups, key=lambda g: FAMILY_ORDER.index(g[0].family))
            fitted = run_together([lambda g=g: fit(g) for g in order], training.parallelism, shared.sparkSession)
            models = {name: model for found, _ in fitted for name, model in found.items()}
            finished = [result for _, results in fitted for result in results]
            scored = []
            for columns in of_set:
                wanted = {c.name: models[c.name] for c in candidates if (c.columns or training.columns) == columns and c.name in models}
                if wanted:
                    scored.append(score(columns, wanted))
            return [*finished, finish(_union(scored))] if scored else finished
        finally:
            if kept:
                shared.unpersist()

    tasks = [lambda holdout=holdout: run(holdout) for holdout in range(training.folds)]
    each = _feature_bytes(count, len(slots)) * (1 + min(training.parallelism, len(candidates))) if kept else 1
    together = max(1, min(training.fold_parallelism, TOGETHER_BYTES // max(1, each)))
    return [result for results in run_together(tasks, together, training.rows.sparkSession) for result in results]


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of ``frames``, united in pairs, so that the plan of many stays flat."""
    frames = list(frames)
    while len(frames) > 1:
        frames = [reduce(DataFrame.unionByName, frames[i : i + 2]) for i in range(0, len(frames), 2)]
    return frames[0]


def _fold_sizes(training: Training) -> dict[int, dict[float, int]]:
    """Rows per fold and value of the 0/1 label, in one read."""
    counts = training.rows.where(F.col(training.label).isNotNull()).groupBy(training.fold, training.label).count()
    sizes: dict[int, dict[float, int]] = {}
    for row in take_bounded(counts, 2 * training.folds, "folds and classes of a 0/1 label"):
        sizes.setdefault(row[training.fold], {})[float(row[training.label])] = row["count"]
    return sizes


SCORE_COLUMNS = ("candidate", "fold", "part", "y", "score", "predicted")


def cross_validation_scores(training: Training, candidates: Sequence[Candidate]) -> DataFrame:
    """Scores of every row under every fold's model, training rows included."""
    def write(scored):
        return materialize(scored.select("candidate", "fold", "part", training.row_id, "y", "score", "predicted"), "scores")

    return _union(_each_fold(training, candidates, write))


def score_counts(training: Training, candidates: Sequence[Candidate], held_out: bool = False) -> DataFrame:
    """(candidate, fold, part, y, score, predicted, rows): rows per score and outcome, written fold by fold."""
    def write(scored):
        return materialize(scored.groupBy(*SCORE_COLUMNS).agg(F.count("*").alias("rows")), "score-counts")

    return _union(_each_fold(training, candidates, write, held_out))


def fold_metrics(scores: DataFrame) -> DataFrame:
    """All metrics per candidate, fold and part, in one query; of rows, or of ``score_counts``."""
    by = ("candidate", "fold", "part")
    if "rows" in scores.columns:
        return metrics.counted_metrics(scores, by)
    return metrics.prediction_metrics(scores, "y", "score", "predicted", by=by)


def _summary(per_fold: DataFrame) -> DataFrame:
    return summarize_folds(metrics_long(per_fold, ("candidate", "fold")), ("candidate", "metric"))


def cross_validate(training: Training, candidates: Sequence[Candidate]) -> DataFrame:
    """Mean, deviation, training mean and gap per candidate and metric."""
    return _summary(fold_metrics(score_counts(training, candidates)))


def out_of_fold_scores(training: Training, candidate: Candidate) -> DataFrame:
    """One score per training row, from the model that has not seen the row."""
    def write(scored):
        return materialize(scored.select("fold", training.row_id, "y", "score", "predicted"), "scores")

    return _union(_each_fold(training, [candidate], write, held_out=True))


def tune_threshold(
    scores: DataFrame, thresholds: Sequence[float] = THRESHOLDS, metric: str = "f2"
) -> tuple[float, DataFrame]:
    """Best threshold on out-of-fold scores, and the table it was chosen from."""
    table = metrics.threshold_table(scores, "y", "score", thresholds)
    rows = take_bounded(table, len(thresholds), "thresholds")
    local = scores.sparkSession.createDataFrame(rows, table.schema)
    return metrics.best_threshold(local, metric).first()["threshold"], local


@dataclass
class SearchResult:
    settings: dict
    scores: list[tuple[dict, float]]


def grid_search(
    training: Training, family: str, grid: Mapping[str, Sequence] | None = None,
    settings: Mapping | None = None,
) -> SearchResult:
    """Parameters with the best mean validation F2; the first of equals wins."""
    grid = GRIDS[family] if grid is None else grid
    points = [{**(settings or {}), **point} for point in expand_grid(grid)]
    candidates = [Candidate(str(i), family, point) for i, point in enumerate(points)]

    def count(scored: DataFrame) -> list:
        counts = metrics.confusion_counts(scored, "y", F.col("predicted"), ("candidate",))
        f2 = metrics.rate_metrics(*[F.col(c) for c in ("tn", "fp", "fn", "tp")])["f2"]
        return take_bounded(counts.select("candidate", f2.alias("f2")), len(points), "grid points")

    totals = dict.fromkeys((c.name for c in candidates), 0.0)
    for rows in _each_fold(training, candidates, count, held_out=True):
        for row in rows:
            totals[row["candidate"]] += row["f2"] / training.folds
    scores = [(point, totals[str(i)]) for i, point in enumerate(points)]
    best = max(scores, key=lambda entry: entry[1])  # max keeps the first of equals
    return SearchResult(dict(best[0]), scores)


def tune_model(
    training: Training, family: str, grid: Mapping[str, Sequence] | None = None
) -> tuple[PipelineModel, dict]:
    """Grid search, then the pipeline refitted on all training rows."""
    grid = GRIDS[family] if grid is None else grid
    best = grid_search(training, family, grid).settings if grid else {}
    pipeline = build_pipeline(training.columns, training.spec, family, best, training.label)
    return pipeline.fit(training.rows), best


def split_side(df: DataFrame, split: DataFrame, row_id: str, part: str) -> DataFrame:
    """Rows of one side of a saved split, labelled or not."""
    ids = split.where(F.col("part") == part).select(row_id)
    return df.join(ids, row_id, "left_semi")


def compare_models(
    df: DataFrame,
    spec: TableSpec,
    row_id: str,
    split: DataFrame,
    scenarios: Sequence[str] | None = None,
    models: Sequence[str] = MODELS,
    targets: Mapping[str, str] = TARGETS,
    tune: bool = True,
    grids: Mapping[str, Mapping] = GRIDS,
    settings: Mapping[str, Mapping] | None = None,
    folds: int = FOLDS,
    parallelism: int = 1,
    fold_parallelism: int = 1,
    **fold_options,
) -> DataFrame:
    """Result table of all models over scenarios, targets and stages.

    ``split`` (row id, part) is the frozen split; only its training side is read, so that
    no test row takes part in a choice. The first target is also tuned. ``settings``
    overrides default parameters per model, for both stages.
    """
    df = split_side(df, split, row_id, "train")
    chosen_scenarios = {key: spec.scenarios[key] for key in scenarios or list(spec.scenarios)}
    settings = settings or {}
    parts = []
    for position, (target_name, target) in enumerate(targets.items()):
        training, columns = _shared_training(
            df, spec, chosen_scenarios, target, row_id, folds, parallelism, fold_parallelism, **fold_options
        )
        tuned = tune and position == 0
        points = {}  # per scenario and model: the default settings, then the grid
        for key in chosen_scenarios:
            for m in models:
                own = dict(settings.get(m, {}))
                grid = expand_grid(grids[m]) if tuned and grids.get(m) else []
                points[key, m] = [own, *({**own, **point} for point in grid)]
        names, candidates = {}, []
        for (key, m), listed in points.items():
            for point in listed:
                same = (key, m, json.dumps({**DEFAULTS[m], **point}, sort_keys=True))
                if same not in names:
                    names[same] = str(len(candidates))
                    candidates.append(Candidate(names[same], m, point, columns[key]))
        summary = _summary(fold_metrics(score_counts(training, candidates)))
        measured = take_bounded(summary, len(candidates) * len(METRICS), "candidates and metrics")
        f2 = {r["candidate"]: r["cv_mean"] for r in measured if r["metric"] == "f2"}
        name_of = lambda key, m, point: names[key, m, json.dumps({**DEFAULTS[m], **point}, sort_keys=True)]
        for (key, m), (own, *grid) in points.items():
            stages = {"default": own}
            if tuned:  # max keeps the first of equals
                stages["tuned"] = max(grid, key=lambda p: f2[name_of(key, m, p)]) if grid else own
            for stage, point in stages.items():
                best = {k: str(v) for k, v in point.items() if stage == "tuned" and k in grids.get(m, {})}
                labels = (name_of(key, m, point), key, spec.scenarios[key].label, target_name, stage, m, len(columns[key]), json.dumps(best))
                parts.extend(
                    (*labels[1:6], r["metric"], r["train_mean"], r["cv_mean"], r["cv_std"], r["gap"], *labels[6:])
                    for r in measured if r["candidate"] == labels[0]
                )
    schema = (
        "scenario string, scenario_label string, target string, stage string, model string, metric string,"
        " train_mean double, cv_mean double, cv_std double, gap double, n_features int, best_params string"
    )
    return result_table([df.sparkSession.createDataFrame(parts, schema)])


def _shared_training(
    df: DataFrame, spec: TableSpec, scenarios: Mapping[str, Scenario], target: str, row_id: str, *options, **fold_options
) -> tuple[Training, dict[str, tuple[str, ...]]]:
    """Training rows with the columns of all scenarios, and the final columns of each."""
    final = {key: tuple(resolve_scenario(df, scenario, spec.roles)[1]) for key, scenario in scenarios.items()}
    every = Scenario("all", "all", tuple(dict.fromkeys(c for s in scenarios.values() for c in s.columns)))
    training = prepare_training(df, replace(spec, scenarios={"all": every}), "all", target, row_id, *options, **fold_options)
    return training, final


def learning_curve(
    training: Training, candidate: Candidate, shares: Sequence[float] = CURVE_SHARES
) -> DataFrame:
    """F2 on growing prefixes of each fold's training rows, in row id order.

    The whole pipeline is refitted on every prefix; the preprocessing of all prefixes of a fold in the same
    reads, because each prefix is the segments of ids up to its cut.
    """
    cuts = training_prefixes(
        training.rows, training.fold, training.row_id, shares, training.folds
    )
    *prepare, assembler = preprocessor(training.columns, training.spec).getStages()
    model = classifier(candidate.family, candidate.settings, training.label)
    fold, row_id = F.col(training.fold), F.col(training.row_id)
    spark = training.rows.sparkSession

    def prepare_fold(holdout: int) -> dict:
        own = {size: cut for (held, size), cut in cuts.items() if held == holdout}
        edges = sorted(set(own.values()))
        below = F.filter(F.array(*[F.lit(edge) for edge in edges]), lambda edge: edge < row_id)
        segment = F.when((fold != holdout) & (row_id <= F.lit(edges[-1])), F.size(below))
        rows = training.rows.withColumn("_segment", segment)
        unions = {size: range(edges.index(cut) + 1) for size, cut in own.items()}
        fitted = fit_unions(prepare, rows, "_segment", len(edges), unions)
        found = rows.where(F.col("_segment").isNotNull()).groupBy("_segment", training.label).count()
        sizes: dict[int, Counter] = {size: Counter() for size in own}
        for row in take_bounded(found, 2 * len(edges), "segments and classes of a 0/1 label"):
            for size, union in unions.items():
                if row["_segment"] in union:
                    sizes[size][float(row[training.label])] += row["count"]
        return {(holdout, size): (fitted[size], sizes[size]) for size in own}

    # What the fits at work keep, features and once more their blocks, is bounded: no more of them at once than may be
    # kept, and features beyond that on disk alone, so that memory is left to the blocks of the fit.
    own = _feature_bytes(max(size for _, size in cuts), len(assembler.getInputCols()))
    together = lambda most, each: max(1, min(most, TOGETHER_BYTES // max(1, each)))
    level = StorageLevel.MEMORY_AND_DISK_DESER if 2 * own <= TOGETHER_BYTES else StorageLevel.DISK_ONLY

    held = sorted({holdout for holdout, _ in cuts})
    parts = run_together([lambda h=h: prepare_fold(h) for h in held], together(training.fold_parallelism, own), spark)
    prepared = {k: v for part in parts for k, v in part.items()}

    def score(holdout: int, size: int, cut) -> list:
        prefix = (fold != holdout) & (row_id <= F.lit(cut))
        ready, sizes = prepared[holdout, size]
        features = assembler.transform(ready.transform(training.rows.where(prefix | (fold == holdout))))
        features = features.select(training.row_id, training.label, training.fold, "features").persist(level)
        try:
            fitted = model.fit_sized(features.where(prefix), sizes)
            part = F.when(fold == holdout, "validation").otherwise("train")
            scored = fitted.transform(features).select(
                F.lit(str(size)).alias("candidate"), F.lit(holdout).alias("fold"), part.alias("part"),
                F.col(training.label).cast("int").alias("y"), F.col("prediction").cast("int").alias("predicted"),
            )
            return take_bounded(_confusion_by_part(scored), 2, "parts of a fold")
        finally:
            features.unpersist()

    tasks = [lambda k=k, cut=cut: score(*k, cut) for k, cut in cuts.items()]
    parts = run_together(tasks, together(training.parallelism, 2 * own), spark)
    counts = spark.createDataFrame([row for part in parts for row in part], _CONFUSION_SCHEMA)
    return _curve(
        counts, F.col("candidate").cast("bigint"), "train_size", with_train_std=True
    )


def validation_curve(
    training: Training, family: str, parameter: str, values: Sequence, settings: Mapping
) -> DataFrame:
    """F2 over the values of one parameter, all other parameters fixed."""
    candidates = [
        Candidate(str(value), family, {**settings, parameter: value}) for value in values
    ]

    def count(scored: DataFrame) -> list:
        return take_bounded(_confusion_by_part(scored), 2 * len(candidates), "curve points")

    rows = [row for part in _each_fold(training, candidates, count) for row in part]
    counts = training.rows.sparkSession.createDataFrame(rows, _CONFUSION_SCHEMA)
    return _curve(counts, F.col("candidate"), "param_value")


_CONFUSION_SCHEMA = (
    "candidate string, fold int, part string, tn bigint, fp bigint, fn bigint, tp bigint"
)


def _confusion_by_part(scored: DataFrame) -> DataFrame:
    keys = ("candidate", "fold", "part")
    return metrics.confusion_counts(scored, "y", F.col("predicted"), keys)


def _curve(counts: DataFrame, value: Column, name: str, with_train_std: bool = False) -> DataFrame:
    f2 = metrics.rate_metrics(*[F.col(c) for c in ("tn", "fp", "fn", "tp")])["f2"]
    train = F.when(F.col("part") == "train", f2)
    cv = F.when(F.col("part") == "validation", f2)
    curve = counts.groupBy(value.alias(name)).agg(
        F.avg(train).alias("train_mean"),
        *([F.stddev_pop(train).alias("train_std")] if with_train_std else []),
        F.avg(cv).alias("cv_mean"),
        F.stddev_pop(cv).alias("cv_std"),
    )
    return curve.withColumn("gap", F.col("train_mean") - F.col("cv_mean")).orderBy(name)


def train_and_test(
    df: DataFrame, target: str, row_id: str, **options
) -> tuple[DataFrame, DataFrame]:
    """Both sides of a stratified split."""
    parts = stratified_split(df, target, row_id, **options)
    return (
        parts.where(F.col("part") == "train").drop("part"),
        parts.where(F.col("part") == "test").drop("part"),
    )

