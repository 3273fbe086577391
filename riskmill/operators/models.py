"""Classifier families and the pipeline: derive, preprocess, classify."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark import SparkContext, keyword_only
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from riskmill.functions.durable import materialize, take_bounded
from riskmill.operators.forest import grow_forest
from riskmill.operators.stages import (
    MedianScaler,
    ModeImputer,
    PriorClassifierModel,
    RareOneHot,
    RowFeatures,
)
from riskmill.spec import MIN_FREQUENCY, SEED, TableSpec

# Model names and their parameter grids. Depth 0 means unlimited,
# which Spark's forests end at 30 levels.
MODELS = (
    "dummy_prior",
    "logistic",
    "logistic_balanced",
    "random_forest",
    "random_forest_balanced",
    "hist_gradient_boosting",
)
GRIDS: dict[str, dict[str, tuple]] = {
    "dummy_prior": {},
    "logistic": {"C": (0.01, 0.1, 1.0, 10.0)},
    "logistic_balanced": {"C": (0.01, 0.1, 1.0, 10.0)},
    "random_forest": {"max_depth": (0, 6, 12), "min_samples_leaf": (1, 5)},
    "random_forest_balanced": {"max_depth": (0, 6, 12), "min_samples_leaf": (1, 5)},
    "hist_gradient_boosting": {"learning_rate": (0.05, 0.1), "max_iter": (100, 200)},
}
DEFAULTS: dict[str, dict[str, float]] = {
    "dummy_prior": {},
    "logistic": {"C": 1.0, "max_iter": 2000},
    "logistic_balanced": {"C": 1.0, "max_iter": 2000},
    "random_forest": {"max_depth": 0, "min_samples_leaf": 1, "n_estimators": 200},
    "random_forest_balanced": {"max_depth": 0, "min_samples_leaf": 1, "n_estimators": 200},
    "hist_gradient_boosting": {"learning_rate": 0.1, "max_iter": 100},
}
# The longest fits first.
FAMILY_ORDER = tuple(reversed(MODELS))
DEEPEST = 30
# Histogram bins, rows per leaf and depth of a tree of at most 31 leaves.
BOOSTING_BINS, BOOSTING_LEAF_ROWS, BOOSTING_DEPTH = 255, 20, 5
#: Nodes, at most, of the trees of a forest that are grown at the same time. A growing node takes several times the
#: driver memory of a finished one, so a larger forest is grown by groups of trees.
NODES_TOGETHER = 3_000_000
#: Nodes of a tree per training row, at most: a bootstrap sample has 0.64 of the rows, and a binary tree twice its leaves.
NODES_PER_ROW = 1.3
#: A single fit of trees on more rows has them written once, in partitions of at most so many for all cores.
SPREAD_ROWS, PARTITION_ROWS = 50_000, 1_000_000
#: A forest on more rows is grown by tasks that are dealt the rows of a node, see ``forest``; Spark's own grows level by
#: level, sends statistics of every node through a shuffle and holds all nodes in the driver.
FOREST_ROWS = 5_000
_WEIGHT = "_class_weight"


def expand_grid(grid: Mapping[str, Sequence]) -> list[dict]:
    """All combinations of a parameter grid, the last parameter varying fastest."""
    combinations: list[dict] = [{}]
    for name, values in grid.items():
        combinations = [{**c, name: v} for c in combinations for v in values]
    return combinations


class TabularClassifier(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """One of the model families by name; fitting returns Spark's own model.

    The number of rows and the class weights it needs are taken from the rows it
    is fitted on, so they never include validation rows.
    """

    family = Param(Params._dummy(), "family", "model name", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "parameters as JSON", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "feature vector", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, family=None, settings="{}", labelCol="label", featuresCol="features"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self._setDefault(settings="{}", labelCol="label", featuresCol="features")

    def parameters(self) -> dict:
        family = self.getOrDefault(self.family)
        return {**DEFAULTS[family], **json.loads(self.getOrDefault(self.settings))}

    def _fit(self, dataset: DataFrame):
        label = self.getOrDefault(self.labelCol)
        sizes = class_sizes(dataset, label)
        if self.getOrDefault(self.family).startswith(("random_forest", "hist_")) and sum(sizes.values()) > SPREAD_ROWS:
            dataset = _spread(dataset.select(self.getOrDefault(self.featuresCol), label), sum(sizes.values()))
        return self.fit_sized(dataset, sizes)

    def fit_sized(self, dataset: DataFrame, sizes: Mapping[float, int]):
        """Fit on rows whose class sizes are already known.

        Many candidates fitted on the same rows then count them only once.
        """
        family, label = self.getOrDefault(self.family), self.getOrDefault(self.labelCol)
        if family not in MODELS:
            raise ValueError(f"unknown model: {family}")
        total = sum(sizes.values())
        if family == "dummy_prior":
            return PriorClassifierModel(prior=sizes.get(1.0, 0) / total)

        settings = self.parameters()
        columns = {"featuresCol": self.getOrDefault(self.featuresCol), "labelCol": label}
        rows = dataset.select(columns["featuresCol"], label)
        if family.startswith("random_forest") and total > FOREST_ROWS:
            balanced = family.endswith("_balanced")
            return grow_forest(
                rows, *columns.values(), total, trees=int(settings["n_estimators"]), depth=int(settings["max_depth"]) or DEEPEST,
                least=int(settings["min_samples_leaf"]), seed=SEED,
                weights=tuple(total / (len(sizes) * sizes[v]) if balanced and sizes.get(v) else 1.0 for v in (0.0, 1.0)),
            )
        if family.endswith("_balanced"):
            weight = F.lit(None).cast("double")
            for value, size in sizes.items():
                weight = F.when(F.col(label) == value, F.lit(total / (len(sizes) * size))).otherwise(
                    weight
                )
            rows = rows.withColumn(_WEIGHT, weight)
            columns["weightCol"] = _WEIGHT

        if family.startswith("logistic"):
            # Balanced weights add up to the row count, so the penalty is the same.
            estimator = LogisticRegression(
                **columns,
                family="binomial",
                regParam=1.0 / (settings["C"] * total),
                elasticNetParam=0.0,
                standardization=False,
                maxIter=int(settings["max_iter"]),
            )
        elif family.startswith("random_forest"):
            depth = int(settings["max_depth"]) or DEEPEST
            forests = [
                RandomForestClassifier(
                    **columns,
                    numTrees=trees,
                    maxDepth=depth,
                    minInstancesPerNode=int(settings["min_samples_leaf"]),
                    featureSubsetStrategy="sqrt",
                    cacheNodeIds=True,
                    seed=SEED + 1_000_003 * i,
                ).fit(rows)
                for i, trees in enumerate(_tree_groups(int(settings["n_estimators"]), depth, total))
            ]
            return forests[0] if len(forests) == 1 else _one_forest(forests)
        else:
            estimator = GBTClassifier(
                **columns,
                stepSize=float(settings["learning_rate"]),
                maxIter=int(settings["max_iter"]),
                maxBins=BOOSTING_BINS,
                minInstancesPerNode=BOOSTING_LEAF_ROWS,
                maxDepth=BOOSTING_DEPTH,
                # Five steps from the root cost less than keeping every row's node through each level of each round.
                cacheNodeIds=False,
                seed=SEED,
            )
        return estimator.fit(rows)


def _tree_groups(trees: int, depth: int, rows: int) -> list[int]:
    """Sizes of the groups in which a forest is grown, each of at most ``NODES_TOGETHER`` nodes or one tree."""
    most = max(1, int(NODES_TOGETHER / max(1, min(NODES_PER_ROW * rows, 2 ** (depth + 1)))))
    many = -(-trees // most)
    return [trees // many + (i < trees % many) for i in range(many)]


def _one_forest(forests: Sequence[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """The forest of all trees of forests that were fitted on the same rows with other seeds."""
    first, trees = forests[0], [tree for forest in forests for tree in forest._java_obj.trees()]
    context = SparkContext._active_spark_context  # fits run in threads, which have no active session
    gateway, jvm = context._gateway, context._jvm
    java_trees = gateway.new_array(jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel, len(trees))
    for i, tree in enumerate(trees):
        java_trees[i] = tree
    made = jvm.org.apache.spark.ml.classification.RandomForestClassificationModel(
        first.uid, java_trees, first.numFeatures, first.numClasses
    )
    made.set(made.getParam("numTrees"), len(trees))  # the reader counts the trees of a saved forest by it
    forest = RandomForestClassificationModel(made)
    forest._resetUid(first.uid)
    for name in ("featuresCol", "labelCol"):
        forest._set(**{name: first.getOrDefault(name)})
    return forest


def _spread(rows: DataFrame, count: int) -> DataFrame:
    """``rows`` written once, in as many partitions as there are cores, or more.

    A fit of trees reads its rows several times before it keeps them, and every level is a job whose tasks each
    send statistics of all nodes; so neither one task nor very many should hold the rows.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return materialize(rows.repartition(max(cores, -(-count // PARTITION_ROWS))), "tree-rows")


def boosted_prefix(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model that fewer boosting rounds would have given: the first trees are the same."""
    if rounds >= model.getNumTrees:
        return model
    uid, trees, weights = model.uid, list(model._java_obj.trees())[:rounds], model.treeWeights[:rounds]
    context = SparkContext._active_spark_context  # fits run in threads, which have no active session
    gateway, jvm = context._gateway, context._jvm
    java_trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    java_weights = gateway.new_array(gateway.jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        java_trees[i], java_weights[i] = tree, weight
    made = jvm.org.apache.spark.ml.classification.GBTClassificationModel(uid, java_trees, java_weights)
    prefix = GBTClassificationModel(made)
    prefix._resetUid(uid)
    for name in ("featuresCol", "labelCol"):
        prefix._set(**{name: model.getOrDefault(name)})
    return prefix


def class_sizes(rows: DataFrame, label: str) -> dict[float, int]:
    """Rows per value of a 0/1 label."""
    counts = rows.where(F.col(label).isNotNull()).groupBy(label).count()
    return {
        float(row[label]): row["count"]
        for row in take_bounded(counts, 2, "classes of a 0/1 label")
    }


def classifier(family: str, settings: Mapping | None = None, label: str = "label"):
    return TabularClassifier(
        family=family, settings=json.dumps(dict(settings or {})), labelCol=label
    )


def split_groups(
    columns: Sequence[str], spec: TableSpec
) -> tuple[list[str], list[str], list[str]]:
    """Numeric, flag and category columns; derived columns count as numeric."""
    categorical = [c for c in columns if c in spec.categorical]
    binary = [c for c in columns if c in spec.binary]
    numeric = [c for c in columns if c not in spec.categorical and c not in spec.binary]
    return numeric, binary, categorical


def preprocessing_stages(
    columns: Sequence[str], spec: TableSpec, min_frequency: int = MIN_FREQUENCY
) -> list:
    """Stages from the final columns of a scenario to the vector ``features``."""
    numeric, binary, categorical = split_groups(columns, spec)
    stages, vectors = [], []
    for stage, names in (
        (MedianScaler(inputCols=numeric), numeric),
        (ModeImputer(inputCols=binary), binary),
        (RareOneHot(inputCols=categorical, minFrequency=min_frequency), categorical),
    ):
        if names:
            stages.append(stage)
            vectors += stage.outputs()
    return [*stages, VectorAssembler(inputCols=vectors, outputCol="features")]


def preprocessor(
    columns: Sequence[str], spec: TableSpec, min_frequency: int = MIN_FREQUENCY
) -> Pipeline:
    """Feature derivation and preprocessing without a model."""
    return Pipeline(
        stages=[RowFeatures.of(spec.roles), *preprocessing_stages(columns, spec, min_frequency)]
    )


def build_pipeline(
    columns: Sequence[str],
    spec: TableSpec,
    family: str,
    settings: Mapping | None = None,
    label: str = "label",
    min_frequency: int = MIN_FREQUENCY,
) -> Pipeline:
    """The whole pipeline for the final columns of a scenario."""
    prepared = preprocessor(columns, spec, min_frequency).getStages()
    return Pipeline(stages=[*prepared, classifier(family, settings, label)])
