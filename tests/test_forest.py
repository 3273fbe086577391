from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskmill.operators import compare, forest, models
from riskmill.sources.pipelines import load_pipeline, save_pipeline
from tests.test_models import COLUMNS, SPEC, rows, training  # noqa: F401 (fixtures)


def plain_tree(bins, labels, copies, depth, least, weights):
    """The same tree by recursion over all features and cuts; a leaf is (share, class), a node (feature, cut, left, right)."""

    def counts(at):
        ones = int(copies[at][labels[at] == 1].sum())
        return int(copies[at].sum()) - ones, ones

    def worth(zeros, ones):
        a, b = zeros * weights[0], ones * weights[1]
        return (a * a + b * b) / (a + b) if a + b else 0.0

    def leaf(zeros, ones):
        a, b = zeros * weights[0], ones * weights[1]
        return (b / (a + b), int(b > a))

    def below(at, level):
        zeros, ones = counts(at)
        best = (worth(zeros, ones) + 1e-9, None)
        if level < depth and zeros and ones:
            for f in range(len(bins)):
                for cut in range(int(bins[f].max())):
                    side = bins[f][at] <= cut
                    one, two = counts(at[side]), counts(at[~side])
                    if min(sum(one), sum(two)) >= least and worth(*one) + worth(*two) > best[0]:
                        best = (worth(*one) + worth(*two), (f, cut, side))
        if best[1] is None:
            return leaf(zeros, ones)
        f, cut, side = best[1]
        left, right = below(at[side], level + 1), below(at[~side], level + 1)
        if len(left) == len(right) == 2 and left[1] == right[1]:
            return leaf(zeros, ones)
        return (f, cut, left, right)

    return below(np.flatnonzero(copies), 0)


def plain_share(tree, row):
    while len(tree) == 4:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0]


@pytest.mark.parametrize("depth, least, weights", [(30, 1, (1.0, 1.0)), (30, 5, (1.0, 1.0)), (4, 1, (0.6, 2.5)), (3, 3, (1.0, 1.0))])
@pytest.mark.parametrize("count", [60, 700])
def test_a_grown_tree_is_the_plain_one(depth, least, weights, count):
    rng = np.random.default_rng(count + depth)
    bins = np.concatenate([rng.integers(0, 32, (2, count)), rng.integers(0, 2, (3, count))]).astype(np.uint8)
    labels = ((bins[0] > 11) ^ (rng.random(count) < 0.25)).astype(np.uint8)
    copies = forest.copies_of(np.arange(count, dtype=np.uint64), 3, 42)
    used = np.flatnonzero(copies)
    tree = forest.grow(bins[:, used], labels[used], copies[used], 5, depth, least, weights, np.random.default_rng(0))
    share = tree["share"][forest.walk(tree, bins, np.arange(count))]
    plain = plain_tree(bins, labels, copies, depth, least, weights)
    assert np.allclose(share, [plain_share(plain, row) for row in bins.T], atol=1e-12)
    inner = int((tree["left"] >= 0).sum())
    assert len(tree["left"]) == 2 * inner + 1 and len(tree["share"]) == inner + 1


def test_bounds_lie_between_values():
    assert forest.bounds_of(np.array([0.0, 1.0, 1.0, 4.0])) == [0.5, 2.5]
    assert forest.bounds_of(np.array([3.0, 3.0])) == []
    many = forest.bounds_of(np.arange(3200.0))
    assert len(many) == 31 and np.allclose(np.diff([-0.5, *many, 3199.5]), 100, atol=1)


def test_every_tree_draws_its_own_rows():
    numbers = np.arange(200_000, dtype=np.uint64)
    one, two = forest.copies_of(numbers, 0, 42), forest.copies_of(numbers, 1, 42)
    assert abs(one.mean() - 1) < 0.01 and abs((one == 0).mean() - np.exp(-1)) < 0.01 and abs(one.var() - 1) < 0.03
    assert abs(np.corrcoef(one, two)[0, 1]) < 0.01 and (one == forest.copies_of(numbers, 0, 42)).all()


@pytest.fixture
def two_features(spark):
    """Two features, so that every node draws both and a tree does not depend on the order of its nodes."""
    rng = np.random.default_rng(8)
    x = rng.integers(0, 40, (900, 2)) / 4
    y = ((x[:, 0] + x[:, 1] > 9) ^ (rng.random(900) < 0.2)).astype(float)
    made = spark.createDataFrame([(i, a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y))], "row_id int, x array<double>, label double")
    return made.withColumn("features", array_to_vector("x")).drop("x").repartition(3, "row_id").cache()


def shares(model, df):
    scored = model.transform(df).select("row_id", vector_to_array("probability")[1].alias("p"), "prediction").orderBy("row_id").collect()
    assert all(r["prediction"] == float(r["p"] > 0.5) for r in scored)
    return [r["p"] for r in scored]


@pytest.mark.parametrize("least, depth", [(1, 0), (4, 5)])
def test_nodes_of_many_rows_are_split_by_all_tasks(two_features, monkeypatch, least, depth):
    """A forest whose nodes of over 60 rows are split with added histograms is the one that is grown tree by tree."""
    monkeypatch.setattr(models, "FOREST_ROWS", 0)
    settings = {"n_estimators": 4, "min_samples_leaf": least, "max_depth": depth}
    whole = models.classifier("random_forest_balanced", settings).fit(two_features)
    monkeypatch.setattr(forest, "NODE_BYTES", 60 * 4)
    parts = models.classifier("random_forest_balanced", settings).fit(two_features)
    spark = two_features.sparkSession
    assert len(list(forest._trees(forest._reachable(spark, parts.getOrDefault("path"))))) > 4 * 4
    assert np.allclose(shares(whole, two_features), shares(parts, two_features))


@pytest.mark.parametrize("family", ["random_forest", "random_forest_balanced"])
def test_a_forest_on_many_rows_is_a_table_of_trees(rows, tmp_path, monkeypatch, family):  # noqa: F811
    """The driver neither grows nor holds it; it saves, loads and scores the same in another fit."""
    monkeypatch.setattr(models, "FOREST_ROWS", 50)
    monkeypatch.setattr(models.RandomForestClassifier, "fit", lambda self, df: pytest.fail("grown by the driver"))
    pipeline = models.build_pipeline(COLUMNS, SPEC, family, {"n_estimators": 7})
    model = pipeline.fit(rows)
    grown = model.stages[-1]
    assert grown.getNumTrees == 7 and "trees-" in grown.getOrDefault("path")
    ready = model.transform(rows)
    assert {"features", "rawPrediction", "probability", "prediction"} <= set(ready.columns)
    found = shares(model, rows)
    assert len(set(found)) > 20 and found == shares(pipeline.fit(rows), rows)  # the same in another fit
    label = [r["label"] for r in rows.orderBy("row_id").collect()]
    assert np.mean((np.array(found) > 0.5) == label) > 0.85
    save_pipeline(model, str(tmp_path / family))
    grown.release(rows.sparkSession)
    assert shares(load_pipeline(str(tmp_path / family)), rows) == found


def test_trees_are_dropped_once_scored(training, monkeypatch):  # noqa: F811
    monkeypatch.setattr(models, "FOREST_ROWS", 50)
    released, real = [], forest.GrownForestModel.release
    monkeypatch.setattr(forest.GrownForestModel, "release", lambda self, spark: released.append(self.getNumTrees) or real(self, spark))
    candidates = [compare.Candidate("rf", "random_forest", {"n_estimators": 3}), compare.Candidate("prior", "dummy_prior")]
    scores = compare.cross_validation_scores(training, candidates)
    assert released == [3] * training.folds
    assert scores.where("candidate = 'rf'").count() == 120 * 3 and scores.where(F.col("score").isNull()).count() == 0


def test_files_of_other_stores_are_fetched_by_spark(spark, monkeypatch):
    added = []
    monkeypatch.setattr(type(spark.sparkContext), "addFile", lambda self, path, recursive=False: added.append(path))
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.inputFiles", lambda self: ["hdfs://a/trees/part-0.parquet"])
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameReader.parquet", lambda self, path: spark.range(1))
    assert forest._reachable(spark, "hdfs://a/trees") == ["fetched:part-0.parquet"] and added == ["hdfs://a/trees/part-0.parquet"]
