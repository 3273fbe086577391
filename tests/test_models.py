from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskmill.operators import compare, stages
from riskmill.operators import models
from riskmill.operators.models import (
    build_pipeline,
    classifier,
    expand_grid,
    preprocessor,
    split_groups,
)
from riskmill.operators.scoring import score_record, score_table
from riskmill.sources.pipelines import ModelNotFoundError, load_pipeline, save_pipeline
from riskmill.spec import FeatureRoles, Scenario, TableSpec
from riskmill.streaming.scoring import score_stream

ROLES = FeatureRoles("e1", "a1", "v1", "g1", "x1", "e2", "a2", "g2", "x2")
SPEC = TableSpec(
    columns=("e1", "a1", "v1", "g1", "flag", "course"),
    categorical=("course",),
    binary=("flag",),
    target="y",
    positive="1",
    negative="0",
    ambiguous="",
    grades={},
    roles=ROLES,
    scenarios={
        "early_warning": Scenario(
            "early_warning", "Early", ("course", "flag", "e1", "a1", "v1", "g1", *ROLES.first_period)
        )
    },
)
COLUMNS = SPEC.scenarios["early_warning"].columns
SCHEMA = "row_id int, e1 int, a1 int, v1 int, g1 double, flag int, course string, label double"


def make_rows(n=120, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        enrolled = int(rng.integers(0, 8))
        approved = int(rng.integers(0, enrolled + 1))
        grade = float(round(rng.uniform(0, 20), 2)) if rng.random() > 0.1 else None
        flag = int(rng.integers(0, 2)) if rng.random() > 0.1 else None
        course = "rare" if i == 0 else "abc"[int(rng.integers(0, 3))]
        risk = 1.5 - 0.5 * approved + (0.5 if flag else 0) + rng.normal()
        rows.append((i, enrolled, approved, enrolled * 2, grade, flag, course, float(risk > 0)))
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(make_rows(), SCHEMA).repartition(3).cache()


def matrix(df, column):
    got = df.select("row_id", vector_to_array(column).alias("v")).orderBy("row_id").collect()
    return np.array([r["v"] for r in got])


@pytest.mark.parametrize("small_distinct", [1000, 0])
def test_median_scaler_matches_numpy(rows, small_distinct):
    model = stages.MedianScaler(inputCols=["g1", "e1"], smallDistinct=small_distinct).fit(rows)
    got = model.transform(rows).orderBy("row_id").collect()
    local = rows.orderBy("row_id").collect()
    for name in ("g1", "e1"):
        x = np.array([np.nan if r[name] is None else r[name] for r in local], float)
        x = np.where(np.isnan(x), np.nanmedian(x), x)
        want = (x - x.mean()) / x.std()
        assert np.allclose([r[f"{name}_num"] for r in got], want, atol=1e-10)


def test_median_scaler_constant_and_empty_columns(table):
    df = table("a double, b double", (3.0, None), (None, None))
    model = stages.MedianScaler(inputCols=["a", "b"]).fit(df)
    assert [tuple(r) for r in model.transform(df).select("a_num", "b_num").collect()] == [
        (0.0, 0.0), (0.0, 0.0)]


def test_imputation_without_scaling(table):
    df = table("a double", 1.0, 2.0, 4.0, 8.0, None)
    out = stages.MedianScaler(inputCols=["a"], scale=False).fit(df).transform(df)
    assert [r["a_num"] for r in out.collect()] == [1.0, 2.0, 4.0, 8.0, 3.0]


def test_mode_ties_take_the_smallest(table):
    df = table("f int, g int", (1, 5), (0, 5), (None, None))
    out = stages.ModeImputer(inputCols=["f", "g"]).fit(df).transform(df).collect()
    assert (out[2]["f_bin"], out[2]["g_bin"]) == (0.0, 5.0)


def test_one_hot_rare_unseen_and_missing(table):
    fit = table("c string", *["a"] * 12, *["b"] * 10, "x", "z", None)
    model = stages.RareOneHot(inputCols=["c"]).fit(fit)
    assert model.labels() == {"c": ["a", "b", stages.INFREQUENT]}
    new = table("c string", "a", "b", "z", "never seen", None)
    got = [list(r[0]) for r in model.transform(new).select(vector_to_array("c_cat")).collect()]
    assert got == [[1, 0, 0], [0, 1, 0], [0, 0, 1], [0, 0, 0], [1, 0, 0]]
    assert "c_cat_level" not in model.transform(new).columns


def test_one_hot_without_rare_levels(table):
    fit = table("c string", *["a"] * 10, *["b"] * 10)
    model = stages.RareOneHot(inputCols=["c"]).fit(fit)
    got = model.transform(table("c string", "b", "q")).select(vector_to_array("c_cat")).collect()
    assert [list(r[0]) for r in got] == [[0, 1], [0, 0]]


def test_one_hot_with_many_rare_levels(spark, tmp_path):
    """A long tail is looked up by a join and encodes like a short one."""
    fit = spark.range(400).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' else concat('v', id % 100) end as c"
    )
    short = stages.RareOneHot(inputCols=["c"]).fit(fit)
    long = stages.RareOneHot(inputCols=["c"], maxRare=10).fit(fit)
    new = fit.unionByName(spark.createDataFrame([(900, "unseen"), (901, None)], "id long, c string"))
    tables = [
        sorted((r["id"], tuple(r["v"])) for r in model.transform(new).select(
            "id", vector_to_array("c_cat").alias("v")).collect())
        for model in (short, long)
    ]
    assert tables[0] == tables[1] and len(tables[0]) == 402

    fitted = long.getOrDefault("rareTable")
    PipelineModel([long]).write().save(str(tmp_path / "saved"))
    loaded = PipelineModel.load(str(tmp_path / "saved")).stages[0]
    assert loaded.getOrDefault("rareTable").startswith(str(tmp_path / "saved")) and fitted not in repr(loaded.explainParams())
    again = loaded.transform(new).select("id", vector_to_array("c_cat").alias("v")).collect()
    assert sorted((r["id"], tuple(r["v"])) for r in again) == tables[0]


def test_prior_classifier(rows):
    model = stages.PriorClassifier(labelCol="label").fit(rows)
    share = rows.agg(F.avg("label")).first()[0]
    row = model.transform(rows).select(vector_to_array("probability").alias("p"), "prediction").first()
    assert row["p"][1] == pytest.approx(share) and row["prediction"] == float(share > 0.5)


def test_row_features_stage(rows, tmp_path):
    stage = stages.RowFeatures.of(ROLES)
    with pytest.raises(TypeError):
        stage.transform([1, 2])
    stage.save(str(tmp_path / "stage"))
    loaded = stages.RowFeatures.load(str(tmp_path / "stage"))
    out = loaded.transform(rows)
    assert out.columns == stage.output_names(rows.columns)
    assert set(ROLES.first_period) <= set(out.columns)


def test_preprocessing_has_no_gaps_and_learns_from_the_training_rows_only(rows):
    train = rows.where("row_id < 90")
    pipeline = preprocessor(COLUMNS, SPEC)
    model = pipeline.fit(train)
    changed = rows.withColumn("g1", F.when(F.col("row_id") >= 90, 1e6).otherwise(F.col("g1")))
    again = pipeline.fit(changed.where("row_id < 90"))
    one, two = (matrix(m.transform(train), "features") for m in (model, again))
    assert np.isfinite(one).all() and np.array_equal(one, two)
    names = stages.feature_names(model.transform(rows))
    assert sum(n.startswith("course_cat") for n in names) == 4  # a, b, c and the rare one
    assert split_groups(COLUMNS, SPEC)[0][:2] == ["e1", "a1"]


def newton(x, y, weights, c, steps=60):
    """Penalised logistic regression by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    beta, penalty = np.zeros(x.shape[1]), np.ones(x.shape[1])
    penalty[-1] = 0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = c * x.T @ (weights * (p - y)) + penalty * beta
        hessian = c * (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        beta -= np.linalg.solve(hessian, gradient)
    return beta


@pytest.mark.parametrize("family, c", [("logistic", 1.0), ("logistic_balanced", 0.1)])
def test_logistic_regression_parity(rows, family, c):
    features = preprocessor(COLUMNS, SPEC).fit(rows).transform(rows)
    model = classifier(family, {"C": c}).fit(features)
    x = matrix(features, "features")
    y = np.array([r["label"] for r in rows.orderBy("row_id").collect()])
    counts = {v: (y == v).sum() for v in (0.0, 1.0)}
    weights = np.array([len(y) / (2 * counts[v]) for v in y]) if "balanced" in family else np.ones(len(y))
    want = newton(x, y, weights, c)
    assert np.allclose(model.coefficients.toArray(), want[:-1], atol=1e-3)
    assert model.intercept == pytest.approx(want[-1], abs=1e-3)


@pytest.mark.parametrize("family, settings", [
    ("dummy_prior", {}), ("logistic", {}), ("logistic_balanced", {"C": 0.1}),
    ("random_forest", {"n_estimators": 5, "max_depth": 3}),
    ("random_forest_balanced", {"n_estimators": 5, "max_depth": 3}),
    ("hist_gradient_boosting", {"max_iter": 3}),
])
def test_every_family_saves_and_loads(rows, tmp_path, family, settings):
    model = build_pipeline(COLUMNS, SPEC, family, settings).fit(rows)
    path = str(tmp_path / family)
    save_pipeline(model, path)
    one, two = (
        sorted((r["row_id"], round(r["probability"], 12)) for r in
               score_table(m, rows, {}, keep=["row_id"]).collect())
        for m in (model, load_pipeline(path))
    )
    assert one == two and all(0 <= p <= 1 for _, p in one)


@pytest.mark.parametrize("family", ["random_forest", "random_forest_balanced"])
def test_a_large_forest_is_grown_by_groups_of_trees(rows, tmp_path, monkeypatch, family):
    grown, fit = [], models.RandomForestClassifier.fit
    monkeypatch.setattr(models.RandomForestClassifier, "fit", lambda self, df: grown.append((self.getNumTrees(), self.getSeed())) or fit(self, df))
    monkeypatch.setattr(models, "NODES_TOGETHER", int(3 * min(2**5, models.NODES_PER_ROW * rows.count())))
    model = build_pipeline(COLUMNS, SPEC, family, {"n_estimators": 7, "max_depth": 4}).fit(rows)
    assert [trees for trees, _ in grown] == [3, 2, 2] and len({seed for _, seed in grown}) == 3
    forest = model.stages[-1]
    assert forest.getNumTrees == 7 and len({t.toDebugString for t in forest.trees}) == 7
    parts = [(r["features"], r["probability"]) for r in model.transform(rows).select("features", "probability").collect()]
    for features, probability in parts[:20]:
        votes = sum(t.predictProbability(features).toArray() for t in forest.trees)
        assert np.allclose(probability.toArray(), votes / 7)
    save_pipeline(model, str(tmp_path / family))
    loaded = load_pipeline(str(tmp_path / family)).transform(rows).select("features", "probability").collect()
    assert sorted(p.tolist() for _, p in parts) == sorted(r["probability"].tolist() for r in loaded)


def test_groups_of_trees_keep_their_number_and_bound():
    for trees, depth, count in ((200, 30, 105_000), (200, 12, 105_000), (200, 30, 1_000), (3, 30, 10**8), (7, 2, 0)):
        groups = models._tree_groups(trees, depth, count)
        nodes = min(models.NODES_PER_ROW * count, 2 ** (depth + 1))
        assert sum(groups) == trees and min(groups) > 0
        assert max(groups) == 1 or max(groups) * nodes <= models.NODES_TOGETHER
    assert models._tree_groups(200, 30, 10_500) == [200]  # a small forest is grown as a whole


@pytest.mark.parametrize("family", ["random_forest", "hist_gradient_boosting"])
def test_many_rows_of_a_fit_of_trees_are_made_once(rows, monkeypatch, family):
    made = rows.sparkSession.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        made.add(1)
        return x

    features = preprocessor(COLUMNS, SPEC).fit(rows).transform(rows).select("features", counted("label").alias("label"))
    features = features.withColumn("features", F.when(F.col("label") >= 0, F.col("features")))
    small = {"n_estimators": 2, "max_depth": 2} if family == "random_forest" else {"max_iter": 2}
    monkeypatch.setattr(models, "SPREAD_ROWS", 0)
    monkeypatch.setattr(models, "class_sizes", lambda *_: {0.0: 1, 1.0: 1})  # counts the label, which is counted here
    classifier(family, small).fit(features)
    assert made.value == rows.count()


def test_missing_model(spark, tmp_path):
    with pytest.raises(ModelNotFoundError):
        load_pipeline(str(tmp_path / "absent"))


@pytest.fixture(scope="module")
def fitted(rows):
    model = build_pipeline(COLUMNS, SPEC, "logistic_balanced", {"C": 0.1}).fit(rows)
    kinds = dict(rows.dtypes)
    inputs = [c for c in COLUMNS if c in kinds]
    return model, {"input_columns": [[c, kinds[c]] for c in inputs], "decision_threshold": 0.35}


def test_scoring_contract(rows, fitted):
    model, metadata = fitted
    incoming = rows.drop("g1", "course").withColumn("extra", F.lit(1))
    out = score_table(model, incoming, metadata, keep=["row_id"]).collect()
    assert len(out) == rows.count()
    for row in out:
        assert 0 <= row["probability"] <= 1 and row["threshold"] == 0.35
        assert row["is_dropout_risk"] is (row["probability"] >= 0.35)
        assert row["risk_band"] in ("Baixo", "Moderado", "Alto")


def test_one_record_scores_like_a_table(spark, rows, fitted):
    model, metadata = fitted
    row = rows.where("row_id = 7").first().asDict()
    one = score_record(model, row, metadata, spark)
    many = score_table(model, rows.where("row_id = 7"), metadata).first()
    assert one["probability"] == pytest.approx(many["probability"])
    assert score_record(model, {}, metadata, spark)["risk_band"]


def test_unseen_level_scores(table, fitted):
    model, metadata = fitted
    df = table("course string, flag int", ("never seen", 1))
    assert 0 <= score_table(model, df, metadata).first()["probability"] <= 1


def test_stream_scores_like_a_batch(spark, rows, fitted, tmp_path):
    model, metadata = fitted
    save_pipeline(model, str(tmp_path / "model"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = score_stream(
        spark, str(tmp_path / "in"), rows.schema, load_pipeline(str(tmp_path / "model")),
        metadata, keep=["row_id"],
    )
    query = stream.writeStream.format("memory").queryName("scored_stream").start()
    query.processAllAvailable()
    query.stop()
    batch = score_table(model, rows, metadata, keep=["row_id"])
    assert sorted(spark.table("scored_stream").collect()) == sorted(batch.collect())


def test_expand_grid_order():
    assert expand_grid({"a": (1, 2), "b": (3, 4)}) == [
        {"a": 1, "b": 3}, {"a": 1, "b": 4}, {"a": 2, "b": 3}, {"a": 2, "b": 4}]
    assert expand_grid({}) == [{}]


@pytest.fixture(scope="module")
def training(rows):
    return compare.prepare_training(
        rows.withColumn("target", F.col("label").cast("int")), SPEC, "early_warning", "target",
        "row_id", folds=3, parallelism=2, fold_parallelism=3,
    )


def test_cross_validation_against_a_plain_loop(training):
    candidate = compare.Candidate("lr", "logistic", {"C": 1.0})
    scores = compare.cross_validation_scores(training, [candidate]).collect()
    assert len(scores) == 120 * 3
    held_out = [r for r in scores if r["part"] == "validation"]
    assert len({r["row_id"] for r in held_out}) == 120
    summary = {r["metric"]: r for r in compare.cross_validate(training, [candidate]).collect()}
    accuracies = [
        np.mean([r["y"] == r["predicted"] for r in held_out if r["fold"] == f]) for f in range(3)
    ]
    assert summary["accuracy"]["cv_mean"] == pytest.approx(np.mean(accuracies))
    assert summary["accuracy"]["cv_std"] == pytest.approx(np.std(accuracies))
    assert set(summary) == {"accuracy", "precision", "recall", "f1", "f2", "roc_auc"}


def test_out_of_fold_scores_come_from_other_rows(training):
    """Refitting by hand without the fold gives the same scores."""
    candidate = compare.Candidate("lr", "logistic", {"C": 1.0})
    got = {r["row_id"]: r["score"] for r in compare.out_of_fold_scores(training, candidate).collect()}
    model = build_pipeline(training.columns, SPEC, "logistic", {"C": 1.0}).fit(
        training.rows.where("fold <> 1"))
    mine = score_table(model, training.rows.where("fold = 1"), {}, keep=["row_id"]).collect()
    assert mine and all(got[r["row_id"]] == pytest.approx(r["probability"], abs=1e-6) for r in mine)


def test_grid_search_keeps_the_first_of_equals(training):
    result = compare.grid_search(training, "logistic", {"C": (0.1, 0.1, 1.0)})
    assert len(result.scores) == 3
    assert result.scores[0][1] == pytest.approx(result.scores[1][1])
    best = max(score for _, score in result.scores)
    first = next(point for point, score in result.scores if score == best)
    assert result.settings == first


def test_threshold_and_curves(training):
    candidate = compare.Candidate("lr", "logistic_balanced", {"C": 0.1})
    threshold, table = compare.tune_threshold(compare.out_of_fold_scores(training, candidate))
    rows = {r["threshold"]: r["f2"] for r in table.collect()}
    assert len(rows) == 9 and rows[threshold] == max(rows.values())
    curve = compare.learning_curve(training, candidate, (0.5, 1.0)).collect()
    assert [r["train_size"] for r in curve] == [40, 80]
    full = compare.cross_validate(training, [candidate]).where("metric = 'f2'").first()
    assert curve[1]["cv_mean"] == pytest.approx(full["cv_mean"], abs=1e-9)
    assert curve[1]["gap"] == pytest.approx(full["gap"], abs=1e-9)
    points = compare.validation_curve(training, "logistic_balanced", "C", (0.1, 1.0), {}).collect()
    assert [r["param_value"] for r in points] == ["0.1", "1.0"]
    assert points[0]["cv_mean"] == pytest.approx(full["cv_mean"], abs=1e-9)


def test_compare_and_final_model(spark, rows, tmp_path):
    from riskmill.operators.final_model import build_final_model
    from riskmill.sources.reports import read_metadata
    from riskmill.sources.splits import load_or_create_split
    from riskmill.sources.tables import RESULT_SCHEMA, read_results, save_results

    df = rows.withColumns({
        "target": F.col("label").cast("int"),
        "target_excl_enrolled": F.when(F.col("row_id") % 4 > 0, F.col("label").cast("int")),
    })
    split = load_or_create_split(df, str(tmp_path / "split"), "target", "row_id", test_size=0.3).ids
    table = compare.compare_models(
        df, SPEC, "row_id", split, models=("dummy_prior", "logistic"), folds=2,
        grids={"logistic": {"C": (0.1, 1.0)}}, fold_parallelism=2,
    )
    turned = df.join(split, "row_id").withColumns({
        name: F.when(F.col("part") == "test", 1 - F.col(name)).otherwise(F.col(name))
        for name in ("target", "target_excl_enrolled")
    }).drop("part")
    plain = [
        compare.compare_models(rows_of, SPEC, "row_id", split, models=("dummy_prior",), tune=False, folds=2).collect()
        for rows_of in (df, turned)
    ]
    assert sorted(map(repr, plain[0])) == sorted(map(repr, plain[1]))
    save_results(table, str(tmp_path / "results.csv"))
    results = read_results(spark, str(tmp_path / "results.csv"))
    assert results.columns == spark.createDataFrame([], RESULT_SCHEMA).columns
    stages_seen = {(r["target"], r["stage"]) for r in results.collect()}
    assert stages_seen == {
        ("principal", "default"), ("principal", "tuned"), ("sensibilidade", "default")}
    assert results.count() == (2 + 2 + 2) * 6
    tuned = results.where("stage = 'tuned' and model = 'logistic'").first()
    assert json.loads(tuned["best_params"])["C"] in ("0.1", "1.0")

    final = build_final_model(
        df, SPEC, results, "row_id", split, str(tmp_path / "final"), grid={"C": (0.1, 1.0)}, folds=2,
        curve_shares=(1.0,), curve_c=(0.1, 1.0), fold_parallelism=2,
    )
    metadata = read_metadata(spark, str(tmp_path / "final/model_metadata.json"))
    assert metadata["model_name"] == "logistic" and metadata["n_features"] == len(COLUMNS)
    assert metadata["split"] == {"n_train": 84, "n_test": 36}
    assert {r["level"] for r in final.levels.collect()} == {"train", "cv", "test"}
    assert set(final.curves) == {"learning", "validation"}
    for name, kept in {"thresholds": final.thresholds, "learning_curve": final.curves["learning"],
                       "validation_curve": final.curves["validation"]}.items():
        saved = spark.read.parquet(str(tmp_path / "final" / name))
        assert saved.columns == kept.columns and saved.count() == kept.count() > 0
    loaded = PipelineModel.load(str(tmp_path / "final/model"))
    scored = score_table(loaded, rows, metadata, keep=["row_id"])
    assert scored.count() == 120


def test_stage_pipeline_round_trip(rows, tmp_path):
    pipeline = Pipeline(stages=[stages.MedianScaler(inputCols=["g1"])])
    pipeline.save(str(tmp_path / "unfitted"))
    loaded = Pipeline.load(str(tmp_path / "unfitted"))
    assert loaded.fit(rows).stages[0].statistics() == pipeline.fit(rows).stages[0].statistics()


def test_model_queries_take_every_model(spark, small, monkeypatch):
    import inspect

    from riskmill.operators import compare
    from riskmill.plans import model_queries

    seen = {}
    default = inspect.signature(compare.compare_models).parameters["models"].default
    monkeypatch.setattr(compare, "compare_models", lambda *args, **options: seen.update(options))
    monkeypatch.setattr(compare, "cross_validate", lambda training, candidates: seen.update(candidates=candidates))
    monkeypatch.setattr(model_queries, "_training", lambda spark, sf_dir: None)
    model_queries.model_comparison(spark, small)
    model_queries.cv_scores(spark, small)
    assert set(seen.get("models", default)) == set(compare.MODELS) and len(compare.MODELS) == 6
    assert sorted(c.family for c in seen["candidates"]) == sorted(compare.MODELS)


def test_boosting_prefixes_equal_separate_fits(training):
    """Candidates that differ in rounds share one fit and score as if fitted alone."""
    points = [compare.Candidate(f"gbt{n}", "hist_gradient_boosting", {"max_iter": n}) for n in (2, 5)]
    assert [len(g) for g in compare._fit_groups(points)] == [2]
    together = {(r["candidate"], r["fold"], r["row_id"]): r["score"] for r in compare.cross_validation_scores(training, points).collect()}
    for point in points:
        alone = compare.cross_validation_scores(training, [point]).collect()
        assert len(alone) == 360
        assert all(together[r["candidate"], r["fold"], r["row_id"]] == r["score"] for r in alone)


def test_scenarios_share_features_and_equal_separate_fits(rows):
    """A candidate on some columns of a wider training scores as on a training of its own."""
    df = rows.withColumn("target", F.col("label").cast("int"))
    own = compare.prepare_training(df, SPEC, "early_warning", "target", "row_id", folds=2)
    part = tuple(c for c in own.columns if c not in SPEC.categorical[:1])
    candidates = [compare.Candidate("all", "logistic", {"C": 1.0}), compare.Candidate("some", "logistic", {"C": 1.0}, part)]
    together = compare.fold_metrics(compare.score_counts(own, candidates)).collect()
    narrow = compare.replace(own, columns=part)
    alone = [r for t, c in ((own, candidates[0]), (narrow, compare.Candidate("some", "logistic", {"C": 1.0})))
             for r in compare.fold_metrics(compare.cross_validation_scores(t, [c])).collect()]
    key = lambda r: (r["candidate"], r["fold"], r["part"])
    assert len(together) == len(alone) == 8
    for a, b in zip(sorted(together, key=key), sorted(alone, key=key)):
        assert key(a) == key(b) and all(a[m] == pytest.approx(b[m], abs=1e-9) for m in ("f2", "accuracy", "roc_auc", "tp", "fn"))


def test_learning_curve_prepares_each_fold_once(training, monkeypatch):
    calls = []
    real = compare.fit_unions
    monkeypatch.setattr(compare, "fit_unions", lambda *a: calls.append(len(a[-1])) or real(*a))
    candidate = compare.Candidate("lr", "logistic_balanced", {"C": 0.1})
    curve = compare.learning_curve(training, candidate, (0.4, 0.6, 1.0)).collect()
    assert calls == [3] * training.folds
    sizes = [r["train_size"] for r in curve]
    assert sizes == [32, 48, 80]
    means = []
    for holdout in range(3):
        others = training.rows.where(F.col("fold") != holdout).orderBy("row_id").limit(48)
        model = build_pipeline(training.columns, SPEC, "logistic_balanced", {"C": 0.1}).fit(others)
        scored = model.transform(training.rows.where(F.col("fold") == holdout))
        hits = {(r["label"], r["prediction"]): r["count"] for r in scored.groupBy("label", "prediction").count().collect()}
        tp, fp, fn = hits.get((1.0, 1.0), 0), hits.get((0.0, 1.0), 0), hits.get((1.0, 0.0), 0)
        means.append(5 * tp / (5 * tp + 4 * fn + fp))
    assert curve[1]["cv_mean"] == pytest.approx(np.mean(means), abs=1e-9)


def test_a_forest_is_scored_alone_and_dropped(training, monkeypatch):
    forest = [compare.Candidate(f"rf{n}", "random_forest", {"n_estimators": n, "max_depth": 2}) for n in (2, 3)]
    candidates = [*forest, compare.Candidate("prior", "dummy_prior")]
    real, calls = compare._with_outcomes, []
    monkeypatch.setattr(compare, "_with_outcomes", lambda rows, models, keep: calls.append(sorted(models)) or real(rows, models, keep))
    few = compare.replace(training, rows=training.rows.withColumn("fold", training.rows["fold"] % 2), folds=2)
    rows = compare.cross_validation_scores(few, candidates).collect()
    assert sorted(calls) == sorted([["prior"], ["rf2"], ["rf3"]] * 2)
    together = {(r["candidate"], r["fold"], r["row_id"]): r["score"] for r in rows}
    assert len(together) == len(rows) == len(candidates) * 2 * training.rows.count()
    alone = compare.cross_validation_scores(few, forest[1:]).collect()
    assert {k: v for k, v in together.items() if k[0] == "rf3"} == {("rf3", r["fold"], r["row_id"]): r["score"] for r in alone}


def test_fits_of_folds_are_kept_for_the_next_call(training, monkeypatch):
    """A candidate of a grid search is not fitted again to get its scores, which are those of a fresh training."""
    fresh = lambda: compare.replace(training, folds=training.folds)
    own, fits, unions = fresh(), [], []
    real, real_unions = compare._fit_group, compare.fit_unions
    monkeypatch.setattr(compare, "_fit_group", lambda group, *a: fits.append(group[0].settings) or real(group, *a))
    monkeypatch.setattr(compare, "fit_unions", lambda *a: unions.append(1) or real_unions(*a))
    best = compare.grid_search(own, "logistic_balanced", {"C": (0.1, 10.0)}).settings
    assert len(fits) == 2 * training.folds and len(unions) == 1
    chosen = [compare.Candidate("chosen", "logistic_balanced", best)]
    key = lambda r: (r["fold"], r["row_id"])
    found = sorted(compare.cross_validation_scores(own, chosen).collect(), key=key)
    assert len(fits) == 2 * training.folds and len(unions) == 1  # nothing was fitted again
    again = sorted(compare.cross_validation_scores(fresh(), chosen).collect(), key=key)
    assert found == again and len(fits) == 3 * training.folds and len(unions) == 2
    compare.cross_validation_scores(own, [compare.Candidate("other", "logistic_balanced", {"C": 1.0})])
    assert len(fits) == 4 * training.folds  # other settings are
    assert not compare.replace(own, label="label").fits


def test_learning_curve_bounds_what_its_fits_keep(training, monkeypatch):
    candidate = compare.Candidate("lr", "logistic_balanced", {"C": 0.1})
    wide = compare.replace(training, parallelism=4)
    at_once, kept, real, persist = [], [], compare.run_together, type(training.rows).persist
    monkeypatch.setattr(compare, "run_together", lambda tasks, most, spark: at_once.append(most) or real(tasks, most, spark))
    monkeypatch.setattr(type(training.rows), "persist", lambda self, *level: kept.append(level) or persist(self, *level))
    whole = compare.learning_curve(wide, candidate, (0.5, 1.0)).collect()
    assert at_once == [3, 4] and (compare.StorageLevel.DISK_ONLY,) not in kept
    at_once.clear()
    kept.clear()
    each = compare._feature_bytes(80, len(preprocessor(COLUMNS, SPEC).getStages()[-1].getInputCols()))
    monkeypatch.setattr(compare, "TOGETHER_BYTES", each)
    assert compare.learning_curve(wide, candidate, (0.5, 1.0)).collect() == whole
    assert at_once == [1, 1] and kept.count((compare.StorageLevel.DISK_ONLY,)) == 6
