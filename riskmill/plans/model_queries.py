"""Queries for fitted statistics, preprocessing, models and scoring."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskmill.functions.durable import materialize
from riskmill.operators import compare, final_model, stages
from riskmill.operators.models import build_pipeline, preprocessor
from riskmill.operators.scenarios import resolve_scenario
from riskmill.operators.scoring import score_table
from riskmill.operators.split import stratified_split
from riskmill.plans import views
from riskmill.plans.metric_queries import _folds_sql, _split_sql
from riskmill.plans.registry import query, r, shown
from riskmill.plans.views import SQL_GAPPY, SQL_SCORED, UNITS
from riskmill.spec import CURVE_C

NUMBERS = ("num_admission", "enrolled_1", "grade_1")

# --- fitted statistics -----------------------------------------------------


def _fit_sql(column: str) -> str:
    filled = f"coalesce({column}, (select median({column}) from gappy))"
    return f"""select '{column}' as column_name,
    {r(f'(select median({column}) from gappy)')} as median,
    {r(f'avg({filled})')} as mean, {r(f'stddev_pop({filled})')} as std from gappy"""


@query(
    "fit_stats",
    f"with {SQL_GAPPY} {' union all '.join(_fit_sql(c) for c in NUMBERS)}",
)
def fit_stats(spark, sf_dir):
    """Median of the present values, mean and deviation after imputation."""
    gappy = views.gappy_units(spark, sf_dir, customers=False)
    fitted = stages.MedianScaler(inputCols=list(NUMBERS)).fit(gappy).statistics()
    rows = [(c, s["median"], s["mean"], s["std"]) for c, s in zip(NUMBERS, fitted)]
    schema = "column_name string, median double, mean double, std double"
    return shown(spark.createDataFrame(rows, schema))


def _scaled_sql(column: str) -> str:
    filled = f"coalesce({column}, (select median({column}) from gappy))"
    return f"""{r(f'({filled} - (select avg({filled}) from gappy)) / '
                  f'(select stddev_pop({filled}) from gappy)')} as {column}_num"""


@query(
    "impute_scale",
    f"with {SQL_GAPPY} select unit_id, {', '.join(_scaled_sql(c) for c in NUMBERS)} from gappy",
)
def impute_scale(spark, sf_dir):
    gappy = views.gappy_units(spark, sf_dir, customers=False)
    model = stages.MedianScaler(inputCols=list(NUMBERS)).fit(gappy)
    return shown(model.transform(gappy).select("unit_id", *model.outputs()))


@query(
    "impute_mode",
    f"""with {SQL_GAPPY} select unit_id, cast(coalesce(bin_debtor, (select bin_debtor from gappy
      where bin_debtor is not null group by bin_debtor order by count(*) desc, bin_debtor limit 1))
      as double) as bin_debtor_bin from gappy""",
)
def impute_mode(spark, sf_dir):
    gappy = views.gappy_units(spark, sf_dir)
    model = stages.ModeImputer(inputCols=["bin_debtor"]).fit(gappy)
    return model.transform(gappy).select("unit_id", "bin_debtor_bin")


_LEVELS_SQL = """d as (select doc_id, nullif(concat(lang, '_', source), 'en_web') as level
      from documents),
    mode as (select level from d where level is not null group by level
      order by count(*) desc, level limit 1),
    filled as (select doc_id, coalesce(level, (select level from mode)) as level from d),
    counts as (select level, count(*) as n from filled group by level)"""


def _documents(spark, sf_dir):
    level = F.concat(F.col("lang"), F.lit("_"), F.col("source"))
    return views.table(spark, sf_dir, "documents").select(
        "doc_id", F.nullif(level, F.lit("en_web")).alias("level")
    )


@query(
    "level_counts",
    f"""with {_LEVELS_SQL} select 'level' as column_name, level as value, count(*) as n
    from d group by level""",
)
def level_counts(spark, sf_dir):
    return stages.level_counts(_documents(spark, sf_dir), ["level"])


@query(
    "onehot_rare",
    f"""with {_LEVELS_SQL}, slots as (select level, case when n >= 10 then level
      else '{stages.INFREQUENT}' end as slot from counts)
    select doc_id, slot from filled join slots using (level)""",
)
def onehot_rare(spark, sf_dir):
    """The slot of every document's level, read back from its one-hot vector."""
    documents = _documents(spark, sf_dir)
    model = stages.RareOneHot(inputCols=["level"]).fit(documents)
    labels = F.array(*[F.lit(label) for label in model.labels()["level"]])
    place = F.array_position(vector_to_array("level_cat"), F.lit(1.0)).cast("int")
    return model.transform(documents).select("doc_id", F.element_at(labels, place).alias("slot"))


@query(
    "dummy_prior",
    f"""with {SQL_SCORED} select unit_id, {r('(select avg(y) from scored)')} as probability,
    0.0::double as prediction from scored""",
)
def dummy_prior(spark, sf_dir):
    rows = views.scored(spark, sf_dir).select("unit_id", F.col("y").cast("double").alias("label"))
    model = stages.PriorClassifier(labelCol="label").fit(rows)
    return shown(
        model.transform(rows).select(
            "unit_id", vector_to_array("probability")[1].alias("probability"), "prediction"
        )
    )


# --- pipelines -------------------------------------------------------------


def _labelled(spark, sf_dir):
    """Prepared units with gaps, written once because many jobs read them."""
    status = F.col("target_raw")
    rows = views.gappy_units(spark, sf_dir).withColumns(
        {
            "target": F.when(status == "P", 1).otherwise(0),
            "target_excl_enrolled": F.when(status == "P", 1).when(status == "F", 0),
            "label": F.when(status == "P", 1.0).otherwise(0.0),
        }
    )
    return materialize(rows, "labelled")


def _early(rows):
    return resolve_scenario(rows, views.EARLY, UNITS.roles)


@query("preprocess_matrix")
def preprocess_matrix(spark, sf_dir):
    """The feature matrix, with statistics of the training side only."""
    rows = _labelled(spark, sf_dir)
    train, test = compare.train_and_test(rows, "label", "unit_id")
    _, final = _early(rows)
    model = preprocessor(final, UNITS).fit(train)
    both = train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )
    return model.transform(both).select(
        "unit_id", "part", vector_to_array("features").alias("features")
    )


def _train_scaled_sql(column: str) -> str:
    filled = f"coalesce({column}, (select median({column}) from train))"
    return f"""{r(f'({filled} - (select avg({filled}) from train)) / (select stddev_pop({filled}) from train)')}
      as {column}_num"""


_LABELLED_SQL = f"""{SQL_GAPPY}, labelled as (select *, case when target_raw = 'P' then 1 else 0 end as y from gappy)"""
_TRAIN_NUMBERS = ("num_admission", "enrolled_1", "approved_1", "evaluations_1", "grade_1", "no_eval_1")


@query(
    "preprocess_numbers",
    f"""with {_LABELLED_SQL}, {_split_sql('labelled', 'y')}, train as (select * from parts where part = 'train')
    select unit_id, part, {', '.join(_train_scaled_sql(c) for c in _TRAIN_NUMBERS)},
      cast(coalesce(bin_debtor, (select bin_debtor from train where bin_debtor is not null
        group by bin_debtor order by count(*) desc, bin_debtor limit 1)) as double) as bin_debtor_bin
    from parts""",
)
def preprocess_numbers(spark, sf_dir):
    """Numbers and flags of both sides, with statistics of the training side only."""
    rows = _labelled(spark, sf_dir)
    train, test = compare.train_and_test(rows, "label", "unit_id", method="md5")
    _, final = _early(rows)
    model = preprocessor(final, UNITS).fit(train)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    columns = [f"{c}_num" for c in _TRAIN_NUMBERS]
    return shown(model.transform(both).select("unit_id", "part", *columns, "bin_debtor_bin"))


def _scores(spark, sf_dir, family, settings):
    rows = _labelled(spark, sf_dir)
    train, test = compare.train_and_test(rows, "label", "unit_id")
    inputs, final = _early(rows)
    model = build_pipeline(final, UNITS, family, settings).fit(train)
    kinds = dict(rows.dtypes)
    metadata = {"input_columns": [[c, kinds[c]] for c in inputs], "decision_threshold": 0.4}
    return score_table(model, test, metadata, keep=["unit_id"])


@query("pipeline_fit")
def pipeline_fit(spark, sf_dir):
    return _scores(spark, sf_dir, "logistic", {})


@query("lr_scores")
def lr_scores(spark, sf_dir):
    return _scores(spark, sf_dir, "logistic", {"C": 10.0})


@query("lr_balanced_scores")
def lr_balanced_scores(spark, sf_dir):
    return _scores(spark, sf_dir, "logistic_balanced", {"C": 0.1})




@query("rf_scores")
def rf_scores(spark, sf_dir):
    return _scores(spark, sf_dir, "random_forest", {})


@query("rf_balanced_scores")
def rf_balanced_scores(spark, sf_dir):
    return _scores(spark, sf_dir, "random_forest_balanced", {})


@query("gbt_scores")
def gbt_scores(spark, sf_dir):
    return _scores(spark, sf_dir, "hist_gradient_boosting", {})


@query("score_batch")
def score_batch(spark, sf_dir):
    """Rows with an absent and an extra column, scored by a balanced model."""
    rows = _labelled(spark, sf_dir)
    inputs, final = _early(rows)
    model = build_pipeline(final, UNITS, "logistic_balanced", {"C": 0.1}).fit(rows)
    kinds = dict(rows.dtypes)
    metadata = {"input_columns": [[c, kinds[c]] for c in inputs], "decision_threshold": 0.4}
    incoming = rows.drop("grade_1").withColumn("extra", F.lit(1))
    return score_table(model, incoming, metadata, keep=["unit_id"])


# --- comparison ------------------------------------------------------------


def _training(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    train, _ = compare.train_and_test(rows, "target", "unit_id")
    return compare.prepare_training(
        train, UNITS, "early_warning", "target", "unit_id", parallelism=4, fold_parallelism=5
    )


_BALANCED = compare.Candidate("logistic_balanced", "logistic_balanced", {"C": 0.1})


@query("cv_scores")
def cv_scores(spark, sf_dir):
    others = [compare.Candidate(name, name) for name in compare.MODELS if name != _BALANCED.family]
    return compare.cross_validate(_training(spark, sf_dir), [*others, _BALANCED])


_PRIOR = compare.Candidate("prior", "dummy_prior")
_PRIOR_SQL = f"""with {SQL_SCORED}, {_folds_sql('scored', 'y')},
    counts as (select fold, count(*) as n, sum(y) as p from folds group by fold),
    priors as (select fold, (sum(p) over () - p) / (sum(n) over () - n) as score from counts)"""


def _md5_training(spark, sf_dir):
    """All labelled units, in folds that SQL can reproduce."""
    return compare.prepare_training(
        _labelled(spark, sf_dir), UNITS, "early_warning", "target", "unit_id", fold_parallelism=5, method="md5"
    )


@query(
    "oof_prior",
    f"""{_PRIOR_SQL} select unit_id, fold, y, {r('score')} as score,
      case when score > 0.5 then 1 else 0 end as predicted from folds join priors using (fold)""",
)
def oof_prior(spark, sf_dir):
    """Out-of-fold scores of the class shares: each row's score comes from the other folds."""
    return shown(compare.out_of_fold_scores(_md5_training(spark, sf_dir), _PRIOR))


@query(
    "cv_prior",
    f"""{_PRIOR_SQL},
    sides as (select p.fold, f.fold = p.fold as held_out, y, cast(score > 0.5 as int) as predicted from folds f cross join priors p),
    cells as (select fold, held_out, count(*) filter (y = predicted) as hits, count(*) as n,
        count(*) filter (y = 1 and predicted = 1) as tp, count(*) filter (predicted = 1) as said, sum(y) as p
      from sides group by fold, held_out),
    shares as (select fold, held_out, m.metric, case m.metric when 'accuracy' then hits / n when 'roc_auc' then 0.5
        when 'precision' then coalesce(tp / nullif(said, 0), 0) when 'recall' then coalesce(tp / nullif(p, 0), 0)
        when 'f1' then coalesce(2 * tp / nullif(p + said, 0), 0) else coalesce(5 * tp / nullif(4 * p + said, 0), 0) end as v
      from cells cross join (values ('accuracy'), ('precision'), ('recall'), ('f1'), ('f2'), ('roc_auc')) as m(metric))
    select 'prior' as candidate, metric, {r('avg(v) filter (not held_out)')} as train_mean, {r('avg(v) filter (held_out)')} as cv_mean,
      {r('stddev_pop(v) filter (held_out)')} as cv_std, {r('avg(v) filter (not held_out) - avg(v) filter (held_out)')} as gap
    from shares group by metric""",
)
def cv_prior(spark, sf_dir):
    """Cross-validation of the class shares, from score counts of all folds."""
    return shown(compare.cross_validate(_md5_training(spark, sf_dir), [_PRIOR]))


@query("oof_scores")
def oof_scores(spark, sf_dir):
    return compare.out_of_fold_scores(_training(spark, sf_dir), _BALANCED)


@query("threshold_tuning")
def threshold_tuning(spark, sf_dir):
    scores = compare.out_of_fold_scores(_training(spark, sf_dir), _BALANCED)
    return compare.tune_threshold(scores)[1]


@query("grid_search")
def grid_search(spark, sf_dir):
    result = compare.grid_search(_training(spark, sf_dir), "logistic_balanced")
    rows = [(float(point["C"]), score, point == result.settings) for point, score in result.scores]
    return spark.createDataFrame(rows, "C double, f2 double, best boolean")


@query("learning_curve")
def learning_curve(spark, sf_dir):
    return compare.learning_curve(_training(spark, sf_dir), _BALANCED)


@query("validation_curve")
def validation_curve(spark, sf_dir):
    training = _training(spark, sf_dir)
    return compare.validation_curve(training, "logistic_balanced", "C", CURVE_C, {})


@query("model_comparison")
def model_comparison(spark, sf_dir):
    """All scenarios, both targets, default and tuned stage of all models."""
    rows = _labelled(spark, sf_dir)
    split = materialize(stratified_split(rows, "target", "unit_id").select("unit_id", "part"), "split")
    return compare.compare_models(
        rows,
        UNITS,
        "unit_id",
        split,
        parallelism=4,
        fold_parallelism=5,
    )


@query("final_levels")
def final_levels(spark, sf_dir):
    """One evaluation at the tuned threshold: training, cross-validation, test."""
    rows = _labelled(spark, sf_dir)
    train, test = compare.train_and_test(rows, "target", "unit_id")
    training = compare.prepare_training(
        train, UNITS, "early_warning", "target", "unit_id", parallelism=4, fold_parallelism=5
    )
    model, best = compare.tune_model(training, "logistic_balanced")
    candidate = compare.Candidate("chosen", "logistic_balanced", best)
    scores = compare.cross_validation_scores(training, [candidate])
    threshold, _ = compare.tune_threshold(scores.where(F.col("part") == "validation"))
    evaluated = final_model.evaluate_once(model, train, test, "target", threshold)
    values = compare.metrics_long(compare.fold_metrics(scores), ("candidate", "fold"))
    cv = compare.summarize_folds(values, ("candidate", "metric"))
    return final_model.three_levels(evaluated, cv, threshold)
