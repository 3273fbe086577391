"""Queries on result tables derived from line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmill.operators import results
from riskmill.plans import registry, views
from riskmill.plans.registry import query
from riskmill.plans.views import SQL_FOLD_SCORES, SQL_RESULTS

# Averages of two-decimal values often end in a 5 at the seventh digit, where the
# last bit decides how six digits round; nine digits leave that zone.
DIGITS = 9


def shown(df):
    return registry.shown(df, DIGITS)


def r(expression: str) -> str:
    return registry.r(expression, DIGITS)


KEYS = ("scenario", "stage", "target", "model", "metric")
ROUNDED = ", ".join(f"{r(c)} as {c}" for c in ("train_mean", "cv_mean", "cv_std", "gap"))
TUNED_F2 = "metric = 'f2' and stage = 'tuned' and model <> 'm1'"


def _results(spark, sf_dir):
    return results.summarize_folds(views.fold_scores(spark, sf_dir), KEYS)


def _tuned_f2(spark, sf_dir):
    return results.filter_results(
        _results(spark, sf_dir), "principal", "tuned", metrics=("f2",), baseline="m1"
    )


@query("cv_summary", f"with {SQL_RESULTS} select {', '.join(KEYS)}, {ROUNDED} from results")
def cv_summary(spark, sf_dir):
    return shown(_results(spark, sf_dir))


@query(
    "result_filter",
    f"with {SQL_RESULTS} select {', '.join(KEYS)}, {ROUNDED} from results where {TUNED_F2}",
)
def result_filter(spark, sf_dir):
    return shown(_tuned_f2(spark, sf_dir))


@query(
    "result_pivot_gap",
    f"""with {SQL_RESULTS}, t as (select * from results where stage = 'tuned'),
    wide as (select scenario, model, avg(cv_mean) filter (where metric = 'f2') as f2,
      avg(cv_mean) filter (where metric = 'recall') as recall from t group by scenario, model)
    select wide.scenario, wide.model, {r('t.gap')} as gap_f2, {r('f2')} as f2,
    {r('recall')} as recall from wide left join t
      on t.scenario = wide.scenario and t.model = wide.model and t.metric = 'f2'""",
)
def result_pivot_gap(spark, sf_dir):
    tuned = _results(spark, sf_dir).where(F.col("stage") == "tuned")
    return shown(results.key_table(tuned, "scenario", ("f2", "recall")))


@query(
    "metric_pivot",
    f"""with {SQL_RESULTS} select scenario,
    {', '.join(f"{r(f"avg(cv_mean) filter (where model = 'm{i}')")} as m{i}" for i in range(1, 8))}
    from results where metric = 'f2' and target = 'principal' group by scenario""",
)
def metric_pivot(spark, sf_dir):
    rows = results.filter_results(_results(spark, sf_dir), "principal", metrics=("f2",))
    models = [f"m{i}" for i in range(1, 8)]
    return shown(results.pivot_metric(rows, models, "scenario"))


@query(
    "model_order",
    f"""with {SQL_RESULTS} select model, {r('avg(cv_mean)')} as mean_value
    from results where metric = 'f2' group by model""",
)
def model_order(spark, sf_dir):
    rows = results.filter_results(_results(spark, sf_dir), metrics=("f2",))
    return shown(results.model_order(rows))


@query(
    "top_results",
    f"""with {SQL_RESULTS} select {', '.join(KEYS)}, {ROUNDED} from results where {TUNED_F2}
    order by cv_mean desc, scenario, model limit 3""",
)
def top_results(spark, sf_dir):
    return shown(results.top_results(_tuned_f2(spark, sf_dir), 3))


@query(
    "top_gaps",
    f"""with {SQL_RESULTS} select {', '.join(KEYS)}, {ROUNDED} from results where metric = 'f2'
    order by gap desc, scenario, stage, model limit 20""",
)
def top_gaps(spark, sf_dir):
    rows = results.filter_results(_results(spark, sf_dir), metrics=("f2",))
    return shown(results.largest_gaps(rows, 20, ("scenario", "stage", "model")))


@query(
    "gap_long",
    f"""with {SQL_RESULTS}, t as (select * from results where {TUNED_F2})
    select concat(scenario, ' | ', model) as label, 'Treino' as part,
    {r('train_mean')} as value from t
    union all select concat(scenario, ' | ', model), 'Validacao cruzada', {r('cv_mean')} from t""",
)
def gap_long(spark, sf_dir):
    return shown(results.gap_long(_tuned_f2(spark, sf_dir), "scenario"))


@query(
    "distinct_params",
    """select distinct l_returnflag as scenario, concat('m', cast(l_linenumber as varchar)) as model,
    cast(l_tax as varchar) as best_params from lineitem""",
)
def distinct_params(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("scenario"),
        F.concat(F.lit("m"), F.col("l_linenumber").cast("string")).alias("model"),
        F.col("l_tax").cast("string").alias("best_params"),
    )
    return results.distinct_parameters(lines)


@query(
    "result_union",
    f"""with {SQL_RESULTS} select scenario, target, stage, model, metric, {ROUNDED},
    cast(null as varchar) as best_params from results where stage = 'default'
    union all select scenario, target, stage, model, metric, {ROUNDED}, 'C=0.1'
    from results where stage = 'tuned'""",
)
def result_union(spark, sf_dir):
    rows = _results(spark, sf_dir)
    tuned = rows.where(F.col("stage") == "tuned").withColumn("best_params", F.lit("C=0.1"))
    return shown(results.result_table([rows.where(F.col("stage") == "default"), tuned]))


@query(
    "select_candidate",
    f"""with {SQL_RESULTS}, t as (select * from results where {TUNED_F2}),
    b as (select *, max(cv_mean) over (partition by scenario) as best_f2,
      first_value(model) over (partition by scenario order by cv_mean desc, model) as best_by_f2
      from t),
    near as (select *, row_number() over (partition by scenario order by gap, cv_mean desc, model)
      as rn from b where cv_mean >= best_f2 - 0.01),
    inside as (select scenario, string_agg(model, ',' order by model) as within_margin
      from near group by scenario)
    select scenario, best_by_f2, {r('best_f2')} as best_f2, model as chosen_model,
    {r('cv_mean')} as chosen_f2, {r('gap')} as chosen_gap, within_margin,
    case when model = best_by_f2 then '{results.REASON_BEST}'
      else '{results.REASON_TIE.format(margin=0.01)}' end as reason
    from near join inside using (scenario) where rn = 1""",
)
def select_candidate(spark, sf_dir):
    chosen = results.select_candidates(_results(spark, sf_dir), baseline="m1").drop("margin")
    return shown(chosen.withColumn("within_margin", F.concat_ws(",", "within_margin")))


@query(
    "fit_diagnosis",
    f"""with {SQL_RESULTS}, t as (select *, cv_mean - 0.02 as test_value from results)
    select {', '.join(KEYS)}, {r('train_mean - cv_mean')} as gap_train_cv,
    {r('cv_mean - test_value')} as gap_cv_test,
    case when train_mean - cv_mean > 0.0255 then 'overfitting'
      when train_mean < 0.5 and cv_mean < 0.5 then 'underfitting'
      else 'ajuste_adequado' end as diagnosis from t""",
)
def fit_diagnosis(spark, sf_dir):
    rows = _results(spark, sf_dir).withColumn("test_value", F.col("cv_mean") - F.lit(0.02))
    return shown(
        results.diagnose_fit(rows, tolerance=0.0255).select(
            *KEYS, "gap_train_cv", "gap_cv_test", "diagnosis"
        )
    )


@query(
    "fold_values",
    f"""with {SQL_FOLD_SCORES} select scenario, stage, target, model, metric, fold,
    {r('cv_value')} as cv_value, {r('train_value')} as train_value from fold_scores""",
)
def fold_values(spark, sf_dir):
    return shown(views.fold_scores(spark, sf_dir))
