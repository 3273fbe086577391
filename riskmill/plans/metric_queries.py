"""Queries for splits, folds, metrics, scores and fit statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmill.functions.durable import checkpoint_dir
from riskmill.functions.risk import RISK_BANDS, is_at_risk, recommendation, risk_band
from riskmill.operators import metrics, split
from riskmill.plans import views
from riskmill.plans.registry import query, r, shown
from riskmill.plans.views import SQL_SCORED
from riskmill.sources.splits import load_or_create_split
from riskmill.spec import CURVE_SHARES, FOLDS, METRICS, THRESHOLDS

# --- splits ----------------------------------------------------------------


def _split_sql(rows: str, label: str, name: str = "parts") -> str:
    """Stratified 70/30 split by the md5 order of the ids; needs ``unit_id``."""
    return f"""{name}_k as (select *, md5(concat(cast(unit_id as varchar), '42')) as k from {rows}),
    {name}_r as (select *, row_number() over (partition by {label} order by k, unit_id) as rn
      from {name}_k),
    {name}_t as (select count(*) as n_all, count(*) - ceil(cast(0.3 as double) * count(*)) as n_train
      from {rows}),
    {name}_q as (select {label}, count(*) * any_value(n_train) / any_value(n_all) as exact,
      any_value(n_train) as n_train from {rows}, {name}_t group by {label}),
    {name}_quota as (select {label}, floor(exact) + case when row_number() over (
        order by exact - floor(exact) desc, cast({label} as varchar))
        <= n_train - sum(floor(exact)) over () then 1 else 0 end as quota from {name}_q),
    {name} as (select {name}_r.* exclude (k, rn),
      case when rn <= quota then 'train' else 'test' end as part
      from {name}_r join {name}_quota using ({label}))"""


def _folds_sql(rows: str, label: str, name: str = "folds") -> str:
    """Five folds: each class dealt in turn, then given out in md5 order."""
    return f"""{name}_k as (select *, md5(concat(cast(unit_id as varchar), '42')) as k from {rows}),
    {name}_r as (select *, row_number() over (partition by {label} order by k, unit_id) as rn
      from {name}_k),
    {name}_d as (select {label}, sum(count(*)) over (order by cast({label} as varchar))
      - count(*) as dealt from {rows} group by {label}),
    {name}_f as (select {label}, cast((rn - 1 + dealt) % 5 as integer) as fold from {name}_r
      join {name}_d using ({label})),
    {name}_o as (select *, row_number() over (partition by {label} order by fold) as rn
      from {name}_f),
    {name} as (select {name}_r.* exclude (k, rn), fold from {name}_r
      join {name}_o using ({label}, rn))"""


def _scored_split(spark, sf_dir):
    return split.stratified_split(views.scored(spark, sf_dir), "y", "unit_id", method="md5")


def _scored_folds(spark, sf_dir):
    return split.stratified_folds(views.scored(spark, sf_dir), "y", "unit_id", method="md5")


@query(
    "stratified_split",
    f"""with {SQL_SCORED}, {_split_sql('scored', 'y')} select unit_id, y, part from parts""",
)
def stratified_split(spark, sf_dir):
    return _scored_split(spark, sf_dir).select("unit_id", "y", "part")


@query(
    "stratified_folds",
    f"""with {SQL_SCORED}, {_folds_sql('scored', 'y')} select unit_id, y, fold from folds""",
)
def stratified_folds(spark, sf_dir):
    return _scored_folds(spark, sf_dir).select("unit_id", "y", "fold")


@query(
    "split_semi",
    f"""with {SQL_SCORED}, {_split_sql('scored', 'y')}
    select unit_id, y, s from parts where part = 'train'""",
)
def split_semi(spark, sf_dir):
    ids = _scored_split(spark, sf_dir).select("unit_id", "part")
    return split.labelled_part(views.scored(spark, sf_dir), ids, "unit_id", "y", "train")


@query(
    "holdout_labelled",
    f"""with t as (select o_orderkey as unit_id, o_orderstatus as c,
      case when o_orderstatus = 'P' then 1 else 0 end as y from orders), {_split_sql('t', 'y')}
    select unit_id, part, case c when 'P' then 1 else 0 end as label from parts where c <> 'O'""",
)
def holdout_labelled(spark, sf_dir):
    status = F.col("o_orderstatus")
    orders = views.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("unit_id"),
        F.when(status == "P", 1).otherwise(0).alias("y"),
        F.when(status == "P", 1).when(status == "F", 0).alias("label"),
    )
    parts = split.stratified_split(orders, "y", "unit_id", method="md5")
    return parts.where(F.col("label").isNotNull()).select("unit_id", "part", "label")


@query(
    "split_reuse",
    f"""with {SQL_SCORED}, {_split_sql('scored', 'y')}
    select reused, part, count(*) as n, cast(sum(y) as bigint) as positives
    from parts, (values (false), (true)) as v(reused) group by reused, part""",
)
def split_reuse(spark, sf_dir):
    """Create a split, save it, and load it again by its recorded conditions."""
    rows = views.scored(spark, sf_dir)
    folder = f"{checkpoint_dir(spark)}/splits"
    tables = []
    for overwrite in (True, False):
        saved = load_or_create_split(
            rows, folder, "y", "unit_id", method="md5", overwrite=overwrite
        )
        counted = rows.join(saved.ids, "unit_id").groupBy("part").agg(
            F.count("*").alias("n"), F.sum("y").alias("positives")
        )
        tables.append(counted.select(F.lit(saved.reused).alias("reused"), "part", "n", "positives"))
    return tables[0].unionByName(tables[1])


_PREFIX_SQL = f"""with {SQL_SCORED}, {_folds_sql('scored', 'y')},
    f as (select distinct fold from folds),
    training as (select f.fold as f, unit_id, y,
      row_number() over (partition by f.fold order by unit_id) as rn
      from f join folds on folds.fold <> f.fold),
    sizes as (select cast(floor(share * n) as bigint) as size from
      (select count(*) as n from training where f = 0), (values {', '.join(
        f'(cast({share} as double))' for share in CURVE_SHARES)}) as v(share))"""


@query(
    "learning_prefix",
    f"""{_PREFIX_SQL} select f as fold, size as train_size, count(*) as n,
    cast(sum(y) as bigint) as positives, max(unit_id) as last_id
    from training join sizes on rn <= size group by f, size""",
)
def learning_prefix(spark, sf_dir):
    folds = _scored_folds(spark, sf_dir)
    cuts = split.training_prefixes(folds, "fold", "unit_id", CURVE_SHARES)
    return split.prefix_counts(folds, "fold", "unit_id", "y", cuts)


# --- metrics ---------------------------------------------------------------

_RATES = {
    "accuracy": "(tp + tn) / (tp + tn + fp + fn)",
    "precision": "coalesce(tp / nullif(tp + fp, 0), 0)",
    "recall": "coalesce(tp / nullif(tp + fn, 0), 0)",
    "f1": "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)",
    "f2": "coalesce(5 * tp / nullif(5 * tp + 4 * fn + fp, 0), 0)",
}
_RATES_SQL = ", ".join(f"{r(e)} as {name}" for name, e in _RATES.items())


def _confusion_sql(threshold: str = "t", score: str = "s") -> str:
    return f"""count(*) filter (where y = 0 and {score} < {threshold}) as tn,
    count(*) filter (where y = 0 and {score} >= {threshold}) as fp,
    count(*) filter (where y = 1 and {score} < {threshold}) as fn,
    count(*) filter (where y = 1 and {score} >= {threshold}) as tp"""


def _auc_sql(rows: str = "scored", by: str = "", name: str = "auc") -> str:
    """ROC AUC as the rank statistic, with mean ranks for ties."""
    part = f"partition by {by}" if by else ""
    keys = f"{by}," if by else ""
    group = f"group by {by}" if by else ""
    return f"""{name}_r as (select {keys} y, rank() over ({part} order by s)
        + (count(*) over (partition by {keys} s) - 1) / 2.0 as rk from {rows}),
    {name} as (select {keys} (sum(rk) filter (where y = 1)
        - count(*) filter (where y = 1) * (count(*) filter (where y = 1) + 1) / 2.0)
        / (count(*) filter (where y = 1) * count(*) filter (where y = 0)) as roc_auc
      from {name}_r {group})"""


_CURVE_SQL = """g as (select s, count(*) filter (where y = 1) as p,
      count(*) filter (where y = 0) as n from scored group by s),
    c as (select s, p, n, sum(p) over (order by s desc) as cp, sum(n) over (order by s desc) as cn,
      sum(p) over () as ap, sum(n) over () as an from g)"""


@query("confusion", f"with {SQL_SCORED} select {_confusion_sql('0.4')} from scored")
def confusion(spark, sf_dir):
    return metrics.confusion_at(views.scored(spark, sf_dir), "y", "s", 0.4)


@query(
    "confusion_norm",
    f"""with {SQL_SCORED}, c as (select y as actual, cast(s >= 0.4 as integer) as predicted,
      count(*) as n from scored group by 1, 2)
    select actual, predicted, n, {r('n / sum(n) over (partition by actual)')} as share from c""",
)
def confusion_norm(spark, sf_dir):
    return shown(metrics.confusion_shares(views.scored(spark, sf_dir), "y", "s", 0.4))


_VALUES = ", ".join(f"(cast({t} as double))" for t in THRESHOLDS)
_THRESHOLD_CTE = f"""{_auc_sql()}, counted as (select t as threshold, {_confusion_sql()}
      from scored, (values {_VALUES}) as v(t) group by t)"""


@query(
    "threshold_table",
    f"""with {SQL_SCORED}, {_THRESHOLD_CTE} select threshold, {_RATES_SQL},
    {r('roc_auc')} as roc_auc, tn, fp, fn, tp from counted, auc""",
)
def threshold_table(spark, sf_dir):
    return shown(metrics.threshold_table(views.scored(spark, sf_dir), "y", "s"))


@query(
    "metrics_at_threshold",
    f"""with {SQL_SCORED}, {_THRESHOLD_CTE} select threshold, {_RATES_SQL},
    {r('roc_auc')} as roc_auc, tn, fp, fn, tp from counted, auc where threshold = 0.5""",
)
def metrics_at_threshold(spark, sf_dir):
    return shown(metrics.metrics_at(views.scored(spark, sf_dir), "y", "s", 0.5))


@query(
    "best_threshold",
    f"""with {SQL_SCORED}, {_THRESHOLD_CTE}
    select threshold from counted order by {_RATES['f2']} desc, abs(threshold - 0.5), threshold
    limit 1""",
)
def best_threshold(spark, sf_dir):
    return metrics.best_threshold(metrics.threshold_table(views.scored(spark, sf_dir), "y", "s"))


@query("roc_auc", f"with {SQL_SCORED}, {_auc_sql()} select {r('roc_auc')} as roc_auc from auc")
def roc_auc(spark, sf_dir):
    return shown(metrics.rank_metrics(views.scored(spark, sf_dir), "y", "s").select("roc_auc"))


@query(
    "average_precision",
    f"""with {SQL_SCORED}, {_CURVE_SQL} select {r('sum(p / ap * (cp / (cp + cn)))')}
    as average_precision, {r('any_value(ap) / (any_value(ap) + any_value(an))')} as baseline
    from c""",
)
def average_precision(spark, sf_dir):
    rows = metrics.rank_metrics(views.scored(spark, sf_dir), "y", "s")
    return shown(rows.select("average_precision", "baseline"))


@query(
    "roc_points",
    f"""with {SQL_SCORED}, {_CURVE_SQL} select {r('cn / an')} as fpr, {r('cp / ap')} as tpr,
    s as threshold from c union all select 0.0, 0.0, null""",
)
def roc_points(spark, sf_dir):
    return shown(metrics.roc_points(views.scored(spark, sf_dir), "y", "s"))


@query(
    "pr_points",
    f"""with {SQL_SCORED}, {_CURVE_SQL} select {r('cp / (cp + cn)')} as precision,
    {r('cp / ap')} as recall, s as threshold from c union all select 1.0, 0.0, null""",
)
def pr_points(spark, sf_dir):
    return shown(metrics.pr_points(views.scored(spark, sf_dir), "y", "s"))


@query(
    "three_levels",
    f"""with {SQL_SCORED}, {_split_sql('scored', 'y')},
    train as (select unit_id, y, s from parts where part = 'train'),
    {_folds_sql('train', 'y')},
    tagged as (select 'train' as level, 0.4 as t, y, s from parts where part = 'train'
      union all select 'test', 0.4, y, s from parts where part = 'test'
      union all select 'test', 0.5, y, s from parts where part = 'test'
      union all select concat('fold', cast(fold as varchar)), 0.5, y, s from folds),
    {_auc_sql('tagged', 'level, t')},
    counted as (select level, t, {_confusion_sql()} from tagged group by level, t),
    m as (select level, t, {', '.join(f'{e} as {n}' for n, e in _RATES.items())}, roc_auc
      from counted join auc using (level, t))
    select case when level like 'fold%' then 'cv' else level end as level,
    cast(t as double) as threshold,
    {', '.join(f'{r(f"avg({m})")} as {m}' for m in METRICS)} from m group by 1, 2""",
)
def three_levels(spark, sf_dir):
    """Training, cross-validation and test metrics side by side.

    Training and test use the tuned threshold, the mean over folds uses 0.5, and
    the test rows are also measured at 0.5.
    """
    parts = _scored_split(spark, sf_dir)
    train = parts.where(F.col("part") == "train").select("unit_id", "y", "s")
    both = metrics.metrics_at(parts, "y", "s", 0.4, by=["part"])
    test = metrics.metrics_at(parts.where(F.col("part") == "test"), "y", "s", 0.5, by=["part"])
    folds = split.stratified_folds(train, "y", "unit_id", method="md5")
    per_fold = metrics.metrics_at(folds, "y", "s", 0.5, by=["fold"])
    cv = per_fold.groupBy(F.lit("cv").alias("level"), "threshold").agg(
        *[F.avg(m).alias(m) for m in METRICS]
    )
    levels = both.unionByName(test).select(F.col("part").alias("level"), "threshold", *METRICS)
    return shown(levels.unionByName(cv))


@query(
    "class_weights",
    f"""with c as (select toxic, count(*) as n_rows from labels group by toxic)
    select toxic, n_rows, {r('n_rows / sum(n_rows) over ()')} as prior,
    {r('sum(n_rows) over () / (count(*) over () * n_rows)')} as weight from c""",
)
def class_weights(spark, sf_dir):
    return shown(metrics.class_weights(views.table(spark, sf_dir, "labels"), "toxic"))


# --- scores ----------------------------------------------------------------

def _band_sql(position: int) -> str:
    cases = " ".join(
        f"when s >= {band[0]} then '{band[position]}'" for band in reversed(RISK_BANDS[1:])
    )
    return f"case {cases} else '{RISK_BANDS[0][position]}' end"


@query(
    "risk_bands",
    f"""with {SQL_SCORED} select unit_id, s as probability, s >= 0.4 as is_dropout_risk,
    {_band_sql(1)} as risk_band, {_band_sql(2)} as recommendation from scored""",
)
def risk_bands(spark, sf_dir):
    score = F.col("s")
    return views.scored(spark, sf_dir).select(
        "unit_id",
        score.alias("probability"),
        is_at_risk(score, 0.4).alias("is_dropout_risk"),
        risk_band(score).alias("risk_band"),
        recommendation(score).alias("recommendation"),
    )
