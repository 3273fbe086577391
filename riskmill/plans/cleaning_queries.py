"""Queries for sources, contract, cleaning, profiles and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmill.functions.durable import checkpoint_dir, materialize
from riskmill.functions.numeric import is_out_of_scale, repair_scale, text_to_double
from riskmill.operators import cleaning, contract, dedup, profile, scenarios
from riskmill.operators.features import derive_features
from riskmill.operators.prepare import prepare_table
from riskmill.plans import views
from riskmill.plans.registry import query, r, shown
from riskmill.plans.views import SQL_GAPPY, SQL_UNITS, UNITS
from riskmill.sources.fingerprint import file_fingerprints
from riskmill.sources.tables import read_table

GRADES = tuple(UNITS.grades)


def _repaired_sql(column: str) -> str:
    return (
        f"list_reduce(list_prepend(cast({column} as double), cast(range(1, 65) as double[])), "
        "lambda a, b: case when abs(a) > 20 then a / 10 else a end)"
    )


# --- sources ---------------------------------------------------------------

@query(
    "scan_profile",
    f"""select l_returnflag, l_linestatus, count(*) as n_rows, {r('sum(l_quantity)')} as quantity,
    min(l_extendedprice) as min_price, max(l_extendedprice) as max_price
    from lineitem group by l_returnflag, l_linestatus""",
)
def scan_profile(spark, sf_dir):
    lines = read_table(spark, f"{sf_dir}/lineitem.parquet")
    return shown(
        lines.groupBy("l_returnflag", "l_linestatus").agg(
            F.count("*").alias("n_rows"),
            F.sum("l_quantity").alias("quantity"),
            F.min("l_extendedprice").alias("min_price"),
            F.max("l_extendedprice").alias("max_price"),
        )
    )


@query("file_fingerprint")
def file_fingerprint(spark, sf_dir):
    return file_fingerprints(spark, sf_dir).select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", "actual_sha256"
    )


# --- contract --------------------------------------------------------------

@query(
    "schema_check",
    f"""with {SQL_UNITS}
    select 'missing_column' as issue, 'num_age' as subject, cast(null as bigint) as n_rows
    union all select 'unexpected_column', 'grade_2', null
    union all select 'unexpected_class', target_raw, count(*) from units
      where target_raw not in ('P', 'F') group by target_raw""",
)
def schema_check(spark, sf_dir):
    expected = [c for c in UNITS.columns if c != "grade_2"] + ["num_age"]
    return contract.schema_issues(views.units(spark, sf_dir), expected, UNITS.target, ("P", "F"))


@query(
    "schema_diff",
    """with have(name) as (select column_name from (describe select * from lineitem)),
    want(name) as (values ('l_orderkey'), ('l_linenumber'), ('l_quantity'), ('l_comment'))
    select 'missing_column' as issue, name as subject from want
      where name not in (select name from have)
    union all select 'unexpected_column', name from have
      where name not in (select name from want)""",
)
def schema_diff(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    return contract.schema_difference(
        lines, ("l_orderkey", "l_linenumber", "l_quantity", "l_comment")
    )


@query(
    "range_check",
    f"""with {SQL_GAPPY}, c as (select
      count(*) filter (where cat_priority not in ('1-URGENT','2-HIGH','3-MEDIUM','5-LOW')) as c0,
      count(*) filter (where bin_debtor not in (0, 1)) as c1,
      count(*) filter (where num_admission < 0) as c2,
      count(*) filter (where num_admission > 400000) as c3,
      count(*) filter (where enrolled_1 < 0) as c4, count(*) filter (where enrolled_1 > 5) as c5,
      count(*) filter (where grade_1 < 0) as c6, count(*) filter (where grade_1 > 20) as c7,
      count(*) filter (where grade_2 < 0) as c8, count(*) filter (where grade_2 > 20) as c9
      from gappy)
    select 'cat_priority' as column_name, 'unknown_category' as issue, c0 as n_rows from c
    union all select 'bin_debtor', 'not_a_flag', c1 from c
    union all select 'num_admission', 'below_minimum', c2 from c
    union all select 'num_admission', 'above_maximum', c3 from c
    union all select 'enrolled_1', 'below_minimum', c4 from c
    union all select 'enrolled_1', 'above_maximum', c5 from c
    union all select 'grade_1', 'below_minimum', c6 from c
    union all select 'grade_1', 'above_maximum', c7 from c
    union all select 'grade_2', 'below_minimum', c8 from c
    union all select 'grade_2', 'above_maximum', c9 from c""",
)
def range_check(spark, sf_dir):
    return contract.rule_violations(
        views.gappy_units(spark, sf_dir), list(UNITS.rules.values()), UNITS.options
    )


@query(
    "default_fill",
    f"""with {SQL_GAPPY} select unit_id, coalesce(cat_priority, '3-MEDIUM') as cat_priority,
    cat_segment, coalesce(bin_debtor, 0) as bin_debtor, coalesce(enrolled_1, 2) as enrolled_1,
    coalesce(grade_1, 12.5) as grade_1 from gappy""",
)
def default_fill(spark, sf_dir):
    return contract.fill_defaults(views.gappy_units(spark, sf_dir), UNITS.rules).select(
        "unit_id", "cat_priority", "cat_segment", "bin_debtor", "enrolled_1", "grade_1"
    )


@query(
    "category_options",
    "select distinct p_brand as option from part where p_brand is not null",
)
def category_options(spark, sf_dir):
    return contract.category_options(views.table(spark, sf_dir, "part"), "p_brand")


# --- profiles --------------------------------------------------------------

@query(
    "missing_profile",
    f"""with {SQL_GAPPY}, c as (select count(*) - count(cat_priority) as a,
      count(*) - count(cat_segment) as b, count(*) - count(bin_debtor) as c,
      count(*) - count(enrolled_1) as d, count(*) - count(grade_1) as e from gappy)
    select * from (select 'cat_priority' as column_name, a as n_missing from c
      union all select 'cat_segment', b from c union all select 'bin_debtor', c from c
      union all select 'enrolled_1', d from c union all select 'grade_1', e from c)
    where n_missing > 0""",
)
def missing_profile(spark, sf_dir):
    return profile.missing_profile(views.gappy_units(spark, sf_dir))


@query(
    "class_counts",
    "select o_orderstatus, count(*) as n_rows from orders group by o_orderstatus",
)
def class_counts(spark, sf_dir):
    return contract.class_counts(views.table(spark, sf_dir, "orders"), "o_orderstatus")


@query(
    "multi_counts",
    """select o_orderpriority, o_orderstatus, nullif(o_orderstatus, 'O') as clear_status,
    count(*) as n_rows from orders group by 1, 2, 3""",
)
def multi_counts(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").withColumn(
        "clear_status", F.nullif(F.col("o_orderstatus"), F.lit("O"))
    )
    return contract.class_counts(orders, "o_orderpriority", "o_orderstatus", "clear_status")


@query(
    "histogram",
    f"""with m as (select min(value) as lo, max(value) as hi, (max(value) - min(value)) / 40 as w
      from events), b as (select least(cast(floor((value - lo) / w) as int) + 1, 40) as bin
      from events, m where value is not null)
    select bin, {r('lo + (bin - 1) * w')} as bin_start, {r('lo + bin * w')} as bin_end,
    count(*) as n from b, m group by bin, lo, w""",
)
def histogram(spark, sf_dir):
    return shown(profile.histogram(views.table(spark, sf_dir, "events"), "value", 40))


# --- scale repair ----------------------------------------------------------

@query(
    "tolerant_cast",
    """select event_id, try_cast(json_extract_string(props, '$.k') as double) as k,
    try_cast(props as double) as raw, try_cast(concat(' ', cast(value as varchar)) as double) as v
    from events""",
)
def tolerant_cast(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        text_to_double(F.get_json_object("props", "$.k")).alias("k"),
        text_to_double(F.col("props")).alias("raw"),
        text_to_double(F.concat(F.lit(" "), F.col("value").cast("string"))).alias("v"),
    )


@query(
    "scale_flag",
    f"""with {SQL_GAPPY} select unit_id, coalesce(abs(grade_1) > 20, false) as flag_1,
    coalesce(abs(grade_2) > 20, false) as flag_2 from gappy""",
)
def scale_flag(spark, sf_dir):
    return views.gappy_units(spark, sf_dir, customers=False).select(
        "unit_id",
        is_out_of_scale(F.col("grade_1"), 20).alias("flag_1"),
        is_out_of_scale(F.col("grade_2"), 20).alias("flag_2"),
    )


@query(
    "scale_repair",
    f"""with {SQL_GAPPY} select unit_id, {_repaired_sql('grade_1')} as grade_1,
    {_repaired_sql('grade_2')} as grade_2 from gappy""",
)
def scale_repair(spark, sf_dir):
    gappy = views.gappy_units(spark, sf_dir, customers=False)
    return cleaning.repair_columns(gappy, (*GRADES, "grade_3")).select("unit_id", *GRADES)


@query(
    "scale_all_valid",
    f"""with {SQL_UNITS}, c as (select bool_and(grade_1 between 0 and 20) as a,
      bool_and({_repaired_sql('grade_2')} between 0 and 20) as b from units)
    select 'grade_1' as column_name, a as ok from c union all select 'fixed_2', b from c""",
)
def scale_all_valid(spark, sf_dir):
    units = views.units(spark, sf_dir, customers=False)
    units = units.withColumn("fixed_2", repair_scale(F.col("grade_2"), 20))
    return cleaning.all_in_scale(units, ("grade_1", "fixed_2"))


def _stats_sql(column: str) -> str:
    fixed = _repaired_sql(column)
    return f"""select '{column}' as column_name, count({column}) as n_values,
    count(*) filter (where abs({column}) > 20) as n_corrected,
    {r(f'100.0 * count(*) filter (where abs({column}) > 20) / count({column})')} as pct_corrected,
    min({column}) as min_before, max({column}) as max_before,
    {r(f'min({fixed})')} as min_after, {r(f'max({fixed})')} as max_after from units"""


@query(
    "repair_stats",
    f"with {SQL_UNITS} {_stats_sql('grade_1')} union all {_stats_sql('grade_2')}",
)
def repair_stats(spark, sf_dir):
    return shown(cleaning.repair_statistics(views.units(spark, sf_dir, customers=False), GRADES))


def _distribution_sql(column: str) -> str:
    fixed = _repaired_sql(column)
    kept, mended = f"abs({column}) <= 20 and {column} > 0", f"abs({column}) > 20"
    parts = []
    for kind, value, test in (("untouched", column, kept), ("corrected", fixed, mended)):
        inner = f"case when {test} then {value} end"
        parts.append(f"count({inner}) as {kind}_n")
        for name, function in (("mean", "avg"), ("median", "median"), ("min", "min"), ("max", "max")):
            parts.append(f"{r(f'{function}({inner})')} as {kind}_{name}")
    difference = (
        f"avg(case when {mended} then {fixed} end) - avg(case when {kept} then {column} end)"
    )
    whole = f"count(*) filter (where {mended} and floor({column}) = {column})"
    broken = f"count(*) filter (where {mended})"
    return f"""select '{column}' as column_name, {', '.join(parts)},
    {r(difference)} as mean_difference,
    coalesce(bool_and({fixed} between 0 and 20) filter (where {mended}), true)
      as all_corrected_within_scale,
    {whole} as n_corrupted_integers, {broken} as n_corrupted,
    {r(f'100.0 * {whole} / nullif({broken}, 0)')} as pct_corrupted_integers,
    {broken} > 0 and coalesce(bool_and({fixed} between 0 and 20) filter (where {mended}), true)
      and {whole} = {broken} as ok from units"""


@query(
    "repair_distribution",
    f"with {SQL_UNITS} {_distribution_sql('grade_1')} union all {_distribution_sql('grade_2')}",
)
def repair_distribution(spark, sf_dir):
    return shown(cleaning.repair_distribution(views.units(spark, sf_dir, customers=False), GRADES))


@query(
    "repair_examples",
    f"""with {SQL_UNITS} select unit_id, grade_1 as before, {_repaired_sql('grade_1')} as after
    from units where abs(grade_1) > 20 order by unit_id limit 5""",
)
def repair_examples(spark, sf_dir):
    return cleaning.repair_examples(views.units(spark, sf_dir, customers=False), "grade_1", ["unit_id"])


@query(
    "consistency_check",
    f"""with {SQL_UNITS}, c as (
      select count(*) filter (where approved_1 = 0 and grade_1 > 0) as a,
      count(*) filter (where approved_2 = 0 and grade_2 > 0) as b from units)
    select 'grade_1' as grade_column, 'approved_1' as approved_column, a = 0 as ok,
      a as n_violations from c
    union all select 'grade_2', 'approved_2', b = 0, b from c
    union all select 'grade_3', 'approved_3', false, null""",
)
def consistency_check(spark, sf_dir):
    pairs = {**UNITS.grades, "grade_3": "approved_3"}
    return cleaning.consistency_check(views.units(spark, sf_dir, customers=False), pairs)


# --- duplicates ------------------------------------------------------------

@query(
    "dedup_exact",
    """select * exclude (rn) from (select *, row_number() over (
      partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey, l_quantity,
      l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) as rn from lineitem)
    where rn = 1""",
)
def dedup_exact(spark, sf_dir):
    order = (
        "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    )
    lines = views.table(spark, sf_dir, "lineitem")
    return dedup.drop_exact_duplicates(lines, ["l_orderkey", "l_linenumber"], order)


@query(
    "dedup_texts",
    """select text, lang, min(doc_id) as doc_id, count(*) as n_copies
    from documents group by text, lang""",
)
def dedup_texts(spark, sf_dir):
    documents = views.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return dedup.group_copies(documents, ["text", "lang"], ["doc_id"])


@query(
    "dedup_report",
    """with g as (select count(*) as n from lineitem group by l_orderkey, l_linenumber)
    select cast(sum(n) as bigint) as n_rows_before, count(*) as n_rows_after,
    cast(coalesce(sum(n) filter (where n > 1), 0) as bigint) as n_rows_in_duplicate_groups,
    count(*) filter (where n > 1) as n_duplicate_groups,
    cast(sum(n - 1) as bigint) as n_removed from g""",
)
def dedup_report(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    return dedup.duplicate_report(lines, ["l_orderkey", "l_linenumber"])


# --- labels ----------------------------------------------------------------

@query(
    "target_main",
    """select o_orderkey as unit_id, o_orderstatus as target_class,
    case when o_orderstatus = 'P' then 1 else 0 end as target from orders""",
)
def target_main(spark, sf_dir):
    return _targets(spark, sf_dir).select("unit_id", "target_class", "target")


@query(
    "target_sensitivity",
    """select o_orderkey as unit_id, case o_orderstatus when 'P' then 1 when 'F' then 0 end
    as target_excl_enrolled from orders""",
)
def target_sensitivity(spark, sf_dir):
    return _targets(spark, sf_dir).select("unit_id", "target_excl_enrolled")


def _targets(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("unit_id"), F.col("o_orderstatus").alias("target_raw")
    )
    return cleaning.add_targets(orders, UNITS.target, UNITS.positive, UNITS.negative)


_SUMMARY_SQL = f"""select 'principal' as target, count(*) filter (where c = 'P') as positives,
    count(*) filter (where c <> 'P') as negatives, cast(0 as bigint) as excluded,
    count(*) as total, {r("count(*) filter (where c = 'P') / count(*)")} as positive_share from t
    union all select 'sensibilidade', count(*) filter (where c = 'P'),
    count(*) filter (where c = 'F'), count(*) filter (where c = 'O'),
    count(*) filter (where c in ('P', 'F')),
    {r("count(*) filter (where c = 'P') / count(*) filter (where c in ('P', 'F'))")} from t"""


@query("target_summary", f"with t as (select o_orderstatus as c from orders) {_SUMMARY_SQL}")
def target_summary(spark, sf_dir):
    return shown(cleaning.target_summary(_targets(spark, sf_dir)))


# --- features and scenarios ------------------------------------------------

def _ratio_sql(top: str, bottom: str) -> str:
    return f"coalesce(cast({top} as double) / nullif({bottom}, 0), 0.0)"


_RATE_1, _RATE_2 = (_ratio_sql(f"approved_{i}", f"enrolled_{i}") for i in (1, 2))
_LOST_1, _LOST_2 = (
    f"coalesce(cast(greatest(enrolled_{i} - approved_{i}, 0) as double), 0.0)" for i in (1, 2)
)
_EVALUATED = _ratio_sql("evaluations_1", "enrolled_1")


@query(
    "features_s1",
    f"""with {SQL_GAPPY} select unit_id, {r(_RATE_1)} as taxa_aprovacao_1sem,
    case when enrolled_1 is null then 0.0 else {_LOST_1} end as disciplinas_nao_aprovadas_1sem,
    {r(_EVALUATED)} as razao_avaliacoes_inscrito_1sem from gappy""",
)
def features_s1(spark, sf_dir):
    gappy = views.gappy_units(spark, sf_dir, customers=False).select("unit_id", *views.PERIOD_1)
    return shown(derive_features(gappy, UNITS.roles).select("unit_id", *UNITS.roles.first_period))


@query(
    "features_s2",
    f"""with {SQL_GAPPY} select unit_id, {r(_RATE_2)} as taxa_aprovacao_2sem,
    {_LOST_2} as disciplinas_nao_aprovadas_2sem,
    {r(f'{_RATE_2} - {_RATE_1}')} as delta_taxa_aprovacao,
    {r('coalesce(grade_2 - grade_1, 0.0)')} as delta_grau,
    cast(coalesce(no_eval_1, 0) + coalesce(no_eval_2, 0) as double) as total_sem_avaliacoes
    from gappy""",
)
def features_s2(spark, sf_dir):
    gappy = views.gappy_units(spark, sf_dir, customers=False)
    return shown(derive_features(gappy, UNITS.roles).select("unit_id", *UNITS.roles.second_period))


_EARLY_SQL = f"""cat_priority, cat_segment, cat_nation, bin_debtor, num_admission, enrolled_1,
    approved_1, evaluations_1, grade_1, no_eval_1, {r(_RATE_1)} as taxa_aprovacao_1sem,
    {_LOST_1} as disciplinas_nao_aprovadas_1sem,
    {r(_EVALUATED)} as razao_avaliacoes_inscrito_1sem"""


@query("scenario_projection", f"with {SQL_UNITS} select unit_id, {_EARLY_SQL} from units")
def scenario_projection(spark, sf_dir):
    units = views.units(spark, sf_dir)
    return shown(scenarios.project_scenario(units, views.EARLY, UNITS.roles, keep=("unit_id",)))


@query(
    "ablation_projection",
    f"""with {SQL_UNITS} select * exclude (bin_debtor) from
    (select unit_id, {_EARLY_SQL} from units)""",
)
def ablation_projection(spark, sf_dir):
    units = scenarios.drop_group(views.units(spark, sf_dir), views.BINARY)
    return shown(
        scenarios.project_scenario(units, views.NO_FINANCIAL, UNITS.roles, keep=("unit_id",))
    )


@query(
    "conform_columns",
    """select o_orderkey as unit_id, cast(o_totalprice as double) as num_admission,
    cast(null as double) as num_absent, o_orderpriority as cat_priority,
    try_cast(o_orderstatus as bigint) as cnt_status from orders""",
)
def conform_columns(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").withColumnsRenamed(
        {
            "o_orderkey": "unit_id",
            "o_totalprice": "num_admission",
            "o_orderpriority": "cat_priority",
            "o_orderstatus": "cnt_status",
        }
    )
    expected = [
        ("num_admission", "double"),
        ("num_absent", "double"),
        ("cat_priority", "string"),
        ("cnt_status", "bigint"),
    ]
    return scenarios.conform_columns(orders, expected, keep=("unit_id",))


@query(
    "prepare_table",
    f"""with {SQL_UNITS}, p as (select * replace ({_repaired_sql('grade_1')} as grade_1,
      {_repaired_sql('grade_2')} as grade_2), target_raw as target_class,
      case when target_raw = 'P' then 1 else 0 end as target,
      case target_raw when 'P' then 1 when 'F' then 0 end as target_excl_enrolled from units)
    select * from p""",
)
def prepare_units(spark, sf_dir):
    raw = materialize(views.units(spark, sf_dir), "raw")
    folder = f"{checkpoint_dir(spark)}/prepared"
    return prepare_table(raw, UNITS, folder, order_by=["unit_id"], subset=UNITS.columns).table


@query(
    "clean_report",
    f"""with {SQL_UNITS}, r as (select *, {_repaired_sql('grade_1')} as fixed from units)
    select target_raw, case when target_raw = 'P' then 1 else 0 end as target,
    count(*) as n_rows, count(*) filter (where abs(grade_1) > 20) as n_corrected,
    {r('avg(fixed)')} as mean_grade from r group by target_raw""",
)
def clean_report(spark, sf_dir):
    """Rows, repaired rows and mean repaired grade per class and label."""
    units = views.units(spark, sf_dir, customers=False).select("target_raw", "grade_1")
    label = cleaning.main_target(F.col("target_raw"), UNITS.positive)
    return shown(
        units.groupBy("target_raw", label.alias("target")).agg(
            F.count("*").alias("n_rows"),
            F.count_if(is_out_of_scale(F.col("grade_1"), 20)).alias("n_corrected"),
            F.avg(repair_scale(F.col("grade_1"), 20)).alias("mean_grade"),
        )
    )
