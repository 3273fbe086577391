"""Views over the given tables that have the shape the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskmill.functions.numeric import count_where
from riskmill.spec import FeatureRoles, FieldRule, Scenario, TableSpec

ROLES = FeatureRoles(
    enrolled_1="enrolled_1",
    approved_1="approved_1",
    evaluations_1="evaluations_1",
    grade_1="grade_1",
    no_evaluation_1="no_eval_1",
    enrolled_2="enrolled_2",
    approved_2="approved_2",
    grade_2="grade_2",
    no_evaluation_2="no_eval_2",
)
CATEGORICAL = ("cat_priority", "cat_segment", "cat_nation")
BINARY = ("bin_debtor",)
PERIOD_1 = ("enrolled_1", "approved_1", "evaluations_1", "grade_1", "no_eval_1")
PERIOD_2 = ("enrolled_2", "approved_2", "grade_2", "no_eval_2")
EARLY = Scenario(
    "early_warning",
    "Early Warning",
    CATEGORICAL + BINARY + ("num_admission",) + PERIOD_1 + ROLES.first_period,
)
FULL = Scenario("full", "Completo", EARLY.columns + PERIOD_2 + ROLES.second_period)
NO_FINANCIAL = EARLY.without(
    "early_warning_no_financial", "Early Warning sem financeiras", BINARY
)

UNITS = TableSpec(
    columns=(
        "unit_id", "target_raw", *CATEGORICAL, *BINARY, "num_admission", *PERIOD_1, *PERIOD_2,
    ),
    categorical=CATEGORICAL,
    binary=BINARY,
    target="target_raw",
    positive="P",
    negative="F",
    ambiguous="O",
    grades={"grade_1": "approved_1", "grade_2": "approved_2"},
    roles=ROLES,
    scenarios={s.key: s for s in (EARLY, FULL, NO_FINANCIAL)},
    rules={
        rule.column: rule
        for rule in (
            FieldRule("cat_priority", "categorical", "3-MEDIUM"),
            FieldRule("bin_debtor", "binary", 0),
            FieldRule("num_admission", "numeric", 150000.0, minimum=0.0, maximum=400000.0),
            FieldRule("enrolled_1", "numeric", 2, minimum=0.0, maximum=5.0),
            FieldRule("grade_1", "numeric", 12.5, minimum=0.0, maximum=20.0),
            FieldRule("grade_2", "numeric", 12.5, minimum=0.0, maximum=20.0),
        )
    },
    options={"cat_priority": ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")},
    types={
        "unit_id": "bigint",
        "bin_debtor": "int",
        **{c: "string" for c in ("target_raw", *CATEGORICAL)},
        **{c: "bigint" for c in (*PERIOD_1, *PERIOD_2) if not c.startswith("grade")},
    },
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def units(spark: SparkSession, sf_dir: str, customers: bool = True) -> DataFrame:
    """One row per order with the activity of its lines in two periods.

    Lines are aggregated before the join, so an order with very many lines is
    merged on the map side and the join is one row to one row. Queries that need
    no customer columns leave the join with customers out: an outer join cannot
    be optimized away, and it would shuffle all orders once more.
    """
    lines = table(spark, sf_dir, "lineitem")
    first, second = F.col("l_linestatus") == "F", F.col("l_linestatus") == "O"
    flag = F.col("l_returnflag")
    activity = lines.groupBy("l_orderkey").agg(
        count_where(first).alias("enrolled_1"),
        count_where(first & (flag == "A")).alias("approved_1"),
        F.sum(F.when(first, F.col("l_linenumber").cast("bigint"))).alias("evaluations_1"),
        F.max(F.when(first, F.col("l_extendedprice"))).alias("grade_1"),
        count_where(first & (flag == "N")).alias("no_eval_1"),
        count_where(second).alias("enrolled_2"),
        count_where(second & (flag == "A")).alias("approved_2"),
        F.max(F.when(second, F.col("l_extendedprice"))).alias("grade_2"),
        count_where(second & (flag == "N")).alias("no_eval_2"),
    )
    orders = table(spark, sf_dir, "orders").join(
        activity, F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    of_customer = []
    if customers:
        people = table(spark, sf_dir, "customer").join(
            table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
        )
        orders = orders.join(people, F.col("o_custkey") == F.col("c_custkey"), "left")
        of_customer = [
            F.col("c_mktsegment").alias("cat_segment"),
            F.col("n_name").alias("cat_nation"),
            F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("bin_debtor"),
        ]
    return orders.fillna({c: 0 for c in (*PERIOD_1, *PERIOD_2)}).select(
        F.col("o_orderkey").alias("unit_id"),
        F.col("o_orderstatus").alias("target_raw"),
        F.col("o_orderpriority").alias("cat_priority"),
        *of_customer,
        F.col("o_totalprice").alias("num_admission"),
        *PERIOD_1,
        *PERIOD_2,
    )


def gappy_units(spark: SparkSession, sf_dir: str, customers: bool = True) -> DataFrame:
    """``units`` with missing values in numbers, flags and categories."""
    hole = lambda c, v: F.nullif(F.col(c), F.lit(v))
    holes = {
        "enrolled_1": hole("enrolled_1", 0),
        "grade_1": hole("grade_1", 0.0),
        "cat_priority": hole("cat_priority", "2-HIGH"),
    }
    if customers:
        holes["cat_segment"] = hole("cat_segment", "BUILDING")
        holes["bin_debtor"] = F.when(F.col("evaluations_1") > 0, F.col("bin_debtor"))
    return units(spark, sf_dir, customers).withColumns(holes)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label and a deterministic score with ties for every order."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("unit_id"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("y"),
        (((key * 7919) % 1000).cast("double") / F.lit(1000.0)).alias("s"),
    )


def fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-fold training and validation values of models, by scenario and metric."""
    ten = F.lit(10.0)
    averages = (
        table(spark, sf_dir, "lineitem")
        .withColumn("fold", F.col("l_suppkey") % 5)
        .groupBy("l_returnflag", "l_linestatus", "l_linenumber", "fold")
        .agg(
            F.avg(F.col("l_discount") * ten).alias("f2"),
            F.avg(F.col("l_tax") * ten).alias("recall"),
            F.avg("l_quantity").alias("quantity"),
        )
    )
    return averages.unpivot(
        ["l_returnflag", "l_linestatus", "l_linenumber", "fold", "quantity"],
        ["f2", "recall"],
        "metric",
        "cv_value",
    ).select(
        F.col("l_returnflag").alias("scenario"),
        F.when(F.col("l_linestatus") == "F", "default").otherwise("tuned").alias("stage"),
        F.lit("principal").alias("target"),
        F.concat(F.lit("m"), F.col("l_linenumber").cast("string")).alias("model"),
        "metric",
        "fold",
        "cv_value",
        (F.col("cv_value") + F.col("quantity") / F.lit(1000.0)).alias("train_value"),
    )


# The same views as SQL, as common table expressions.
SQL_UNITS = """units as (
  select o.o_orderkey as unit_id, o.o_orderstatus as target_raw,
    o.o_orderpriority as cat_priority, c.c_mktsegment as cat_segment, n.n_name as cat_nation,
    case when c.c_acctbal < 0 then 1 else 0 end as bin_debtor, o.o_totalprice as num_admission,
    count(l.l_orderkey) filter (where l.l_linestatus='F') as enrolled_1,
    count(l.l_orderkey) filter (where l.l_linestatus='F' and l.l_returnflag='A') as approved_1,
    cast(coalesce(sum(l.l_linenumber) filter (where l.l_linestatus='F'), 0) as bigint)
      as evaluations_1,
    coalesce(max(l.l_extendedprice) filter (where l.l_linestatus='F'), 0.0) as grade_1,
    count(l.l_orderkey) filter (where l.l_linestatus='F' and l.l_returnflag='N') as no_eval_1,
    count(l.l_orderkey) filter (where l.l_linestatus='O') as enrolled_2,
    count(l.l_orderkey) filter (where l.l_linestatus='O' and l.l_returnflag='A') as approved_2,
    coalesce(max(l.l_extendedprice) filter (where l.l_linestatus='O'), 0.0) as grade_2,
    count(l.l_orderkey) filter (where l.l_linestatus='O' and l.l_returnflag='N') as no_eval_2
  from orders o left join customer c on o.o_custkey=c.c_custkey
    left join nation n on c.c_nationkey=n.n_nationkey
    left join lineitem l on l.l_orderkey=o.o_orderkey
  group by o.o_orderkey, o.o_orderstatus, o.o_orderpriority, c.c_mktsegment, n.n_name,
    c.c_acctbal, o.o_totalprice)"""
SQL_GAPPY = (
    SQL_UNITS
    + """, gappy as (
  select * replace (nullif(enrolled_1, 0) as enrolled_1, nullif(grade_1, 0.0) as grade_1,
    nullif(cat_priority, '2-HIGH') as cat_priority,
    nullif(cat_segment, 'BUILDING') as cat_segment,
    case when evaluations_1 > 0 then bin_debtor end as bin_debtor) from units)"""
)
SQL_SCORED = """scored as (
  select o_orderkey as unit_id, case when o_orderstatus='P' then 1 else 0 end as y,
    cast((o_orderkey*7919)%1000 as double)/1000 as s from orders)"""
SQL_FOLD_SCORES = """fold_scores as (
  select l_returnflag as scenario,
    case when l_linestatus='F' then 'default' else 'tuned' end as stage,
    'principal' as target, concat('m', cast(l_linenumber as varchar)) as model,
    t.metric as metric, l_suppkey % 5 as fold,
    avg(case when t.metric='f2' then l_discount*10 else l_tax*10 end) as cv_value,
    avg(case when t.metric='f2' then l_discount*10 else l_tax*10 end) + avg(l_quantity)/1000
      as train_value
  from lineitem cross join (values ('f2'),('recall')) as t(metric)
  group by l_returnflag, l_linestatus, l_linenumber, t.metric, l_suppkey % 5)"""
SQL_RESULTS = (
    SQL_FOLD_SCORES
    + """, results as (
  select scenario, stage, target, model, metric, avg(cv_value) as cv_mean,
    stddev_pop(cv_value) as cv_std, avg(train_value) as train_mean,
    avg(train_value) - avg(cv_value) as gap
  from fold_scores group by scenario, stage, target, model, metric)"""
)
