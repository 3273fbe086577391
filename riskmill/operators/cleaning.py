"""Cleaning: scale repair with its evidence, consistency rules, label columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from riskmill.functions.numeric import (
    column_as_double,
    count_where,
    is_out_of_scale,
    is_whole,
    ratio_or_null,
    ratio_or_zero,
    repair_scale,
)
from riskmill.operators.order_stats import SMALL_DISTINCT, quantiles_and_aggregates
from riskmill.spec import TARGET_CLASS, TARGET_MAIN, TARGET_SENSITIVITY, TableSpec


# --- scale repair ----------------------------------------------------------

def repair_columns(df: DataFrame, columns: Sequence[str], max_valid: float = 20.0) -> DataFrame:
    """Repair lost decimal points in the given columns; absent ones are skipped."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: repair_scale(column_as_double(df, c), max_valid) for c in present})


def repair_statistics(
    df: DataFrame, columns: Sequence[str], max_valid: float = 20.0
) -> DataFrame:
    """Per column: values, repaired values, share, range before and after.

    One aggregate serves all columns.
    """
    # The repair is a column of its own first, so that it runs once per value.
    values, aggregates, rows = statistics_parts(df, columns, max_valid)
    return df.select(*values).agg(*aggregates).select(F.inline(rows))


def statistics_parts(
    df: DataFrame, columns: Sequence[str], max_valid: float, after: Mapping[str, Column] | None = None
) -> tuple[list[Column], list[Column], Column]:
    """``repair_statistics`` in three steps: a projection, aggregates of it, and the array of rows from these.

    ``after`` has repaired values that ``df`` holds already.
    """
    present = [c for c in columns if c in df.columns]
    values = []
    for i, c in enumerate(present):
        before = column_as_double(df, c)
        repaired = after[c] if after else repair_scale(before, max_valid)
        values += [before.alias(f"before{i}"), repaired.alias(f"after{i}")]
    aggregates = []
    for i in range(len(present)):
        before, after = F.col(f"before{i}"), F.col(f"after{i}")
        aggregates += [
            F.count(before).alias(f"n{i}"),
            count_where(is_out_of_scale(before, max_valid)).alias(f"repaired{i}"),
            F.min(before).alias(f"min_before{i}"),
            F.max(before).alias(f"max_before{i}"),
            F.min(after).alias(f"min_after{i}"),
            F.max(after).alias(f"max_after{i}"),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"n{i}").alias("n_values"),
            F.col(f"repaired{i}").alias("n_corrected"),
            (ratio_or_zero(F.col(f"repaired{i}"), F.col(f"n{i}")) * 100.0).alias("pct_corrected"),
            *[
                F.col(f"{bound}_{when}{i}").alias(f"{bound}_{when}")
                for when in ("before", "after")
                for bound in ("min", "max")
            ],
        )
        for i, name in enumerate(present)
    ]
    return values, aggregates, F.array(*rows)


def repair_examples(
    df: DataFrame, column: str, order_by: Sequence[str], max_valid: float = 20.0, n: int = 5
) -> DataFrame:
    """The first ``n`` repaired values, before and after."""
    before = column_as_double(df, column)
    return (
        df.where(is_out_of_scale(before, max_valid))
        .orderBy(*order_by)
        .limit(n)
        .select(*order_by, before.alias("before"), repair_scale(before, max_valid).alias("after"))
    )


def all_repair_examples(
    df: DataFrame, columns: Sequence[str], order_by: Sequence[str], max_valid: float = 20.0, n: int = 5
) -> DataFrame:
    """``repair_examples`` of several columns from one read, as (item, *order_by, before, after).

    ``item`` is the position of the column. Every task hands on at most ``n`` rows per column.
    """
    cells = []
    for i, column in enumerate(columns):
        before = column_as_double(df, column)
        cell = F.struct(F.lit(i).alias("item"), *order_by, before.alias("before"))
        cells.append(F.when(is_out_of_scale(before, max_valid), cell))
    broken = df.select(F.inline(F.array_compact(F.array(*cells))))
    place = F.row_number().over(Window.partitionBy("item").orderBy(*order_by))
    first = broken.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")
    return first.withColumn("after", repair_scale(F.col("before"), max_valid))


def all_in_scale(df: DataFrame, columns: Sequence[str], max_valid: float = 20.0) -> DataFrame:
    """Per column: do all present values lie in ``[0, max_valid]``?"""
    inside = lambda v: v.isNull() | v.between(F.lit(0.0), F.lit(float(max_valid)))
    verdicts = df.agg(
        *[
            F.coalesce(F.bool_and(inside(column_as_double(df, c))), F.lit(True)).alias(f"ok{i}")
            for i, c in enumerate(columns)
        ]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"ok{i}").alias("ok"))
        for i, c in enumerate(columns)
    ]
    return verdicts.select(F.inline(F.array(*rows)))


def consistency_check(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Rows with no approval but a positive grade, per (grade, approvals) pair.

    Each grade is compared with the approvals of its own period. A pair with an
    absent column is reported as not ok with an unknown count.
    """
    values, aggregates, rows = consistency_parts(df, pairs)
    return df.select(*values).agg(F.lit(1).alias("_"), *aggregates).select(F.inline(rows))


def consistency_parts(
    df: DataFrame, pairs: Mapping[str, str], prefix: str = "violation", after: Mapping[str, Column] | None = None
) -> tuple[list[Column], list[Column], Column]:
    """``consistency_check`` in three steps: a projection, aggregates of it, and the array of rows from these.

    With ``after``, its repaired values are compared in place of the grades.
    """
    values, aggregates, rows = [], [], []
    for i, (grade, approved) in enumerate(pairs.items()):
        found = F.lit(None).cast("bigint")
        if grade in df.columns and approved in df.columns:
            value = after[grade] if after else column_as_double(df, grade)
            values.append(((F.col(approved) == 0) & (value > 0)).alias(f"{prefix}{i}"))
            found = F.col(f"n_{prefix}{i}")
            aggregates.append(count_where(F.col(f"{prefix}{i}")).alias(f"n_{prefix}{i}"))
        rows.append(
            F.struct(
                F.lit(grade).alias("grade_column"),
                F.lit(approved).alias("approved_column"),
                F.coalesce(found == 0, F.lit(False)).alias("ok"),
                found.alias("n_violations"),
            )
        )
    return values, aggregates, F.array(*rows)


def one_row(df: DataFrame, row: Row) -> DataFrame:
    """A collected aggregate row as a table; nulls keep a numeric type."""
    kinds = {bool: "boolean", int: "bigint"}
    schema = ", ".join(
        f"`{name}` {kinds.get(type(value), 'double')}" for name, value in row.asDict().items()
    )
    return df.sparkSession.createDataFrame([tuple(row)], schema)


def _groups(
    df: DataFrame, column: str, max_valid: float, after: Mapping[str, Column] | None
) -> tuple[Column, Column, Column]:
    """Untouched positive values, repaired values, and these before the repair."""
    raw = column_as_double(df, column)
    broken = is_out_of_scale(raw, max_valid)
    return (
        F.when(~broken & (raw > 0), raw),
        F.when(broken, after[column] if after else repair_scale(raw, max_valid)),
        F.when(broken, raw),
    )


def repair_distribution(
    df: DataFrame,
    columns: Sequence[str],
    max_valid: float = 20.0,
    small_distinct: int = SMALL_DISTINCT,
) -> DataFrame:
    """Compare repaired values with those that were never broken, per column.

    ``ok`` needs at least one repaired value, all of them in scale, and all of
    the broken originals whole numbers, as a lost decimal point leaves them.
    """
    values, aggregates, middles, rows = distribution_parts(df, columns, max_valid)
    medians, summary = quantiles_and_aggregates(
        df.select(*values), middles, aggregates, small_distinct=small_distinct
    )
    return one_row(df, summary).select(F.inline(rows(medians)))


def distribution_parts(
    df: DataFrame, columns: Sequence[str], max_valid: float, after: Mapping[str, Column] | None = None
) -> tuple[list[Column], list[Column], dict[tuple[str, str], Column], Callable[[Mapping], Column]]:
    """``repair_distribution`` in steps: a projection, aggregates and medians of it, and the array of rows from these."""
    present = [c for c in columns if c in df.columns]
    if not present:
        raise KeyError(f"none of the columns {list(columns)} found")
    kinds = ("untouched", "corrected", "broken")
    values = [
        value.alias(f"{kind}{i}")
        for i, c in enumerate(present)
        for kind, value in zip(kinds, _groups(df, c, max_valid, after))
    ]
    middles = {
        (c, kind): F.col(f"{kind}{i}")
        for i, c in enumerate(present)
        for kind in ("untouched", "corrected")
    }
    aggregates = []
    for i in range(len(present)):
        untouched, repaired, broken = (F.col(f"{kind}{i}") for kind in kinds)
        for kind, value in (("untouched", untouched), ("corrected", repaired)):
            aggregates += [
                F.count(value).alias(f"{kind}_n{i}"),
                F.avg(value).alias(f"{kind}_mean{i}"),
                F.min(value).alias(f"{kind}_min{i}"),
                F.max(value).alias(f"{kind}_max{i}"),
            ]
        inside = repaired.between(F.lit(0.0), F.lit(float(max_valid)))
        aggregates += [
            count_where(is_whole(broken)).alias(f"whole{i}"),
            F.coalesce(F.bool_and(inside), F.lit(True)).alias(f"inside{i}"),
        ]

    def row(i: int, name: str, medians: Mapping) -> Column:
        broken_n, whole = F.col(f"corrected_n{i}"), F.col(f"whole{i}")
        return (
            F.struct(
                F.lit(name).alias("column_name"),
                *[
                    F.lit(medians[name, kind]).cast("double").alias(f"{kind}_median")
                    if part == "median"
                    else F.col(f"{kind}_{part}{i}").alias(f"{kind}_{part}")
                    for kind in ("untouched", "corrected")
                    for part in ("n", "mean", "median", "min", "max")
                ],
                (F.col(f"corrected_mean{i}") - F.col(f"untouched_mean{i}")).alias(
                    "mean_difference"
                ),
                F.col(f"inside{i}").alias("all_corrected_within_scale"),
                whole.alias("n_corrupted_integers"),
                broken_n.alias("n_corrupted"),
                (ratio_or_null(whole, broken_n) * 100.0).alias("pct_corrupted_integers"),
                ((broken_n > 0) & F.col(f"inside{i}") & (whole == broken_n)).alias("ok"),
            )
        )

    return values, aggregates, middles, lambda medians: F.array(*[row(i, c, medians) for i, c in enumerate(present)])


# --- labels ----------------------------------------------------------------

def main_target(label: Column, positive: str) -> Column:
    """1 for the positive class, 0 for every other; a missing label stays missing."""
    return F.when(label == positive, 1).when(label.isNotNull(), 0)


def sensitivity_target(label: Column, positive: str, negative: str) -> Column:
    """1 / 0 for the two clear classes, null for anything else."""
    return F.when(label == positive, 1).when(label == negative, 0)


def add_targets(df: DataFrame, target: str, positive: str, negative: str) -> DataFrame:
    """Add the original class as text and both binary labels.

    A raw label whose name differs from a new column only in case ("Target")
    gives way to it, because Spark's names ignore case unless the session says
    otherwise. Its values stay in the class column.
    """
    if target not in df.columns:
        raise KeyError(f"label column {target!r} not found")
    label = F.col(target).cast("string")
    new = {
        TARGET_CLASS: label,
        TARGET_MAIN: main_target(label, positive),
        TARGET_SENSITIVITY: sensitivity_target(label, positive, negative),
    }
    cased = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    taken = set(new) if cased else {name.lower() for name in new}
    kept = [c for c in df.columns if (c if cased else c.lower()) not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in new.items()])


def target_summary(df: DataFrame) -> DataFrame:
    """Positives, negatives, excluded rows, total and positive share per target."""
    aggregates, rows = target_parts(df)
    return df.agg(*aggregates).select(F.inline(rows))


def target_parts(df: DataFrame) -> tuple[list[Column], Column]:
    """``target_summary`` in two steps: aggregates, and the array of rows from these."""
    names = {"principal": TARGET_MAIN, "sensibilidade": TARGET_SENSITIVITY}
    present = {k: c for k, c in names.items() if c in df.columns}
    aggregates = [
        column
        for key, name in present.items()
        for column in (
            count_where(F.col(name) == 1).alias(f"{key}_p"),
            count_where(F.col(name) == 0).alias(f"{key}_n"),
            count_where(F.col(name).isNull()).alias(f"{key}_x"),
            F.count(name).alias(f"{key}_t"),
        )
    ]
    rows = [
        F.struct(
            F.lit(key).alias("target"),
            F.col(f"{key}_p").alias("positives"),
            F.col(f"{key}_n").alias("negatives"),
            F.col(f"{key}_x").alias("excluded"),
            F.col(f"{key}_t").alias("total"),
            ratio_or_null(F.col(f"{key}_p"), F.col(f"{key}_t")).alias("positive_share"),
        )
        for key in present
    ]
    return aggregates, F.array(*rows)
