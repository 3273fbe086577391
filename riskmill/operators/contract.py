"""Table contract: schema check, value ranges, defaults, category options."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from riskmill.functions.durable import take_bounded
from riskmill.functions.numeric import column_as_double, count_where
from riskmill.spec import FieldRule


#: Distinct values of a class column beyond which it is no class column.
MAX_CLASSES = 100_000


class SchemaError(ValueError):
    """A table lacks required columns or holds classes outside the contract."""


@dataclass
class SchemaReport:
    ok: bool
    n_rows: int
    n_cols: int
    missing_columns: list[str]
    unexpected_columns: list[str]
    dtypes: dict[str, str]
    unexpected_classes: dict[str, int]
    class_counts: DataFrame | None

    @property
    def has_unexpected_classes(self) -> bool:
        return bool(self.unexpected_classes)

    def as_dict(self) -> dict:
        """All of the report but the counts table, ready for JSON."""
        plain = {k: v for k, v in vars(self).items() if k != "class_counts"}
        return {**plain, "has_unexpected_classes": self.has_unexpected_classes}


def column_differences(
    actual: Sequence[str], expected: Sequence[str]
) -> tuple[list[str], list[str]]:
    """Names only in ``expected`` and names only in ``actual``, in their order."""
    missing = [c for c in expected if c not in set(actual)]
    unexpected = [c for c in actual if c not in set(expected)]
    return missing, unexpected


def schema_difference(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One row per column that is missing from or unexpected in ``df``."""
    missing, unexpected = column_differences(df.columns, expected)
    rows = [("missing_column", c) for c in missing]
    rows += [("unexpected_column", c) for c in unexpected]
    return df.sparkSession.createDataFrame(rows, "issue string, subject string")


def class_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value combination; missing values are counted like any other."""
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows"))


def unexpected_classes(df: DataFrame, target: str, classes: Sequence[str]) -> DataFrame:
    """Classes outside the contract with their row counts; null is one of them."""
    label = F.coalesce(F.col(target).cast("string"), F.lit("nan"))
    return class_counts(df.select(label.alias("class")), "class").where(
        ~F.col("class").isin(list(classes))
    )


def _as_text(counts: DataFrame, target: str) -> list[tuple[str | None, int]]:
    """The counted classes as Spark writes them as text; ``counts`` is a local table, so no job runs."""
    return [tuple(row) for row in counts.select(F.col(target).cast("string"), "n_rows").collect()]


def schema_issues(
    df: DataFrame, expected: Sequence[str], target: str, classes: Sequence[str]
) -> DataFrame:
    """All deviations from the contract as rows ``(issue, subject, n_rows)``."""
    issues = schema_difference(df, expected).withColumn("n_rows", F.lit(None).cast("bigint"))
    if target in df.columns:
        issues = issues.unionByName(
            unexpected_classes(df, target, classes).select(
                F.lit("unexpected_class").alias("issue"), F.col("class").alias("subject"), "n_rows"
            )
        )
    return issues


def validate_schema(
    df: DataFrame,
    expected: Sequence[str],
    target: str,
    classes: Sequence[str],
    raise_on_missing: bool = True,
) -> SchemaReport:
    """Check a table against the contract.

    Missing columns and unknown classes raise when asked to; extra columns are
    only reported. Column checks read the schema and run no job.
    """
    missing, unexpected = column_differences(df.columns, expected)
    if raise_on_missing and missing:
        raise SchemaError(f"missing columns: {', '.join(missing)}")

    counts, strange, n_rows = None, {}, None
    if target in df.columns:
        counted = class_counts(df, target)
        rows = take_bounded(counted, MAX_CLASSES, f"classes in {target}")
        counts = df.sparkSession.createDataFrame(rows, counted.schema)
        n_rows = sum(row["n_rows"] for row in rows)
        for name, n in sorted(("nan" if value is None else value, n) for value, n in _as_text(counts, target)):
            if name not in classes:
                strange[name] = strange.get(name, 0) + n
        if raise_on_missing and strange:
            names = ", ".join(strange)
            raise SchemaError(f"unexpected classes in {target}: {names}")

    return SchemaReport(
        ok=not (missing or unexpected or strange),
        n_rows=df.count() if n_rows is None else n_rows,
        n_cols=len(df.columns),
        missing_columns=missing,
        unexpected_columns=unexpected,
        dtypes=dict(df.dtypes),
        unexpected_classes=strange,
        class_counts=counts,
    )


def rule_violations(
    df: DataFrame,
    rules: Sequence[FieldRule],
    options: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Rows that break each rule, from one aggregate over the table.

    Numeric columns must lie in their range, flags must be 0 or 1, categories
    must be among the options where these are given. Missing values break no
    rule.
    """
    options = options or {}
    checks = []
    for rule in rules:
        if rule.column not in df.columns:
            continue
        value = F.col(rule.column)
        if rule.kind == "binary":
            checks.append((rule.column, "not_a_flag", ~value.isin(0, 1)))
        elif rule.kind == "categorical":
            if rule.column in options:
                known = list(options[rule.column])
                checks.append((rule.column, "unknown_category", ~value.isin(known)))
        else:
            number = column_as_double(df, rule.column)
            if rule.minimum is not None:
                checks.append((rule.column, "below_minimum", number < F.lit(rule.minimum)))
            if rule.maximum is not None:
                checks.append((rule.column, "above_maximum", number > F.lit(rule.maximum)))
    if not checks:
        return df.sparkSession.createDataFrame(
            [], "column_name string, issue string, n_rows bigint"
        )
    counted = df.agg(*[count_where(test).alias(f"c{i}") for i, (_, _, test) in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(column).alias("column_name"),
            F.lit(issue).alias("issue"),
            F.col(f"c{i}").alias("n_rows"),
        )
        for i, (column, issue, _) in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def fill_defaults(df: DataFrame, rules: Mapping[str, FieldRule]) -> DataFrame:
    """Replace missing values by the default of each column's rule."""
    filled = {
        column: F.coalesce(
            F.nanvl(F.col(column), F.lit(None)) if kind == "double" else F.col(column),
            F.lit(rules[column].default).cast(kind),
        )
        for column, kind in df.dtypes
        if column in rules
    }
    return df.withColumns(filled)


def category_options(
    df: DataFrame, column: str, fallback: Sequence[str] = ()
) -> DataFrame:
    """Distinct non-missing values of a column as text, sorted.

    Where the column is absent or empty, the fallback list is returned instead.
    """
    spare = df.sparkSession.createDataFrame([(o,) for o in sorted(fallback)], "option string")
    if column not in df.columns:
        return spare.orderBy("option")
    seen = df.select(F.col(column).cast("string").alias("option")).dropna().distinct()
    if fallback and seen.isEmpty():
        return spare.orderBy("option")
    return seen.orderBy("option")
