"""Profiles: missing cells, class balance, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskmill.functions.numeric import count_where


def _is_missing(df: DataFrame, name: str):
    value = F.col(name)
    if df.schema[name].dataType.simpleString() in ("double", "float"):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing cells per column, columns without any left out; one aggregate."""
    values, aggregates, rows = missing_parts(df, list(columns or df.columns))
    return df.select(*values).agg(*aggregates).select(F.inline(rows))


def missing_parts(df: DataFrame, names: Sequence[str]) -> tuple[list[Column], list[Column], Column]:
    """``missing_profile`` in three steps: a projection, aggregates of it, and the array of rows from these."""
    values = [_is_missing(df, c).alias(f"missing{i}") for i, c in enumerate(names)]
    aggregates = [count_where(F.col(f"missing{i}")).alias(f"n_missing{i}") for i in range(len(names))]
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"n_missing{i}").alias("n_missing"))
        for i, c in enumerate(names)
    ]
    return values, aggregates, F.filter(F.array(*rows), lambda row: row["n_missing"] > 0)


def positive_rate(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.avg(label).alias("positive_rate"))


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Equal-width histogram between the smallest and the largest value.

    The range is a one-row aggregate read as a scalar subquery. The largest value
    belongs to the last bin. Empty bins have no row.
    """
    value = F.col(column).cast("double")
    low = df.agg(F.min(value)).scalar()
    high = df.agg(F.max(value)).scalar()
    width = (high - low) / F.lit(float(bins))
    position = F.floor((value - low) / F.nullif(width, F.lit(0.0))) + 1
    return (
        df.where(value.isNotNull())
        .select(F.least(F.coalesce(position, F.lit(1)), F.lit(bins)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
        .select(
            "bin",
            (low + (F.col("bin") - 1) * width).alias("bin_start"),
            (low + F.col("bin") * width).alias("bin_end"),
            "n",
        )
    )
