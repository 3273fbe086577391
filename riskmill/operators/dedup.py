"""Removal of exact duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

COPIES = "n_copies"


def group_copies(df: DataFrame, subset: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """First row of every group of equal rows, with the size of the group.

    This is an aggregate and not a window, so copies are merged before the
    shuffle and a group that covers a third of the table is a few rows per task.
    ``order_by`` says which copy is first and must end in a unique column. Where
    it is one column and all others are compared, the buffer is a single value
    and the aggregate hashes; otherwise whole rows are compared.
    """
    rest = [c for c in df.columns if c not in set(subset)]
    if len(order_by) == 1 and rest == list(order_by):
        first = F.min(order_by[0]).alias(order_by[0])
        return df.groupBy(*subset).agg(first, F.count("*").alias(COPIES)).select(
            *df.columns, COPIES
        )
    kept = F.min_by(F.struct(*rest) if rest else F.lit(1), F.struct(*order_by))
    grouped = df.groupBy(*subset).agg(kept.alias("_first"), F.count("*").alias(COPIES))
    return grouped.select(
        *[F.col(c) if c in set(subset) else F.col(f"_first.{c}").alias(c) for c in df.columns],
        COPIES,
    )


def drop_exact_duplicates(
    df: DataFrame, subset: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Keep the first of every group of rows that are equal on ``subset``."""
    return group_copies(df, subset, order_by).drop(COPIES)


def duplicate_report(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """One row: rows before and after, duplicate groups, rows in them, rows removed."""
    sizes = df.groupBy(*subset).agg(F.count("*").alias("n"))
    return summarize_copies(sizes, "n")


def summarize_copies(groups: DataFrame, size: str = COPIES) -> DataFrame:
    """The duplicate report from a table that has one row per distinct row."""
    return groups.agg(*copy_totals(size))


def copy_totals(size: str = COPIES) -> list[Column]:
    """Aggregates of the duplicate report."""
    n, repeated = F.col(size), F.col(size) > 1
    total = lambda value: F.coalesce(F.sum(value), F.lit(0)).cast("bigint")
    return [
        total(n).alias("n_rows_before"),
        F.count("*").alias("n_rows_after"),
        total(F.when(repeated, n)).alias("n_rows_in_duplicate_groups"),
        F.count(F.when(repeated, 1)).alias("n_duplicate_groups"),
        total(n - 1).alias("n_removed"),
    ]
