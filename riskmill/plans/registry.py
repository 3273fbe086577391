"""Registry of queries over the given tables and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its rows are checked."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def shown(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison, because engines add in different orders."""
    return df.select(
        *[
            F.round(c, digits).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


def r(expression: str, digits: int = 6) -> str:
    """The same rounding in SQL; adding zero removes a negative zero."""
    return f"(round(cast({expression} as double), {digits}) + 0)"
