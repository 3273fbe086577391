"""Every registered query with SQL gives the rows DuckDB gives."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

from riskmill.plans import catalog


@pytest.fixture(scope="module")
def database(small):
    connection = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def comparable(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([normal(row[i]) for i in order] for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, small, database, name):
    df = catalog.QUERIES[name](spark, small)
    cursor = database.execute(catalog.SQL[name])
    names = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert comparable(df.columns, df.collect()) == comparable(names, cursor.fetchall())


@pytest.mark.parametrize("name", ["file_fingerprint", "preprocess_matrix", "pipeline_fit", "lr_scores", "score_batch"])
def test_query_without_sql_runs(spark, small, name):
    """The rest of these fit forests, boosting or many folds; their operators are tested on smaller rows in test_models."""
    assert name not in catalog.SQL and catalog.QUERIES[name](spark, small).count() > 0


def test_every_sql_has_a_query():
    assert set(catalog.SQL) <= set(catalog.QUERIES)
