"""Projections: feature scenarios, ablations and conforming of incoming rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskmill.operators.features import derive_features
from riskmill.spec import FeatureRoles, Scenario


def resolve_scenario(
    df: DataFrame, scenario: Scenario, roles: FeatureRoles
) -> tuple[list[str], list[str]]:
    """Input columns of a scenario and its columns after feature derivation.

    Names are read off the schema of the lazy plan, so no job runs.
    """
    derived = set(roles.derived)
    inputs = [c for c in scenario.columns if c not in derived and c in df.columns]
    available = set(derive_features(df.select(*inputs), roles).columns)
    return inputs, [c for c in scenario.columns if c in available]


def project_scenario(
    df: DataFrame, scenario: Scenario, roles: FeatureRoles, keep: Sequence[str] = ()
) -> DataFrame:
    """The columns of a scenario after feature derivation, in scenario order."""
    inputs, final = resolve_scenario(df, scenario, roles)
    wanted = list(dict.fromkeys([*keep, *inputs]))
    return derive_features(df.select(*wanted), roles).select(
        *keep, *[c for c in final if c not in set(keep)]
    )


def drop_group(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """Ablation: the table without a group of columns."""
    return df.drop(*group)


def conform_columns(
    df: DataFrame, expected: Sequence[tuple[str, str]], keep: Sequence[str] = ()
) -> DataFrame:
    """Bring rows to an expected layout of ``(name, type)`` pairs.

    Absent columns become null, values that do not fit the type too, extra columns
    are dropped and the order is fixed.
    """
    have = set(df.columns)
    columns = [
        (F.col(name).try_cast(kind) if name in have else F.lit(None).cast(kind)).alias(name)
        for name, kind in expected
        if name not in set(keep)
    ]
    return df.select(*keep, *columns)
