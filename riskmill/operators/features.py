"""Row features derived from two periods of activity."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from riskmill.functions.numeric import column_as_double, safe_ratio, shortfall
from riskmill.spec import FeatureRoles


@dataclass(frozen=True)
class Feature:
    """A derived column: the role of its name, the roles it needs, its formula over them."""

    name: str
    needs: tuple[str, ...]
    formula: Callable[..., Column]


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _ratio(top: Column, bottom: Column) -> Column:
    return safe_ratio(top, bottom)


def _ratio_change(top_1: Column, bottom_1: Column, top_2: Column, bottom_2: Column) -> Column:
    return safe_ratio(top_2, bottom_2) - safe_ratio(top_1, bottom_1)


#: Formulas are fixed values; the order is that of the new columns.
FEATURES = (
    Feature("approval_rate_1", ("approved_1", "enrolled_1"), _ratio),
    Feature("not_approved_1", ("approved_1", "enrolled_1"), shortfall),
    Feature("evaluation_ratio_1", ("evaluations_1", "enrolled_1"), _ratio),
    Feature("approval_rate_2", ("approved_2", "enrolled_2"), _ratio),
    Feature("not_approved_2", ("approved_2", "enrolled_2"), shortfall),
    Feature("approval_rate_change", ("approved_1", "enrolled_1", "approved_2", "enrolled_2"), _ratio_change),
    Feature("grade_change", ("grade_1", "grade_2"), lambda first, second: _or_zero(second - first)),
    Feature(
        "no_evaluation_total",
        ("no_evaluation_1", "no_evaluation_2"),
        lambda first, second: _or_zero(first) + _or_zero(second),
    ),
)


def possible_features(columns: Sequence[str], roles: FeatureRoles) -> list[Feature]:
    """Features whose source columns are all among ``columns``."""
    have = set(columns)
    return [f for f in FEATURES if all(getattr(roles, role) in have for role in f.needs)]


def derived_names(columns: Sequence[str], roles: FeatureRoles) -> list[str]:
    """Names of the columns that ``derive_features`` adds to ``columns``."""
    return [getattr(roles, f.name) for f in possible_features(columns, roles)]


def derive_features(df: DataFrame, roles: FeatureRoles) -> DataFrame:
    """Add the derived columns whose source columns exist.

    Every formula reads its own row only, so nothing can leak between the rows of
    a training and a test part.
    """
    new = {
        getattr(roles, f.name): f.formula(*(column_as_double(df, getattr(roles, r)) for r in f.needs))
        for f in possible_features(df.columns, roles)
    }
    return df.withColumns(new) if new else df
