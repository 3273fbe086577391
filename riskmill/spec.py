"""Descriptions of a table: its columns, groups, classes, scenarios and rules.

Operators take names and constants as arguments; a ``TableSpec`` is where a
dataset keeps them together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field


@dataclass(frozen=True)
class FieldRule:
    """Value contract of one column."""

    column: str
    kind: str  # "categorical", "binary" or "numeric"
    default: object
    group: str = "Geral"
    minimum: float | None = None
    maximum: float | None = None


@dataclass(frozen=True)
class Scenario:
    """A named list of model features, raw and derived."""

    key: str
    label: str
    columns: tuple[str, ...]

    def without(self, key: str, label: str, group: Sequence[str]) -> "Scenario":
        """The same scenario with a group of columns left out."""
        return Scenario(key, label, tuple(c for c in self.columns if c not in set(group)))


@dataclass(frozen=True)
class FeatureRoles:
    """Columns behind the derived features of two periods, and their names."""

    enrolled_1: str
    approved_1: str
    evaluations_1: str
    grade_1: str
    no_evaluation_1: str
    enrolled_2: str
    approved_2: str
    grade_2: str
    no_evaluation_2: str
    approval_rate_1: str = "taxa_aprovacao_1sem"
    not_approved_1: str = "disciplinas_nao_aprovadas_1sem"
    evaluation_ratio_1: str = "razao_avaliacoes_inscrito_1sem"
    approval_rate_2: str = "taxa_aprovacao_2sem"
    not_approved_2: str = "disciplinas_nao_aprovadas_2sem"
    approval_rate_change: str = "delta_taxa_aprovacao"
    grade_change: str = "delta_grau"
    no_evaluation_total: str = "total_sem_avaliacoes"

    @property
    def first_period(self) -> tuple[str, ...]:
        return (self.approval_rate_1, self.not_approved_1, self.evaluation_ratio_1)

    @property
    def second_period(self) -> tuple[str, ...]:
        return (
            self.approval_rate_2,
            self.not_approved_2,
            self.approval_rate_change,
            self.grade_change,
            self.no_evaluation_total,
        )

    @property
    def derived(self) -> tuple[str, ...]:
        return self.first_period + self.second_period


@dataclass(frozen=True)
class TableSpec:
    """Everything the preparation and modelling jobs need to know of a table."""

    columns: tuple[str, ...]
    categorical: tuple[str, ...]
    binary: tuple[str, ...]
    target: str
    positive: str
    negative: str
    ambiguous: str
    # grade column -> column that counts approvals of the same period
    grades: Mapping[str, str]
    roles: FeatureRoles
    scenarios: Mapping[str, Scenario]
    rules: Mapping[str, FieldRule] = field(default_factory=dict)
    options: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    types: Mapping[str, str] = field(default_factory=dict)
    max_grade: float = 20.0

    @property
    def classes(self) -> tuple[str, ...]:
        return (self.positive, self.negative, self.ambiguous)

    def type_of(self, column: str) -> str:
        return self.types.get(column, "double")


# Names of the prepared label columns and of the two targets.
TARGET_CLASS = "target_class"
TARGET_MAIN = "target"
TARGET_SENSITIVITY = "target_excl_enrolled"
TARGETS = {"principal": TARGET_MAIN, "sensibilidade": TARGET_SENSITIVITY}

# Protocol constants.
SEED = 42
TEST_SIZE = 0.30
FOLDS = 5
MIN_FREQUENCY = 10
SIMPLICITY_MARGIN = 0.01
GAP_TOLERANCE = 0.05
METRICS = ("accuracy", "precision", "recall", "f1", "f2", "roc_auc")
THRESHOLDS = (0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60)
CURVE_SHARES = (0.15, 0.3, 0.45, 0.6, 0.8, 1.0)
CURVE_C = (0.001, 0.01, 0.1, 1.0, 10.0, 100.0)
