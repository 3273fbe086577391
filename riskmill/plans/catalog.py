"""All registered queries."""

from __future__ import annotations

from riskmill.plans import (  # noqa: F401  (each module registers its queries)
    cleaning_queries,
    metric_queries,
    model_queries,
    result_queries,
)
from riskmill.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
