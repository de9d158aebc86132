"""All registered queries."""

from __future__ import annotations

from cartwheel.plans import (  # noqa: F401 - importing registers
    queries_analytics,
    queries_models,
    queries_quality,
    queries_sources,
)
from cartwheel.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
