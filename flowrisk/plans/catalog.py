"""All registered queries."""

from flowrisk.plans import (  # noqa: F401  (importing registers)
    queries_explore, queries_learn, queries_live, queries_prepare, queries_scoring, queries_trend,
)
from flowrisk.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
