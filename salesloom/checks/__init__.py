"""Registered queries over the given tables, each with SQL that checks it."""

from salesloom.checks import (  # noqa: F401  (they register on import)
    aggregates,
    answers,
    joins,
    projections,
    sources,
)
from salesloom.checks.registry import CHECKS, Check

__all__ = ["CHECKS", "Check"]
