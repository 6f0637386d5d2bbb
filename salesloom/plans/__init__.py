"""The ten business answers, each a function from tables to a result."""

from salesloom.plans.registry import ANSWERS, Answer

__all__ = ["ANSWERS", "Answer"]
