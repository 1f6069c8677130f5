"""Mappings from bronze tables to the canonical silver tables."""

from zilverspoor.plans import civil, social  # noqa: F401  (registers the mappings)
from zilverspoor.plans.registry import MAPPINGS, Bronze, build, plan_all

__all__ = ["MAPPINGS", "Bronze", "build", "plan_all"]
