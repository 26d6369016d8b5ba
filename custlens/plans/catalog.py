"""All named queries: importing the plan modules registers them."""

from custlens.plans import fitted, lines, mining, scoring  # noqa: F401
from custlens.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
