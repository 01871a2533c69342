"""Imports every query module, so that the registry is complete."""

from tidemark.plans import drift, jobs, monitor, pit, quality, rolling, train  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
