"""Registered queries; importing the package fills the registry."""

from tidemark.plans import features, history, insight, joins, store, upkeep  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
