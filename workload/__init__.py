"""Registered queries: the operators applied to the given tables, each beside the SQL that states its result."""

from workload import clean, evaluate, explain, features, models, pricing, profile, results
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "clean", "evaluate", "explain", "features", "models", "pricing", "profile", "results"]
