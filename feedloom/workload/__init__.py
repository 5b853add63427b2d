"""Queries over the benchmark tables, each with a SQL text that must give the same rows."""

from feedloom.workload import item_queries, report_queries, store_queries  # noqa: F401
from feedloom.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
