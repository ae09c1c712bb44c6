"""Operators of a training-data pipeline, their queries and SQL.

Nothing else in the package imports this subpackage.
"""

from . import manifest_query, queries, runs_query, sharding_query
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "manifest_query", "queries", "runs_query", "sharding_query"]
