"""Queries over the test tables, each with the SQL that must give the same rows."""

from . import counts, edges, files, measures, models, quality, relational, shares, single_pass, upkeep
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "counts", "edges", "files", "measures", "models", "quality", "relational",
           "shares", "single_pass", "upkeep"]
