from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bindings import views_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, like: str | None = None) -> Callable[[Query], Query]:
    """Register a query; views named in its SQL are put in front of it. ``like`` names an earlier
    query whose SQL it must equal as well."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = _with_views(sql)
        if like is not None:
            SQL[name] = SQL[like]
        return fn

    return add


def _with_views(sql: str) -> str:
    views = views_sql(lambda view: re.search(rf"\b{view}\b", sql) is not None)
    if not views:
        return sql
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {views}, {body[5:]}"
    return f"with {views} {body}"
