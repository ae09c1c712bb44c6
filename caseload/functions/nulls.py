"""Missing values."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ._cols import as_col


def is_missing(c: Column | str, dtype: T.DataType, blank: bool = True) -> Column:
    """Null, blank text or NaN. The test follows the type: others would fail."""
    c = as_col(c)
    if blank and isinstance(dtype, T.StringType):
        return c.isNull() | (c == "")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def fill(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Replace nulls by a constant per column; absent columns are ignored."""
    return df.na.fill({k: v for k, v in values.items() if k in df.columns})


def first_present(*cs: Column | str) -> Column:
    return F.coalesce(*[as_col(c) for c in cs])
