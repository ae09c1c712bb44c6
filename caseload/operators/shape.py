"""Names, column order, unions and row shape."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schemas import DISPLAY_NAMES

# Characters replaced or removed in column names.
_TO_UNDERSCORE = " /-"
_REMOVED = "()."
_NAME_TABLE = str.maketrans({**{c: "_" for c in _TO_UNDERSCORE}, **{c: None for c in _REMOVED}})


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sanitize_name(name: str) -> str:
    return name.strip().translate(_NAME_TABLE)


def sanitize_columns(df: DataFrame) -> DataFrame:
    """One projection that renames every column."""
    return df.toDF(*[sanitize_name(c) for c in df.columns])


def rename_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def display(df: DataFrame) -> DataFrame:
    """Internal names to the display names used in files."""
    return rename_map(df, DISPLAY_NAMES)


def project_ordered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The requested columns that exist, in the requested order."""
    return df.select(*[F.col(_quoted(c)) for c in columns if c in df.columns])


def union_states(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Stack frames by column name; absent columns become null if allowed."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]
) -> DataFrame:
    """One row per key, the first in the stated order.

    ``row_number() = 1`` lets Spark keep one row per key in each map task, so
    a key with very many rows never travels whole.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def explode_counties(df: DataFrame, column: str = "county", pattern: str = "[;,]") -> DataFrame:
    """One row per county of a text such as 'A, B; C', title case, trimmed."""
    parts = F.explode(F.split(F.col(column), pattern))
    return df.withColumn(column, parts).withColumn(column, F.initcap(F.trim(column)))


def long_rows(
    row: DataFrame, entries: Sequence[Mapping[str, Column]], keep: Sequence[str] = ()
) -> DataFrame:
    """Turn each aggregate row into one row per entry (name -> expression)."""
    structs = [F.struct(*[c.alias(n) for n, c in e.items()]) for e in entries]
    return row.select(*keep, F.inline(F.array(*structs)))
