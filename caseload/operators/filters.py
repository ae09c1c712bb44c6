"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from .. import vocabulary as V


def violent(
    df: DataFrame,
    categories: Sequence[str] = V.VIOLENT_CATEGORIES,
    column: str = "offense_category",
) -> DataFrame:
    return df.filter(F.col(column).isin(*categories))


def filter_not_in(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is not listed; a null value is not kept."""
    return df.filter(~F.col(column).isin(*values))


def firearm_only(df: DataFrame, column: str = "weapon_name") -> DataFrame:
    return df.filter(is_firearm(column))


def is_firearm(column: str = "weapon_name") -> Column:
    return F.lower(F.col(column)).rlike(V.FIREARM_PATTERN)


def is_night(column: str = "incident_hour") -> Column:
    return F.col(column).isin(*V.NIGHT_HOURS)


def night_only(df: DataFrame, column: str = "incident_hour") -> DataFrame:
    return df.filter(is_night(column))


def require_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns, or an error that names those the frame lacks."""
    if absent := [c for c in columns if c not in df.columns]:
        raise ValueError(f"critical columns are missing: {absent}")
    return list(columns)


def drop_incomplete(df: DataFrame, columns: Sequence[str] = V.CRITICAL_COLUMNS) -> DataFrame:
    return df.na.drop(subset=require_columns(df, columns))


def null_count(df: DataFrame) -> Column:
    """Number of null columns in a row."""
    return reduce(add, [F.col(c).isNull().cast("int") for c in df.columns], F.lit(0))


def max_nulls(df: DataFrame, n: int = V.MAX_NULLS_PER_ROW) -> DataFrame:
    return df.filter(null_count(df) <= n)


def drop_invalid_age(
    df: DataFrame, age: int = V.IMPOSSIBLE_AGE, column: str = "victim_age_group"
) -> DataFrame:
    """Drop one impossible age; rows without an age stay."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(age)))


def select_year(df: DataFrame, year: int, column: str = "year") -> DataFrame:
    return df.filter(F.col(column) == year)


def select_category(
    df: DataFrame, category: str, column: str = "offense_category"
) -> DataFrame:
    return df.filter(F.col(column) == category)

