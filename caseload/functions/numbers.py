"""Ratios, rounding and seasonal terms."""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from ._cols import as_col
from .text import as_number


def rate(a: Column | str, b: Column | str, per: float) -> Column:
    """a / b * per; null when b is 0 or null."""
    return F.try_divide(as_col(a), as_col(b)) * F.lit(float(per))


def pct(a: Column | str, b: Column | str) -> Column:
    return rate(a, b, 100)


def rate_or_zero(n: Column | str, population: Column | str, per: float = 1000.0) -> Column:
    """n / (population / per) where the population is positive, else 0."""
    people = as_col(population)
    return F.when(people > 0, as_col(n) / (people / F.lit(float(per)))).otherwise(F.lit(0.0))


def round2(c: Column | str) -> Column:
    return F.round(as_col(c), 2)


def pct_decimal(c: Column | str) -> Column:
    return as_col(c).cast("decimal(5,2)")


def log_count(c: Column | str) -> Column:
    return F.log1p(as_col(c))


def absolute(c: Column | str) -> Column:
    return F.abs(as_col(c))


def to_int(c: Column | str) -> Column:
    """Text such as '30' or '30.0' to int, other text to null."""
    return as_number(c).try_cast("int")


def season_sin(month: Column | str) -> Column:
    return F.sin(F.lit(2 * math.pi) * as_col(month) / 12)


def season_cos(month: Column | str) -> Column:
    return F.cos(F.lit(2 * math.pi) * as_col(month) / 12)


def indicator_sum(conditions: Iterable[Column]) -> Column:
    """How many of the conditions hold; a null condition counts as not held."""
    return reduce(add, [F.when(c, 1).otherwise(0) for c in conditions], F.lit(0))
