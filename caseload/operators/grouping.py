"""Counts, shares, rates and pivots.

Every operator aggregates first, with map-side partial sums, so a value that
holds most of the rows still crosses the shuffle as one row per map task.
Totals are then taken from the small counted frame, never from a second scan
joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import vocabulary as V
from ..functions.numbers import indicator_sum, pct, rate


def count_by(
    df: DataFrame, *keys: str, drop_null_keys: bool = False, name: str = "count"
) -> DataFrame:
    if drop_null_keys:
        df = df.filter(" and ".join(f"`{k}` is not null" for k in keys))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def sum_by(df: DataFrame, *keys: str, column: str = "count", name: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(column).alias(name or column))


def mean_by(df: DataFrame, *keys: str, column: str, name: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(column).alias(name or column))


def row_of_max(df: DataFrame, column: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the largest value; ties go to the smallest tie column."""
    return df.orderBy(F.desc(column), *ties).limit(1)


def mode_of(df: DataFrame, column: str, fallback: str | None = None) -> DataFrame:
    """One row (value, count) of the most frequent non-null value.

    Equal counts go to the smaller value. Without any value the frame is empty,
    or holds the fallback with count 0 if one is given.
    """
    top = (
        count_by(df.select(F.col(column).alias("value")), "value", drop_null_keys=True)
        .orderBy(F.desc("count"), "value")
        .limit(1)
    )
    if fallback is None:
        return top
    return top.agg(
        F.coalesce(F.first("value"), F.lit(fallback)).alias("value"),
        F.coalesce(F.first("count"), F.lit(0)).cast("bigint").alias("count"),
    )


def share_of_total(df: DataFrame, *by: str, name: str = "count") -> DataFrame:
    """Count per group and its percentage of all rows."""
    counts = count_by(df, *by, name=name)
    total = counts.agg(F.sum(name)).scalar()
    return counts.withColumn("percent", pct(name, total))


def share_of_group(
    df: DataFrame, keys: Sequence[str], by: Sequence[str], name: str = "count"
) -> DataFrame:
    """Count per (by + keys) and its percentage within ``by``.

    The window runs over the counted frame: a partition holds one row per
    distinct detail value of a group, not the group's rows.
    """
    counts = count_by(df, *by, *keys, name=name)
    total = F.sum(name).over(Window.partitionBy(*by))
    return counts.withColumn("total", total).withColumn("percent", pct(name, "total"))


def subset_rate(
    df: DataFrame, by: Sequence[str], condition: Column, drop_zero: bool = False
) -> DataFrame:
    """Rows meeting a condition, all rows and the percentage, in one pass."""
    out = (
        df.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count(F.when(condition, 1)).alias("subset"),
        )
        .withColumn("percent", pct("subset", "total"))
    )
    return out.filter("subset > 0") if drop_zero else out


def unknown_rate(
    df: DataFrame,
    columns: Sequence[str] = V.UNKNOWN_RATE_COLUMNS,
    by: str = "state",
    unknown: str = V.UNKNOWN,
) -> DataFrame:
    """Unknown fields per row, by group; ranges from 0 to the column count."""
    unknowns = indicator_sum([F.col(c) == unknown for c in columns])
    return (
        df.groupBy(by)
        .agg(
            F.sum(unknowns).alias("total_unknowns"),
            F.count(F.lit(1)).alias("total_rows"),
        )
        .withColumn("unknown_rate", rate("total_unknowns", "total_rows", 1))
    )


def rate_per_100k(
    df: DataFrame, by: str = "state", unit: str = "county", null_unit: bool = True
) -> DataFrame:
    """Incidents per 100,000 people; people = sum over units of the largest
    population reported. Two small aggregates, the second on the first.

    Rows without a unit always count as incidents; ``null_unit`` says whether
    their population counts as that of one more unit.

    Without a population or unit column the count stands in for the rate.
    """
    if unit not in df.columns or "population" not in df.columns:
        counts = count_by(df, by, name="incidents")
        return counts.withColumn("rate", F.col("incidents").cast("double"))
    units = df.groupBy(by, unit).agg(
        F.max("population").alias("people"), F.count(F.lit(1)).alias("count")
    )
    return rate_of_units(units, by, unit, null_unit)


def rate_of_units(units: DataFrame, by: str, unit: str, null_unit: bool = True) -> DataFrame:
    """Rates from counted units, each with its count and people."""
    people = F.col("people") if null_unit else F.when(F.col(unit).isNotNull(), F.col("people"))
    return (
        units.groupBy(by)
        .agg(F.sum("count").alias("incidents"), F.sum(people).alias("population"))
        .withColumn("rate", rate("incidents", "population", 100_000))
    )


def crosstab(
    df: DataFrame, row: str, column: str, values: Sequence[str] | None = None
) -> DataFrame:
    """Counts of row value by column value, zero where there is none.

    Given values keep the schema stable and save the job that finds them.
    """
    grouped = count_by(df, row, column).groupBy(row)
    pivoted = grouped.pivot(column, list(values)) if values else grouped.pivot(column)
    return pivoted.agg(F.sum("count")).na.fill(0)


def crosstab_map(df: DataFrame, row: str, column: str) -> DataFrame:
    """(row, counts, total): a map from column value to count for each row value.

    The values are found when the query runs: building it starts no job and there may be any number
    of them, where a pivot needs to know its columns beforehand. Two aggregates, the second on the
    counts of the first; a map has no entry where a pivot has zero. Null is a row value, but no column.
    """
    counts = count_by(df.filter(F.col(column).isNotNull()), row, column)
    entries = F.sort_array(F.collect_list(F.struct(F.col(column).alias("key"), F.col("count").alias("value"))))
    return counts.groupBy(row).agg(F.map_from_entries(entries).alias("counts"), F.sum("count").alias("total"))


def pivot_share(
    df: DataFrame, row: str, column: str, values: Sequence[str], suffix: str = "_percent"
) -> DataFrame:
    """Crosstab restricted to the given values, with row total and percentages."""
    table = crosstab(df.filter(F.col(column).isin(*values)), row, column, values)
    table = table.withColumn("total", sum((F.col(v) for v in values[1:]), F.col(values[0])))
    return table.withColumns({f"{v}{suffix}": pct(v, "total") for v in values})
