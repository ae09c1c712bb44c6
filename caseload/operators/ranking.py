"""Top-k, change over time and label codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import vocabulary as V
from ..functions.numbers import pct
from ..session import settle


def top_n(df: DataFrame, by: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The n largest rows; each task keeps n, so no full sort takes place."""
    return df.orderBy(F.desc(by), *ties).limit(n)


def top_per_group(
    df: DataFrame, group: Sequence[str], by: str, n: int = 1, ties: Sequence[str] = ()
) -> DataFrame:
    """The n largest rows of each group with their rank.

    The rank filter is pushed below the shuffle as a group limit: a map task
    sends at most n rows per group.
    """
    window = Window.partitionBy(*group).orderBy(F.desc(by), *ties)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)


def yoy(
    counts: DataFrame, period: str = "year", value: str = "count", by: Sequence[str] = ()
) -> DataFrame:
    """Change against the previous period, on a counted frame.

    Without ``by`` the window has one partition: one row per period.
    """
    window = Window.partitionBy(*by).orderBy(period) if by else Window.orderBy(period)
    return (
        counts.withColumn("previous", F.lag(value).over(window))
        .withColumn("change", F.col(value) - F.col("previous"))
        .withColumn("percent_change", pct("change", "previous"))
    )


def total_change(
    counts: DataFrame, by: Sequence[str], period: str = "year", value: str = "count"
) -> DataFrame:
    """Sum of the yearly changes per group."""
    changes = yoy(counts, period, value, by)
    return changes.groupBy(*by).agg(F.sum("change").alias("total_change"))


def lag_month(
    monthly: DataFrame,
    keys: Sequence[str] = ("state", "county"),
    value: str = "crime_count",
    gaps: str = "observed",
) -> DataFrame:
    """Count of the previous month per key, 0 where there is none.

    ``gaps='observed'`` takes the previous month present in the data;
    ``'calendar'`` gives 0 unless it is the month directly before.
    """
    window = Window.partitionBy(*keys).orderBy("year", "month")
    last = F.lag(value, 1, 0).over(window)
    if gaps == "calendar":
        index = F.col("year") * 12 + F.col("month")
        last = F.when(index - F.lag(index).over(window) == 1, last).otherwise(F.lit(0))
    elif gaps != "observed":
        raise ValueError(f"unknown gap policy: {gaps}")
    return monthly.withColumn("crime_last_month", last)


def sort_weekday(df: DataFrame, column: str = "DayOfWeek") -> DataFrame:
    """Monday first."""
    position = F.array_position(F.array(*[F.lit(d) for d in V.WEEKDAYS]), F.col(column))
    return df.orderBy(position)


def sort_by_metric(df: DataFrame, metric: str, ties: Sequence[Column | str] = ()) -> DataFrame:
    return df.orderBy(F.desc(metric), *ties)


def label_code(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """(label, code): dense 0-based codes of the distinct labels in text order.

    The distinct labels are range-partitioned, numbered inside each partition
    and shifted by the sizes of the partitions before, so any number of labels
    works without one task seeing all of them.
    """
    name = name or f"{column}_idx"
    labels = df.select(F.col(column).cast("string").alias(column)).filter(F.col(column).isNotNull())
    ranged = settle(
        labels.distinct()
        .repartitionByRange(column)
        .withColumn("_part", F.spark_partition_id())
    )
    # one row per partition, so the offsets are bounded by the partition count
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(column)) - 1
    return (
        ranged.withColumn("_row", inside)
        .join(F.broadcast(offsets), "_part")
        .select(column, (F.col("_row") + F.col("_offset")).cast("int").alias(name))
    )
