"""Quantiles: bounded sketches, and exact answers that stay distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import settle

# A group with more distinct values than this is cut into slices.
DIRECT_LIMIT = 200_000


def approx_quantile(
    df: DataFrame, column: str, p: float, error: float = 1e-4, by: Sequence[str] = ()
) -> DataFrame:
    """Nearest-rank quantile from a mergeable sketch of bounded size."""
    value = F.percentile_approx(column, p, int(1 / error))
    return df.groupBy(*by).agg(value.alias("quantile"))


def group_median(df: DataFrame, by: Sequence[str], column: str, exact: bool = False) -> DataFrame:
    make = exact_quantile if exact else approx_quantile
    return make(df, column, 0.5, by=by).withColumnRenamed("quantile", "median")


def exact_quantile(
    df: DataFrame,
    column: str,
    p: float,
    by: Sequence[str] = (),
    direct_limit: int = DIRECT_LIMIT,
    slices: int | None = None,
) -> DataFrame:
    """Exact quantile with linear interpolation, one row per group; null is a group.

    Rows are first reduced to (group, value, frequency). Where every group has
    few distinct values Spark's weighted ``percentile`` answers. Beyond that a
    sketch of each group's distinct values supplies cut points; ranks are found
    from the slice totals, and only the slices holding the wanted ranks are
    ordered. The sketch only balances the slices: the counts are exact.
    """
    by = list(by)
    freq = settle(
        df.select(*by, F.col(column).cast("double").alias("value"))
        .filter("value is not null")
        .groupBy(*by, "value")
        .agg(F.count(F.lit(1)).alias("freq"))
    )
    return quantile_of_counts(freq, p, by, direct_limit, slices)


def quantile_of_counts(
    freq: DataFrame,
    p: float,
    by: Sequence[str] = (),
    direct_limit: int = DIRECT_LIMIT,
    slices: int | None = None,
) -> DataFrame:
    """``exact_quantile`` of stored value frequencies (by, value, freq): each value once a group."""
    by = list(by)
    largest = freq.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if largest <= direct_limit:
        return freq.groupBy(*by).agg(F.percentile("value", p, F.col("freq")).alias("quantile"))
    # a slice holds about half of what a group may hold undivided
    return _sliced_quantile(freq, by, p, slices or max(16, -(-2 * largest // max(direct_limit, 1))))


def _sliced_quantile(freq: DataFrame, by: list[str], p: float, slices: int) -> DataFrame:
    from .joins import attach

    cuts = [i / slices for i in range(1, slices)]
    bounds = freq.groupBy(*by).agg(
        F.percentile_approx("value", cuts, 10 * slices).alias("_cuts"),
        F.sum("freq").alias("_n"),
    )
    if by:
        cut = attach(freq, bounds, by, how="inner", null_safe=True)
    else:
        one = bounds.select(F.struct("_cuts", "_n")).scalar()
        cut = freq.withColumn("_b", one).select(*freq.columns, "_b._cuts", "_b._n")
    cut = settle(
        cut.withColumn("_slice", F.size(F.filter("_cuts", lambda b: b < F.col("value")))).drop("_cuts")
    )

    # wanted 0-based ranks: below and above the exact position
    position = F.lit(p) * (F.col("_n") - 1)
    totals = cut.groupBy(*by, "_slice", "_n").agg(F.sum("freq").alias("_rows"))
    order = Window.partitionBy(*by).orderBy("_slice")
    reached = F.sum("_rows").over(order)
    wanted = (
        totals.withColumn("_before", reached - F.col("_rows"))
        .withColumn("_until", reached)
        .filter((F.floor(position) < F.col("_until")) & (F.ceil(position) >= F.col("_before")))
        .select(*by, "_slice", "_before")
    )
    # at most two slices per group remain
    held = attach(cut, wanted, [*by, "_slice"], how="inner", null_safe=True)
    inside = Window.partitionBy(*by, "_slice").orderBy("value")
    upto = F.col("_before") + F.sum("freq").over(inside)
    held = held.withColumn("_until", upto).withColumn("_from", upto - F.col("freq"))

    def at(rank):
        return F.max(F.when((F.col("_from") <= rank) & (rank < F.col("_until")), F.col("value")))

    return (
        held.groupBy(*by)
        .agg(
            at(F.floor(position)).alias("_low"),
            at(F.ceil(position)).alias("_high"),
            F.max(position - F.floor(position)).alias("_w"),
        )
        .select(*by, (F.col("_low") + F.col("_w") * (F.col("_high") - F.col("_low"))).alias("quantile"))
    )
