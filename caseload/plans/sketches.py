"""Sketches of each state and year in a table, and longer spans merged from them.

``stored_sketches`` makes one row for each group and column: a distinct-count sketch of a text column,
a quantile sketch of a numeric one, of bounded size whatever the rows. Merging rows gives the sketch of
the union, so distinct counts and quantiles over any years and states follow from the table alone,
and a new state-year costs only its own rows (``sources.replace_partitions``).

The relative standard error of a distinct count is 1.04 / sqrt(2 ** ``LOG_BUCKETS``), 1.6%, merged or not;
a merged sketch holds the same buckets as one of all rows, but estimates without the order of
arrival, so the two differ within that error. Quantiles are values of the column whose rank is
within ``RANK_ERROR`` of the wanted one, with 99% confidence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.shape import long_rows

LOG_BUCKETS = 12
QUANTILE_K = 400
RANK_ERROR = 0.01
DISTINCT, QUANTILES = "distinct", "quantiles"


def stored_sketches(
    df: DataFrame, texts: Sequence[str], numbers: Sequence[str], by: Sequence[str] = ("state", "year"),
) -> DataFrame:
    """(by, column, kind, rows, sketch) from one pass; rows are summed up before the shuffle. Null is
    no value but a group; ``rows`` counts the values."""
    made = {f"t{i}": F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LOG_BUCKETS)) for i, c in enumerate(texts)}
    made |= {f"n{i}": F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(QUANTILE_K)) for i, c in enumerate(numbers)}
    counts = {f"r{name}": F.count(c) for name, c in (*((f"t{i}", c) for i, c in enumerate(texts)), *((f"n{i}", c) for i, c in enumerate(numbers)))}
    wide = df.groupBy(*by).agg(*[c.alias(n) for n, c in (made | counts).items()])
    entries = [
        {"column": F.lit(c), "kind": F.lit(kind), "rows": F.col(f"r{mark}{i}"), "sketch": F.col(f"{mark}{i}")}
        for kind, mark, columns in ((DISTINCT, "t", texts), (QUANTILES, "n", numbers)) for i, c in enumerate(columns)
    ]
    return long_rows(wide, entries, keep=list(by))


def distinct_counts(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, column, distinct): about how many values the text columns have in each group."""
    kept = sketches.filter(F.col("kind") == DISTINCT)
    merged = kept.groupBy(*by, "column").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"))
    return merged.select(*by, "column", "distinct")


def quantiles(sketches: DataFrame, p: float, by: Sequence[str] = ()) -> DataFrame:
    """(by, column, quantile) of the numeric columns in each group; null without values."""
    kept = sketches.filter((F.col("kind") == QUANTILES) & (F.col("rows") > 0))
    merged = kept.groupBy(*by, "column").agg(F.kll_merge_agg_double("sketch").alias("_sketch"))
    return merged.select(*by, "column", F.kll_sketch_get_quantile_double("_sketch", F.lit(p)).alias("quantile"))
