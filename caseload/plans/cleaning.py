"""Cleaning: complete rows per state, oversampling, imputation, standard forms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F
from pyspark.sql import types as T

from .. import vocabulary as V
from ..functions.ages import parse_age
from ..functions.dates import fix_2020_date, parse_date_lenient
from ..operators.filters import null_count, require_columns
from ..operators.grouping import count_by, mode_of
from ..operators.joins import attach
from ..operators.quantiles import approx_quantile, group_median, quantile_of_counts
from ..operators.shape import union_states
from ..session import fresh_path, settle


UNKNOWN_FILLS = {c: V.UNKNOWN for c in ("victim_race", "victim_resident_status", "offender_race")}
RANGE_ROWS = 20_000  # rows of a group that one task orders, about


def clean_by_state(
    df: DataFrame,
    critical: Sequence[str] = V.CRITICAL_COLUMNS,
    min_rows: int = V.MIN_ROWS_PER_STATE,
    max_nulls: int = V.MAX_NULLS_PER_ROW,
    by: str = "state",
) -> DataFrame:
    """Rows complete in the critical columns; a state left with fewer than
    ``min_rows`` of them gets its rows with at most ``max_nulls`` nulls instead.

    One count per state decides, for all states at once. Rows without a state
    belong to no group and are left out.
    """
    critical = require_columns(df, critical)
    complete = F.lit(True)
    for c in critical:
        complete = complete & F.col(c).isNotNull()
    df = df.filter(F.col(by).isNotNull())
    plenty = (
        df.groupBy(by)
        .agg(F.count(F.when(complete, 1)).alias("_complete"))
        .select(by, (F.col("_complete") >= min_rows).alias("_plenty"))
    )
    columns = df.columns
    few_nulls = null_count(df) <= max_nulls
    return (
        attach(df, plenty, [by])
        .filter(F.when(F.col("_plenty"), complete).otherwise(few_nulls))
        .select(*columns)
    )


def row_change(before: DataFrame, after: DataFrame, by: str = "state") -> DataFrame:
    """(group, rows_in, rows_out, change) of a step."""
    sides = [
        count_by(before, by, name="n").select(by, F.col("n").alias("i"), F.lit(0).alias("o")),
        count_by(after, by, name="n").select(by, F.lit(0).alias("i"), F.col("n").alias("o")),
    ]
    return (
        union_states(sides)
        .groupBy(by)
        .agg(F.sum("i").alias("rows_in"), F.sum("o").alias("rows_out"))
        .withColumn("change", F.col("rows_out") - F.col("rows_in"))
    )


def oversample_to(
    df: DataFrame,
    target: int = V.MIN_ROWS_PER_STATE,
    by: str = "state",
    seed: int = V.SEED,
) -> DataFrame:
    """Every smaller group repeated to exactly ``target`` rows, others as they are.

    Each row of a short group appears floor(target / n) times; the remainder
    goes to the rows first in a seeded hash order. Repeatable. Rows without a
    group stay as they are.

    The rows are kept in the shared folder, since they are read four times. The
    hash order is cut into ranges whose number follows the target; the sizes of
    the ranges say which of them get one copy more as a whole, and only the one
    range of a group in which the remainder ends is shuffled and ordered.
    """
    columns = df.columns
    df = settle(df)
    bits = max(0, (target // RANGE_ROWS).bit_length())
    hashed = F.xxhash64(*columns, F.lit(seed))
    ranged = df.withColumn("_range", F.shiftright(hashed, 64 - bits) if bits else F.lit(0).cast("long"))
    counts = ranged.filter(F.col(by).isNotNull()).groupBy(by, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy(by)
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    copies = F.floor(F.lit(target) / F.col("_n")).cast("int")
    extra = F.lit(target) - copies * F.col("_n")
    # the range in which the remainder ends, and how many of its rows get one copy more
    cut = (
        counts.withColumns({"_n": F.sum("_rows").over(group), "_first": F.coalesce(F.sum("_rows").over(earlier), F.lit(0))})
        .filter(F.col("_n") < target)
        .withColumn("_left", extra - F.col("_first"))
        .filter((F.col("_left") >= 0) & (F.col("_left") < F.col("_rows")))
        .select(by, copies.alias("_copies"), F.col("_range").alias("_cut"), "_left")
    )
    sized = attach(ranged, cut, [by])
    enough = sized.filter(F.col("_cut").isNull()).select(*columns)
    whole = sized.filter(F.col("_range") != F.col("_cut")).withColumn("_more", F.col("_range") < F.col("_cut"))
    rank = F.row_number().over(group.orderBy(hashed, *columns))
    split = sized.filter(F.col("_range") == F.col("_cut")).withColumn("_more", rank <= F.col("_left"))
    repeated = (
        union_states([whole, split])
        .withColumn("_times", F.col("_copies") + F.col("_more").cast("int"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
        .select(*columns)
    )
    return union_states([enough, repeated])


def oversample_about(
    df: DataFrame,
    target: int = V.MIN_ROWS_PER_STATE,
    by: str = "state",
    seed: int = V.SEED,
) -> DataFrame:
    """Short groups repeated to ``target`` rows in expectation, without a sort.

    Each row appears floor(target / n) times and once more with probability
    equal to the remaining fraction, decided by a seeded hash of the row, so a
    task that runs again gives the same rows. Rows without a group stay as they
    are.
    """
    columns = df.columns
    sized = attach(df, count_by(df, by, name="_n"), [by], null_safe=True)
    mean = F.lit(target) / F.col("_n")
    resolution = 1 << 30
    uniform = F.pmod(F.xxhash64(*columns, F.lit(seed)), F.lit(resolution)) / resolution
    copies = F.floor(mean) + (uniform < mean - F.floor(mean)).cast("int")
    times = F.when(F.col(by).isNull() | (F.col("_n") >= target), F.lit(1)).otherwise(copies)
    return sized.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), times.cast("int")))
    ).select(*columns)


def impute(
    df: DataFrame,
    mode_columns: Sequence[str] = ("weapon_name",),
    constants: Mapping[str, str] | None = None,
    group_median_of: Mapping[str, str] | None = None,
    median_columns: Sequence[str] = ("incident_hour",),
    exact: bool = False,
    flag: bool = False,
) -> DataFrame:
    """Fill missing values.

    ``mode_columns`` by their most frequent value, ``constants`` by a text,
    ``group_median_of`` (column -> group column) by the median of the group,
    ``median_columns`` by the overall median. Medians are nearest-rank sketches;
    with ``exact`` all values come from ``learn_fills``, in one pass. With ``flag``,
    ``<column>_imputed`` marks filled values.

    Each sketched statistic is one aggregate. The one-row ones enter the plan as scalar
    subqueries, the per-group one as a counted broadcast: the rows themselves
    are not shuffled.
    """
    if exact:
        fills = learn_fills(df, mode_columns, constants or None, group_median_of or None, median_columns)
        return apply_fills(df, fills, flag)
    constants = constants or UNKNOWN_FILLS
    group_median_of = group_median_of or {"population": "state"}
    have = set(df.columns)
    out = df
    fills = {c: F.lit(text) for c, text in constants.items() if c in have}
    for c in mode_columns:
        if c in have:
            top = mode_of(df, c, fallback=f"Unknown_{c}").select("value").scalar()
            fills[c] = top
    for c in median_columns:
        if c in have:
            fills[c] = approx_quantile(df, c, 0.5).scalar().cast(df.schema[c].dataType)
    for c, by in group_median_of.items():
        if c in have:
            medians = group_median(df, [by], c).withColumnRenamed("median", f"_{c}_median")
            out = attach(out, medians, [by], null_safe=True)
            fills[c] = F.col(f"_{c}_median").cast(df.schema[c].dataType)
    filled = {c: F.coalesce(F.col(c), value).alias(c) for c, value in fills.items()}
    marks = [F.col(c).isNull().alias(f"{c}_imputed") for c in fills] if flag else []
    return out.select(*[filled.get(c, F.col(c)) for c in df.columns], *marks)


@dataclass(frozen=True)
class Fills:
    """Learned fill values: one row (value) for each column, or one for each group of it."""

    constants: Mapping[str, str]
    single: Mapping[str, DataFrame]
    grouped: Mapping[str, tuple[str, DataFrame]]


def learn_fills(
    df: DataFrame,
    mode_columns: Sequence[str] = ("weapon_name",),
    constants: Mapping[str, str] | None = None,
    group_median_of: Mapping[str, str] | None = None,
    median_columns: Sequence[str] = ("incident_hour",),
) -> Fills:
    """Fill values of all columns from one pass over the rows.

    One aggregate over grouping sets (one set for each statistic) counts how often every value
    occurs, summed before the shuffle; the counts are kept in the shared folder. Modes (ties to the
    smaller value) and exact medians, overall or by group, follow from the counts alone. Null is no
    value, but a group.
    """
    constants = {c: text for c, text in (UNKNOWN_FILLS if constants is None else constants).items() if c in df.columns}
    groups = {"population": "state"} if group_median_of is None else group_median_of
    sets = {c: (c,) for c in (*mode_columns, *median_columns) if c in df.columns}
    sets |= {c: (by, c) for c, by in groups.items() if c in df.columns}
    if not sets:
        return Fills(constants, {}, {})
    used = list(dict.fromkeys(c for s in sets.values() for c in s))
    counts = settle(
        df.select(*used)
        .groupingSets([list(s) for s in dict.fromkeys(sets.values())], *used)
        .agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("freq")),
        "value-counts",
    )

    def counted(c: str) -> DataFrame:
        # a bit of the grouping id is set for every column that is summed over
        mark = sum(1 << (len(used) - 1 - i) for i, u in enumerate(used) if u not in sets[c])
        return counts.filter((F.col("_set") == mark) & F.col(c).isNotNull())

    def values(c: str, *by: str) -> DataFrame:
        return counted(c).select(*by, F.col(c).cast("double").alias("value"), "freq")

    single, grouped = {}, {}
    for c in sets:
        kind = df.schema[c].dataType
        if c in groups:
            medians = quantile_of_counts(values(c, groups[c]), 0.5, [groups[c]])
            grouped[c] = groups[c], medians.select(groups[c], F.col("quantile").cast(kind).alias("value"))
        elif c in mode_columns:
            top = counted(c).orderBy(F.desc("freq"), c).limit(1)
            single[c] = top.agg(F.coalesce(F.first(c), F.lit(f"Unknown_{c}")).alias("value"))
        else:
            single[c] = quantile_of_counts(values(c), 0.5).select(F.col("quantile").cast(kind).alias("value"))
    return Fills(constants, single, grouped)


def apply_fills(df: DataFrame, fills: Fills, flag: bool = False) -> DataFrame:
    """Missing values of ``df`` filled; with ``flag``, ``<column>_imputed`` marks them. The rows may
    be others than those the fills were learned from; a group not met there stays unfilled."""
    values = {c: F.lit(text) for c, text in fills.constants.items()}
    values |= {c: one.scalar() for c, one in fills.single.items()}
    out = df
    for c, (by, medians) in fills.grouped.items():
        out = attach(out, medians.withColumnRenamed("value", f"_{c}_fill"), [by], null_safe=True)
        values[c] = F.col(f"_{c}_fill")
    filled = {c: F.coalesce(F.col(c), v).alias(c) for c, v in values.items()}
    marks = [F.col(c).isNull().alias(f"{c}_imputed") for c in values] if flag else []
    return out.select(*[filled.get(c, F.col(c)) for c in df.columns], *marks)


def standardise(
    df: DataFrame,
    ages: Sequence[str] = ("victim_age_group", "offender_age"),
    date: str = "incident_date",
    short_year: int = 2020,
    invalid_age: int = V.IMPOSSIBLE_AGE,
) -> tuple[DataFrame, DataFrame]:
    """Ages to integers, dates to DATE, impossible victim ages dropped.

    Returns the frame and a one-row frame of counters. Narrow operations only:
    no shuffle. A date text that does not parse is kept in ``<date>_text``.
    """
    kept = df.filter(~_is_age(df, ages[0], invalid_age)) if ages[0] in df.columns else df
    aged = kept.withColumns({c: _age(df, c) for c in ages if c in df.columns})
    if date in df.columns:
        fixed = fix_2020_date(date, "year", short_year)
        aged = aged.withColumn(f"{date}_text", fixed)
        aged = aged.withColumn(date, parse_date_lenient(f"{date}_text"))
    counters = {"rows_in": F.count(F.lit(1))}
    for c in ages:
        if c in df.columns:
            counters[f"{c}_converted"] = F.count(c)
    if ages[0] in df.columns:
        counters["rows_dropped"] = F.count(F.when(_is_age(df, ages[0], invalid_age), 1))
    if date in df.columns:
        counters["dates_fixed"] = F.count(F.when(F.col("year") == short_year, 1))
    metrics = df.agg(*[c.alias(n) for n, c in counters.items()])
    return aged, metrics


def standardise_observed(
    df: DataFrame,
    ages: Sequence[str] = ("victim_age_group", "offender_age"),
    date: str = "incident_date",
    short_year: int = 2020,
    invalid_age: int = V.IMPOSSIBLE_AGE,
    path: str | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """``standardise`` with its counters observed while the frame is written.

    The frame goes to ``path`` (Parquet; by default below the shared folder) and is read back; the
    counters are those of that one write: no second scan, and every age and date is parsed once.
    Rows are dropped above the point of observation, so that the counters see all of them. The write
    is one narrow stage, in which Spark counts each partition once, however often a task is run; a
    sort above the observation would sample the rows first and count them twice.
    """
    ages = [c for c in ages if c in df.columns]
    parsed = df.withColumns(
        {f"_given_{c}": F.col(c).isNotNull() for c in ages} | {c: _age(df, c) for c in ages}
        | ({f"{date}_text": fix_2020_date(date, "year", short_year)} if date in df.columns else {})
    )
    counters = {"rows_in": F.count(F.lit(1))}
    for c in ages:
        counters[f"{c}_converted"] = F.count(F.when(F.col(f"_given_{c}"), 1))
    kept = F.lit(True)
    if ages:
        invalid = F.coalesce(F.col(ages[0]) == invalid_age, F.lit(False))
        counters["rows_dropped"], kept = F.count(F.when(invalid, 1)), ~invalid
    if date in df.columns:
        parsed = parsed.withColumn(date, parse_date_lenient(f"{date}_text"))
        counters["dates_fixed"] = F.count(F.when(F.col("year") == short_year, 1))
    seen = Observation()
    observed = parsed.observe(seen, *[c.alias(n) for n, c in counters.items()])
    out = observed.filter(kept).drop(*[f"_given_{c}" for c in ages])
    path = path or fresh_path(df.sparkSession, "standardised")
    out.write.parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path), seen.get


def _is_age(df: DataFrame, column: str, age: int) -> Column:
    """Whether the column means this age; never null.

    The text is looked at before it is parsed: an age of three digits needs a
    number of three digits, which few texts hold.
    """
    exact = F.coalesce(_age(df, column) == age, F.lit(False))
    if isinstance(df.schema[column].dataType, T.NumericType):
        return exact
    possible = F.col(column).cast("string").rlike(rf"\d{{{len(str(age))}}}")
    return F.coalesce(possible, F.lit(False)) & exact


def _age(df: DataFrame, column: str) -> Column:
    """An age column that is a number already only has its gaps filled."""
    if isinstance(df.schema[column].dataType, T.NumericType):
        return F.coalesce(F.col(column), F.lit(V.UNKNOWN_AGE)).cast("int")
    return parse_age(column)
