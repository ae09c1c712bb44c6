"""Profiling and rule checks.

A section is a set of aggregates and the layout of its rows. Alone, a section
is one aggregate over one scan; the full profile computes all of them together
and needs three scans: aggregates, outliers (which need the mean first) and
value counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from .. import vocabulary as V
from ..functions.nulls import is_missing
from ..functions.numbers import pct
from ..operators.grouping import count_by
from ..operators.ranking import top_n, top_per_group
from ..operators.shape import long_rows
from ..session import settle


@dataclass(frozen=True)
class Section:
    """Aggregates by unique name, and one entry per output row over them."""

    aggregates: Mapping[str, Column]
    rows: Sequence[Mapping[str, Column]]

    def columns(self) -> list[Column]:
        return [c.alias(name) for name, c in self.aggregates.items()]

    def over(self, df: DataFrame) -> DataFrame:
        return long_rows(df.agg(*self.columns()), self.rows)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not isinstance(f.dataType, T.NumericType)]


def _rows() -> Column:
    return F.count(F.lit(1))


def _overview(df: DataFrame) -> Section:
    return Section(
        {"rows": _rows()}, [{"rows": F.col("rows"), "columns": F.lit(len(df.columns))}]
    )


def overview(df: DataFrame) -> DataFrame:
    """Row count and number of columns."""
    return _overview(df).over(df)


def _missing(df: DataFrame, blank: bool) -> Section:
    counts = {
        f"missing{i}": F.count(F.when(is_missing(f.name, f.dataType, blank), 1))
        for i, f in enumerate(df.schema)
    }
    return Section(
        {"rows": _rows(), **counts},
        [
            {"column": F.lit(c), "missing": F.col(n), "percent": pct(n, "rows")}
            for c, n in zip(df.columns, counts)
        ],
    )


def missing_report(df: DataFrame, blank: bool = True) -> DataFrame:
    """(column, missing, percent): null, blank or NaN values of every column."""
    return _missing(df, blank).over(df)


_STATISTICS = {
    "count": F.count,
    "mean": F.avg,
    "stddev": F.stddev,
    "min": lambda c: F.min(c).cast("double"),
    "max": lambda c: F.max(c).cast("double"),
}


def _describe(columns: Sequence[str]) -> Section:
    return Section(
        {f"{n}{i}": make(c) for i, c in enumerate(columns) for n, make in _STATISTICS.items()},
        [
            {"column": F.lit(c), **{n: F.col(f"{n}{i}") for n in _STATISTICS}}
            for i, c in enumerate(columns)
        ],
    )


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, count, mean, stddev, min, max)."""
    return _describe(columns or numeric_columns(df)).over(df)


def zscore_outliers(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    k: float = 3.0,
    statistics: DataFrame | None = None,
) -> DataFrame:
    """(column, outliers): values more than k standard deviations off the mean.

    A column without spread has no outliers. The statistics, one row of
    ``mean<i>`` and ``stddev<i>``, enter the counting pass as a scalar subquery.
    """
    columns = list(columns or numeric_columns(df))
    if statistics is None:
        statistics = df.agg(*_describe(columns).columns())
    wanted = [f"{n}{i}" for i in range(len(columns)) for n in ("mean", "stddev")]
    judged = df.select(*columns).withColumn("_z", statistics.select(F.struct(*wanted)).scalar())

    def far(i: int, c: str) -> Column:
        distance = F.try_divide(F.col(c) - F.col(f"_z.mean{i}"), F.col(f"_z.stddev{i}"))
        return F.abs(distance) > k

    counted = {f"outliers{i}": F.count(F.when(far(i, c), 1)) for i, c in enumerate(columns)}
    rows = [{"column": F.lit(c), "outliers": F.col(n)} for c, n in zip(columns, counted)]
    return Section(counted, rows).over(judged)


def _cardinality(columns: Sequence[str]) -> Section:
    sketches = {f"distinct{i}": F.approx_count_distinct(c) for i, c in enumerate(columns)}
    return Section(
        {"rows": _rows(), **sketches},
        [
            {"column": F.lit(c), "distinct": F.col(n), "ratio": F.try_divide(F.col(n), F.col("rows"))}
            for c, n in zip(columns, sketches)
        ],
    )


def cardinality_report(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = False
) -> DataFrame:
    """(column, distinct, ratio) of the categorical columns.

    The default is a sketch per column in one pass; ``exact`` counts the
    distinct (column, value) pairs, which spreads every column over all tasks.
    """
    columns = list(columns or categorical_columns(df))
    if not exact:
        return _cardinality(columns).over(df)
    found = value_counts(df, columns).groupBy("column").agg(
        F.count("value").alias("distinct"), F.sum("count").alias("_rows")
    )
    return found.select("column", "distinct", F.try_divide("distinct", "_rows").alias("ratio"))


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, count) for all columns from one scan."""
    columns = list(columns or categorical_columns(df))
    pairs = long_rows(
        df, [{"column": F.lit(c), "value": F.col(c).cast("string")} for c in columns]
    )
    return count_by(pairs, "column", "value")


def top_values(df: DataFrame, columns: Sequence[str] | None = None, n: int = 10) -> DataFrame:
    """The n most frequent values of each column with their rank."""
    return _top_values(value_counts(df, columns), n)


def _top_values(counts: DataFrame, n: int) -> DataFrame:
    return top_per_group(counts, ["column"], "count", n, ties=["value"])


# the sketch's stated error: an untracked value occurs in at most 3.5 of ``tracked`` parts of the rows
SKETCH_ERROR = 3.5
CANDIDATES, ALL_VALUES = "candidates", "all values"


def top_values_by_candidates(
    df: DataFrame, columns: Sequence[str] | None = None, n: int = 10, tracked: int = 10_000
) -> tuple[DataFrame, DataFrame]:
    """``top_values`` for columns of many values: (top, how).

    One pass keeps a heavy-hitter sketch for each column, a second counts the ``20 * n`` values it puts
    first, and null, exactly. They are complete for a column if they cover all of its rows, or if the
    n-th of them occurs more often than the sketch's error and than the last value it put forward:
    no value that was left out can then reach the first n. Other columns, such as those of nearly unique
    values, are counted whole. ``how`` (column, method, bound) says which way each column went and how
    often a value that was not counted can occur at most. Both ways give the same rows.
    """
    columns = list(columns or categorical_columns(df))
    k = min(tracked, 20 * n)
    asked = {f"v{i}": F.expr(f"approx_top_k(cast(`{c}` as string), {k}, {tracked})") for i, c in enumerate(columns)}
    # columns * k values come to the driver
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(v) for v, c in asked.items()]).first()
    known = {c: [(x["item"], x["count"]) for x in row[f"v{i}"] or [] if x["item"] is not None] for i, c in enumerate(columns)}
    named = df.sparkSession.createDataFrame(
        [(c, v) for c in columns for v in [None, *[item for item, _ in known[c]]]], "_column string, _value string"
    )
    pairs = long_rows(df, [{"column": F.lit(c), "value": F.col(c).cast("string")} for c in columns])
    same = (F.col("column") == F.col("_column")) & F.col("value").eqNullSafe(F.col("_value"))
    counts = settle(count_by(pairs.join(F.broadcast(named), same, "left_semi"), "column", "value"))
    held = {r["column"]: r for r in counts.groupBy("column").agg(F.sum("count").alias("n"), F.sort_array(F.collect_list("count"), False).alias("all")).collect()}
    how = []
    for c in columns:
        covered, found = (held[c]["n"], held[c]["all"]) if c in held else (0, [])
        bound = 0 if covered == row["rows"] else int(SKETCH_ERROR * row["rows"] / tracked) + 1
        if bound and len(known[c]) >= k:
            bound = max(bound, known[c][-1][1])
        proven = not bound or (len(found) >= n and found[n - 1] > bound)
        how.append((c, CANDIDATES if proven else ALL_VALUES, bound if proven else 0))
    whole = [c for c, method, _ in how if method == ALL_VALUES]
    if whole:
        counts = counts.filter(~F.col("column").isin(whole)).unionByName(value_counts(df, whole))
    return _top_values(counts, n), df.sparkSession.createDataFrame(how, "column string, method string, bound long")


def _dates(date: str) -> Section:
    found = {"earliest": F.min(date), "latest": F.max(date)}
    return Section(found, [{n: F.col(n) for n in found}])


def date_coverage(df: DataFrame, date: str = "incident_date") -> DataFrame:
    """First and last date, of parsed dates rather than of their text."""
    return _dates(date).over(df)


def _rules(rules: Mapping[str, Column], name: str, count: str) -> Section:
    counted = {f"{name}{i}": F.count(F.when(c, 1)) for i, c in enumerate(rules.values())}
    return Section(
        counted, [{name: F.lit(r), count: F.col(n)} for r, n in zip(rules, counted)]
    )


def default_checks() -> dict[str, Column]:
    return {
        "individual_without_age": (F.col("victim_type") == "Individual")
        & F.col("victim_age_group").isNull(),
        "homicide_without_weapon": (F.col("offense_category") == "Homicide Offenses")
        & F.col("weapon_name").isNull(),
    }


def sanity_checks(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """(check, rows): how many rows contradict themselves."""
    return _rules(rules or default_checks(), "check", "rows").over(df)


def _correlations(columns: Sequence[str]) -> Section:
    pairs = list(combinations(columns, 2))
    return Section(
        {
            f"corr{i}": F.corr(F.col(a).cast("double"), F.col(b).cast("double"))
            for i, (a, b) in enumerate(pairs)
        },
        [
            {"a": F.lit(a), "b": F.lit(b), "correlation": F.col(f"corr{i}")}
            for i, (a, b) in enumerate(pairs)
        ],
    )


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(a, b, correlation) of every pair of numeric columns, in one aggregate."""
    return _correlations(columns or numeric_columns(df)).over(df)


def age_rules(column: str) -> dict[str, Column]:
    """Checks of an age column; a valid age is neither missing nor -1."""
    age = F.col(column)
    valid = age.isNotNull() & (age != V.UNKNOWN_AGE)
    return {
        f"{column}: unknown": age == V.UNKNOWN_AGE,
        f"{column}: valid": valid,
        f"{column}: below 0": valid & (age < 0),
        f"{column}: above {V.OLD_AGE}": valid & (age > V.OLD_AGE),
        f"{column}: above {V.MAX_REASONABLE_AGE}": valid & (age > V.MAX_REASONABLE_AGE),
        f"{column}: impossible": age == V.IMPOSSIBLE_AGE,
    }


def outside(column: str, limits: tuple[int, int]) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).between(*limits)


def default_rules(
    victim_age: str = "victim_age_group",
    offender_age: str = "offender_age",
    years: tuple[int, int] = V.VALID_YEARS,
) -> dict[str, Column]:
    return {
        **age_rules(victim_age),
        **age_rules(offender_age),
        "population: zero": F.col("population") == 0,
        "population: negative": F.col("population") < 0,
        "year: out of range": outside("year", years),
        "incident_hour: out of range": outside("incident_hour", V.VALID_HOURS),
    }


def rule_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, n): rows meeting each rule, one aggregate for all of them."""
    return _rules(rules, "rule", "n").over(df)


def offending_values(df: DataFrame, limits: Mapping[str, tuple[int, int]]) -> DataFrame:
    """(column, value, count): distinct values outside their limits.

    Rows rather than a collected set, because bad data has no bound.
    """
    entries = [
        {
            "column": F.lit(c),
            "value": F.when(outside(c, span), F.col(c)).cast("double"),
        }
        for c, span in limits.items()
    ]
    return count_by(long_rows(df, entries), "column", "value", drop_null_keys=True)


def profile(df: DataFrame, date: str = "incident_date") -> dict[str, DataFrame]:
    """The whole report, one frame per section, from three scans."""
    numbers, texts = numeric_columns(df), categorical_columns(df)
    sections = {
        "overview": _overview(df),
        "missing": _missing(df, blank=True),
        "statistics": _describe(numbers),
        "cardinality": _cardinality(texts),
        "dates": _dates(date),
        "sanity": _rules(default_checks(), "check", "rows"),
        "correlations": _correlations(numbers),
    }
    aggregates = {n: c for s in sections.values() for n, c in s.aggregates.items()}
    row = settle(df.agg(*[c.alias(n) for n, c in aggregates.items()]))
    report = {name: long_rows(row, s.rows) for name, s in sections.items() if s.rows}
    report["outliers"] = zscore_outliers(df, numbers, statistics=row)

    # values of single columns and of pairs, counted together
    def entry(name: str, first: str, second: str | None = None) -> dict[str, Column]:
        other = F.lit(None) if second is None else F.col(second)
        return {
            "column": F.lit(name),
            "value": F.col(first).cast("string"),
            "other": other.cast("string"),
        }

    pairs = {
        "years": ("year", None),
        "demographics": ("victim_sex", "victim_race"),
        "year_by_category": ("year", "offense_category"),
    }
    entries = [entry(c, c) for c in texts] + [entry(f"_{n}", *cs) for n, cs in pairs.items()]
    counts = settle(count_by(long_rows(df, entries), "column", "value", "other"))

    def counted(name: str, *columns: str) -> DataFrame:
        found = counts.filter(F.col("column") == name)
        values = [F.col(v).alias(c) for v, c in zip(("value", "other"), columns)]
        return found.select(*values, "count")

    singles = counts.filter(F.col("column").isin(*texts)).drop("other")
    report["top_values"] = _top_values(singles, 10)
    for name, column in (
        ("counties", "county"), ("categories", "offense_category"), ("weapons", "weapon_name")
    ):
        report[name] = top_n(counted(column, column), "count", 10, [column])
    report["years"] = counted("_years", "year").orderBy("year")
    report["demographics"] = top_n(
        counted("_demographics", *pairs["demographics"]), "count", 10, pairs["demographics"]
    )
    report["year_by_category"] = (
        counted("_year_by_category", *pairs["year_by_category"])
        .orderBy("year", F.desc("count"), "offense_category")
        .limit(20)
    )
    return report
