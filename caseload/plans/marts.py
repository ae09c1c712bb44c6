"""Small tables a dashboard reads, and the tables it derives from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.bands import age_band, relationship_type, severity
from ..functions.dates import month_abbr
from ..functions.numbers import log_count, pct
from ..operators.filters import is_night, select_category, select_year
from ..operators.grouping import rate_of_units, rate_per_100k, row_of_max, sum_by
from ..operators.joins import attach_fips, keep_top_groups, predictions_by_fips
from ..operators.ranking import sort_by_metric, sort_weekday, top_n
from ..operators.shape import rename_map
from ..schemas import DISPLAY_NAMES
from ..session import settle

# mart -> its columns, each as (name in the mart, incident column, expression)
_DATE = "incident_date"
COUNT_MARTS: dict[str, tuple[tuple[str, str, str], ...]] = {
    "yearly_trends": (("Year", _DATE, f"year({_DATE})"),),
    "monthly_trends": (("Year", _DATE, f"year({_DATE})"), ("Month", _DATE, f"month({_DATE})")),
    "day_of_week_patterns": (("DayOfWeek", _DATE, f"date_format({_DATE}, 'EEEE')"),),
    **{
        mart: tuple((DISPLAY_NAMES[c], c, c) for c in columns)
        for mart, columns in {
            "hourly_distribution": ("incident_hour",),
            "offense_categories": ("offense_category",),
            "top_offense_names": ("offense_name",),
            "top_locations": ("location_name",),
            "victim_age_distribution": ("victim_age_group",),
            "victim_race_by_offense": ("offense_category", "victim_race"),
            "victim_sex_by_offense": ("offense_category", "victim_sex"),
            "weapon_usage": ("weapon_name",),
        }.items()
    },
}
HEATMAP_KEYS = ("state", "county", "offense_category")
AGENCY_KEYS = ("state", "agency_name")


def mart_keys(mart: str) -> tuple[str, ...]:
    """The incident columns a mart is counted by."""
    return tuple(dict.fromkeys(column for _, column, _ in COUNT_MARTS[mart]))


def count_sets(
    df: DataFrame,
    sets: Mapping[str, Sequence[str]],
    keep_nulls: Sequence[str] = (),
    **extra: Column,
) -> dict[str, DataFrame]:
    """Counts for several groupings from one scan and one shuffle.

    Grouping sets are summed map-side, so the shuffle carries counts only. The
    counted rows, all groupings together, are kept in the shared folder; each
    result is a filter on them. Rows with a null key are left out of a result
    unless it is named in ``keep_nulls``.
    ``extra`` adds further aggregates beside the count.
    """
    columns = list(dict.fromkeys(c for keys in sets.values() for c in keys))
    counted = settle(
        df.groupingSets([list(keys) for keys in sets.values()], *columns).agg(
            F.count(F.lit(1)).alias("count"),
            *[c.alias(n) for n, c in extra.items()],
            F.grouping_id().alias("_set"),
        )
    )
    out = {}
    for name, keys in sets.items():
        # the grouping id has one bit per column, set where it is summed away
        bits = int("".join("0" if c in keys else "1" for c in columns), 2)
        found = counted.filter(F.col("_set") == bits).select(*keys, "count", *extra)
        out[name] = found if name in keep_nulls else found.na.drop(subset=list(keys))
    return out


def count_marts(df: DataFrame, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The named count marts; those whose columns are absent are left out."""
    wanted = _wanted(df, names)
    return _roll_up(wanted, _count_bases(df, [mart_keys(n) for n in wanted]))


def _wanted(df: DataFrame, names: Sequence[str] | None) -> list[str]:
    return [
        n
        for n in COUNT_MARTS
        if (names is None or n in names) and set(mart_keys(n)) <= set(df.columns)
    ]


Bases = dict[tuple[str, ...], DataFrame]


def _count_bases(df: DataFrame, keys: Sequence[tuple[str, ...]], **extra: Column) -> Bases:
    """Counts by the widest of the key sets; the others follow from them."""
    distinct = list(dict.fromkeys(keys))
    widest = [k for k in distinct if not any(set(k) < set(other) for other in distinct)]
    names = {",".join(k): k for k in widest}
    counted = count_sets(df, names, keep_nulls=list(names), **extra)
    return {k: counted[n] for n, k in names.items()}


def _roll_up(names: Sequence[str], bases: Bases) -> dict[str, DataFrame]:
    """Marts from counted bases. Year, month and weekday are taken from the
    counted dates, a few thousand rows, instead of from every incident."""
    marts = {}
    for name in names:
        keys = mart_keys(name)
        base = next(b for b in bases if set(keys) <= set(b))
        columns = [F.expr(e).alias(n) for n, _, e in COUNT_MARTS[name]]
        labels = [n for n, _, _ in COUNT_MARTS[name]]
        rows = bases[base].select(*columns, "count").na.drop(subset=labels)
        marts[name] = rows.groupBy(*labels).agg(F.sum("count").alias("count"))
    if "day_of_week_patterns" in marts:
        marts["day_of_week_patterns"] = sort_weekday(marts["day_of_week_patterns"])
    return marts


def trend_marts(df: DataFrame) -> dict[str, DataFrame]:
    return count_marts(df, ["yearly_trends", "monthly_trends", "hourly_distribution"])


def category_marts(df: DataFrame) -> dict[str, DataFrame]:
    return count_marts(
        df, ["offense_categories", "top_offense_names", "top_locations", "weapon_usage"]
    )


def victim_marts(df: DataFrame, sexes: Sequence[str] | None = None) -> dict[str, DataFrame]:
    marts = count_marts(
        df, ["victim_age_distribution", "victim_race_by_offense", "victim_sex_by_offense"]
    )
    marts["victim_sex_by_offense_crosstab"] = sex_crosstab(marts["victim_sex_by_offense"], sexes)
    return marts


def weekday_mart(df: DataFrame) -> DataFrame:
    return count_marts(df, ["day_of_week_patterns"])["day_of_week_patterns"]


def sex_crosstab(sex_by_offense: DataFrame, sexes: Sequence[str] | None = None) -> DataFrame:
    """Category by sex, pivoted from the counted mart rather than the rows."""
    grouped = sex_by_offense.groupBy("Offense Category")
    pivot = grouped.pivot("Victim Sex", list(sexes)) if sexes else grouped.pivot("Victim Sex")
    return pivot.agg(F.sum("count")).na.fill(0)


def state_rate_mart(df: DataFrame) -> DataFrame:
    named = df.filter(F.col("state").isNotNull())
    return _rates(rate_per_100k(named, "state", "agency_name", null_unit=False))


def _rates(rates: DataFrame) -> DataFrame:
    return rename_map(
        rates,
        {"state": "State", "incidents": "count", "population": "Population",
         "rate": "CrimeRatePer100k"},
    )


def heatmap_mart(df: DataFrame, fips: DataFrame | None = None) -> DataFrame:
    """Counts per state, county and category, with county codes if given."""
    return _coded(count_sets(df, {"h": HEATMAP_KEYS})["h"], fips)


def _coded(counts: DataFrame, fips: DataFrame | None) -> DataFrame:
    return counts if fips is None else attach_fips(counts, fips)


def detail_marts(df: DataFrame) -> dict[str, DataFrame]:
    """Severity, night and share tables of the dashboard, each from counts.

    ``victim_age_group`` holds ages as numbers, as ``standardise`` leaves them.
    Percentages have two decimals. One count of all incidents by severity,
    victim type, relationship, age range, night, category and sex is kept in
    the shared folder; every table sums it up further.
    """
    keys = {
        "Severity_Level": severity("offense_category"), "Victim Type": F.col("victim_type"),
        "Relationship Type": relationship_type("relationship"), "Age Range": age_band("victim_age_group"),
        "_night": F.coalesce(is_night(), F.lit(False)), "Offense Category": F.col("offense_category"),
        "Victim Sex": F.col("victim_sex"),
    }
    counts = settle(df.select(*[c.alias(n) for n, c in keys.items()]).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))

    def shares(by: Sequence[str], keys_: Sequence[str], name: str, rows: DataFrame = counts) -> DataFrame:
        held = rows.groupBy(*by, *keys_).agg(F.sum("_n").alias(name))
        total = F.sum(name).over(Window.partitionBy(*by))
        return held.withColumn("Total", total).withColumn("Percentage", F.round(F.col(name) / F.col("Total") * 100, 2))

    sexes = shares(["Offense Category"], ["Victim Sex"], "Incident_Count").withColumnRenamed("Total", "Total_Per_Category")
    ages = counts.groupBy("Age Range").agg(
        F.sum("_n").alias("Total_Incident_Count"),
        F.coalesce(F.sum(F.when(F.col("_night"), F.col("_n"))), F.lit(0)).alias("Nighttime_Incident_Count"),
    )
    part = F.col("Nighttime_Incident_Count") / F.col("Total_Incident_Count") * 100
    return {
        "victim_type_by_severity": shares(["Severity_Level"], ["Victim Type"], "count"),
        "relationship_by_severity": shares(["Severity_Level"], ["Relationship Type"], "count"),
        "victim_age_distribution_summary": shares([], ["Age Range"], "count").drop("Total"),
        "victim_age_distribution_nighttime": shares([], ["Age Range"], "Nighttime_Incident_Count", counts.filter("_night")).drop("Total"),
        "victim_age_vulnerability_nighttime": ages.withColumn("Vulnerability % (Nighttime)", F.round(part, 2)),
        "victim_sex_by_offense_percentages": sexes,
    }


def build_marts(
    df: DataFrame, fips: DataFrame | None = None, sexes: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """All marts from one pass over ``df``.

    The rates need the largest population of each agency, which is taken along
    in the same pass.
    """
    wanted = _wanted(df, None)
    keys, people = _base_keys(df, wanted)
    marts = _marts_of(wanted, _count_bases(df, keys, **people), fips, sexes)
    if "state_crime_rates" not in marts:
        marts["state_crime_rates"] = state_rate_mart(df)
    return marts


def _base_keys(df: DataFrame, wanted: Sequence[str]) -> tuple[list[tuple[str, ...]], dict[str, Column]]:
    """What all marts are counted by, and the population taken along if there is one."""
    rated = {"population", "agency_name"} <= set(df.columns)
    keys = [*map(mart_keys, wanted), HEATMAP_KEYS, *([AGENCY_KEYS] if rated else [])]
    return keys, {"people": F.max("population")} if rated else {}


def _marts_of(
    wanted: Sequence[str], bases: Bases, fips: DataFrame | None, sexes: Sequence[str] | None
) -> dict[str, DataFrame]:
    marts = _roll_up(wanted, bases)
    if "victim_sex_by_offense" in marts:
        marts["victim_sex_by_offense_crosstab"] = sex_crosstab(
            marts["victim_sex_by_offense"], sexes
        )
    if AGENCY_KEYS in bases:
        agencies = bases[AGENCY_KEYS].filter(F.col("state").isNotNull())
        marts["state_crime_rates"] = _rates(
            rate_of_units(agencies, "state", "agency_name", null_unit=False)
        )
    heat = bases[HEATMAP_KEYS].select(*HEATMAP_KEYS, "count").na.drop(subset=list(HEATMAP_KEYS))
    marts["county_heatmap"] = rename_map(
        _coded(heat, fips),
        {"state": "State", "county": "County", "offense_category": "Offense Category"},
    )
    return marts


# a state-year's place in the table of partial counts
PARTIAL_BY = ("_state", "_year")


def partial_counts(df: DataFrame, year: str = "year") -> DataFrame:
    """What the marts need of the incidents, counted for each state and year.

    One scan and one shuffle of counts, as for ``build_marts``, with state and year in every
    grouping. Counts of different state-years add up and the population of an agency is the largest
    of theirs, so marts follow from these rows without the incidents.
    """
    keys, people = _base_keys(df, _wanted(df, None))
    marked = df.withColumns({PARTIAL_BY[0]: F.col("state"), PARTIAL_BY[1]: F.col(year).cast("int")})
    distinct = list(dict.fromkeys(keys))
    widest = [k for k in distinct if not any(set(k) < set(other) for other in distinct)]
    columns = list(dict.fromkeys([*PARTIAL_BY, *[c for k in widest for c in k]]))
    extra = [c.alias(n) for n, c in people.items()]
    counted = marked.groupingSets([[*PARTIAL_BY, *k] for k in widest], *columns).agg(
        F.count(F.lit(1)).alias("count"), *extra, F.grouping_id().alias("_set")
    )
    named = F.lit(None).cast("string")
    for k in widest:
        bits = int("".join("0" if c in (*PARTIAL_BY, *k) else "1" for c in columns), 2)
        named = F.when(F.col("_set") == bits, F.lit(",".join(k))).otherwise(named)
    return counted.withColumn("_base", named).drop("_set")


def marts_from_partials(
    partials: DataFrame, fips: DataFrame | None = None, sexes: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """All marts, as ``build_marts`` makes them from the incidents, from stored partial counts."""
    columns = set(partials.columns)
    wanted = [n for n in COUNT_MARTS if set(mart_keys(n)) <= columns]
    keys = [*map(mart_keys, wanted), HEATMAP_KEYS, *([AGENCY_KEYS] if "people" in columns else [])]
    distinct = list(dict.fromkeys(keys))
    widest = [k for k in distinct if not any(set(k) < set(other) for other in distinct)]
    sums = [F.sum("count").alias("count"), *([F.max("people").alias("people")] if "people" in columns else [])]
    bases = {k: partials.filter(F.col("_base") == ",".join(k)).groupBy(*k).agg(*sums) for k in widest}
    return _marts_of(wanted, bases, fips, sexes)


def total_incidents(yearly: DataFrame) -> DataFrame:
    return yearly.agg(F.sum("count").alias("total"))


def peak_year(yearly: DataFrame) -> DataFrame:
    return row_of_max(yearly, "count", ["Year"])


def years_on_offer(monthly: DataFrame) -> DataFrame:
    return monthly.select("Year").distinct().orderBy("Year")


def month_series(monthly: DataFrame, year: int) -> DataFrame:
    months = select_year(monthly, year, "Year").withColumn("Month Name", month_abbr("Month"))
    return months.orderBy("Month")


def weapon_percent(weapons: DataFrame) -> DataFrame:
    total = weapons.agg(F.sum("count")).scalar()
    return weapons.withColumn("percent", pct("count", total)).orderBy(
        F.desc("count"), "Weapon Name"
    )


def dashboard_tables(
    marts: Mapping[str, DataFrame],
    year: int,
    category: str,
    metric: str = "CrimeRatePer100k",
    top_offenses: int = 15,
    top_places: int = 12,
    top_categories: int = 8,
) -> dict[str, DataFrame]:
    """The figures shown for a chosen year, category and metric, of the marts at hand."""
    tables = {
        "total_incidents": ("yearly_trends", total_incidents),
        "peak_year": ("yearly_trends", peak_year),
        "selected_year": ("yearly_trends", lambda m: select_year(m, year, "Year")),
        "years": ("monthly_trends", years_on_offer),
        "months": ("monthly_trends", lambda m: month_series(m, year)),
        "offenses": ("top_offense_names", lambda m: top_n(m, "count", top_offenses, ["Offense Name"])),
        "locations": ("top_locations", lambda m: top_n(m, "count", top_places, ["Location Name"])),
        "weapons": ("weapon_usage", weapon_percent),
        "race": ("victim_race_by_offense", lambda m: select_category(m, category, "Offense Category")),
        "sex": (
            "victim_sex_by_offense",
            lambda m: keep_top_groups(m, "Offense Category", top_categories, weight="count"),
        ),
        "states": ("state_crime_rates", lambda m: sort_by_metric(m, metric, ["State"])),
    }
    return {name: make(marts[mart]) for name, (mart, make) in tables.items() if mart in marts}


def map_tables(
    heatmap: DataFrame, predictions: DataFrame | None = None
) -> dict[str, DataFrame]:
    """County counts on a log scale, and mean hotspot probability per county."""
    counts = sum_by(heatmap, "fips", "state", "county", column="count")
    tables = {"counts": counts.withColumn("log_count", log_count("count"))}
    if predictions is not None:
        tables["probability"] = predictions_by_fips(predictions, heatmap)
    return tables
