"""Marts, dashboard tables and the hotspot pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as op
from ..plans import hotspot, marts
from .bindings import events, fips, incidents
from .registry import query

_MART_COLUMNS = (
    "incident_date", "incident_hour", "offense_category", "offense_name", "location_name",
    "victim_age_group", "victim_race", "victim_sex", "weapon_name", "state", "county",
    "agency_name", "population",
)


def _mart_rows(spark, sf, *columns):
    return incidents(spark, sf, "incident_date", *columns)


def _count_sql(columns: dict[str, str], view: str = "inc") -> str:
    keys = ", ".join(f'{e} as "{n}"' for n, e in columns.items())
    keep = " and ".join(f"{e} is not null" for e in columns.values())
    where = "1, 2" if len(columns) > 1 else "1"
    return f"select {keys}, count(*) as count from {view} where {keep} group by {where}"


def _mart(name: str):
    def run(spark, sf):
        rows = incidents(spark, sf, *marts.mart_keys(name))
        return marts.count_marts(rows, [name])[name]

    return run


_DAY = "dayname(incident_date)"
for _name, _columns in {
    "yearly_trends": {"Year": "year"},
    "monthly_trends": {"Year": "year", "Month": "month"},
    "hourly_distribution": {"Incident Hour": "incident_hour"},
    "offense_categories": {"Offense Category": "offense_category"},
    "top_offense_names": {"Offense Name": "offense_name"},
    "top_locations": {"Location Name": "location_name"},
    "victim_age_distribution": {"Victim Age Group": "victim_age_group"},
    "victim_race_by_offense": {
        "Offense Category": "offense_category", "Victim Race": "victim_race"},
    "victim_sex_by_offense": {"Offense Category": "offense_category", "Victim Sex": "victim_sex"},
    "weapon_usage": {"Weapon Name": "weapon_name"},
    "day_of_week_patterns": {"DayOfWeek": _DAY},
}.items():
    query(f"mart_{_name}", _count_sql(_columns))(_mart(_name))


@query(
    "mart_hourly_events",
    "select incident_hour as \"Incident Hour\", count(*) as count from ev "
    "where incident_hour is not null group by 1",
)
def mart_hourly_events(spark, sf):
    rows = events(spark, sf, "incident_date", "incident_hour")
    return marts.trend_marts(rows)["hourly_distribution"]


@query(
    "mart_sex_crosstab",
    'select offense_category as "Offense Category", '
    + ", ".join(
        f"count(*) filter (where victim_sex = '{s}') as \"{s}\"" for s in ("F", "M", "U", "Unknown")
    )
    + " from inc group by 1",
)
def mart_sex_crosstab(spark, sf):
    rows = incidents(spark, sf, "offense_category", "victim_sex", "victim_race")
    built = marts.victim_marts(rows, ["F", "M", "U", "Unknown"])
    return built["victim_sex_by_offense_crosstab"]


@query(
    "mart_state_crime_rates",
    'select state as "State", cast(sum(n) as bigint) as count, '
    'cast(sum(p) as bigint) as "Population", sum(n) / sum(p) * 100000 as "CrimeRatePer100k" from '
    "(select state, agency_name, count(*) as n, max(population) as p from inc group by 1, 2) "
    "group by state",
)
def mart_state_crime_rates(spark, sf):
    return marts.state_rate_mart(incidents(spark, sf, "state", "agency_name", "population"))


@query(
    "mart_county_heatmap",
    "select state, county, offense_category, count(*) as count, lpad(max(fips.fips), 5, '0') as fips "
    "from inc join fips on state = state_name "
    "and county = replace(county_name, ' County', '') where fips.fips <> '0' group by 1, 2, 3",
)
def mart_county_heatmap(spark, sf):
    rows = incidents(spark, sf, "state", "county", "offense_category")
    return marts.heatmap_mart(rows, fips(spark, sf))


@query(
    "all_marts_total",
    "select 'yearly' as mart, count(*) as total from inc union all "
    "select 'hourly', count(incident_hour) from inc union all "
    "select 'race', count(victim_race) from inc union all "
    "select 'weekday', count(*) from inc union all select 'weapon', count(weapon_name) from inc",
)
def all_marts_total(spark, sf):
    """Every mart of the single pass adds up to the rows it is about."""
    built = marts.build_marts(_mart_rows(spark, sf, *_MART_COLUMNS[1:]))
    names = {
        "yearly": "yearly_trends", "hourly": "hourly_distribution",
        "race": "victim_race_by_offense", "weekday": "day_of_week_patterns",
        "weapon": "weapon_usage",
    }
    return op.union_states(
        [
            built[m].agg(F.sum("count").alias("total")).select(F.lit(n).alias("mart"), "total")
            for n, m in names.items()
        ]
    )


def _yearly(spark, sf):
    return marts.trend_marts(_mart_rows(spark, sf))["yearly_trends"]


@query("total_incidents", "select count(*) as total from inc")
def total_incidents(spark, sf):
    return marts.total_incidents(_yearly(spark, sf))


@query(
    "peak_year",
    'select year as "Year", count(*) as count from inc group by 1 order by count desc, 1 limit 1',
)
def peak_year(spark, sf):
    return marts.peak_year(_yearly(spark, sf))


@query("years_on_offer", 'select distinct year as "Year" from inc')
def years_on_offer(spark, sf):
    return marts.years_on_offer(_yearly(spark, sf))


@query(
    "month_series",
    'select 1998 as "Year", month as "Month", count(*) as count, '
    "strftime(min(incident_date), '%b') as \"Month Name\" from inc where year = 1998 group by 2",
)
def month_series(spark, sf):
    monthly = marts.trend_marts(_mart_rows(spark, sf))["monthly_trends"]
    return marts.month_series(monthly, 1998)


@query(
    "weapon_percent",
    'select weapon_name as "Weapon Name", count(*) as count, '
    "count(*) / sum(count(*)) over () * 100 as percent from inc where weapon_name is not null "
    "group by 1",
)
def weapon_percent(spark, sf):
    rows = incidents(spark, sf, "weapon_name")
    return marts.weapon_percent(marts.category_marts(rows)["weapon_usage"])


@query(
    "top8_sex",
    'select offense_category as "Offense Category", victim_sex as "Victim Sex", '
    "count(*) as count from inc where offense_category in (select offense_category from inc "
    "group by 1 order by count(*) desc, 1 limit 8) group by 1, 2",
)
def top8_sex(spark, sf):
    rows = incidents(spark, sf, "offense_category", "victim_sex")
    sex = marts.victim_marts(rows)["victim_sex_by_offense"]
    return op.keep_top_groups(sex, "Offense Category", 8, weight="count")


def _dashboard(part: str, mart: str):
    """One table of the dashboard, from the one mart it needs."""

    def run(spark, sf):
        rows = _mart_rows(spark, sf, *_MART_COLUMNS[1:])
        return marts.dashboard_tables(marts.count_marts(rows, [mart]), 1998, "Robbery")[part]

    return run


query(
    "dashboard_top15_offenses",
    'select offense_name as "Offense Name", count(*) as count from inc group by 1 '
    "order by count desc, 1 limit 15",
)(_dashboard("offenses", "top_offense_names"))
query(
    "dashboard_top12_locations",
    'select location_name as "Location Name", count(*) as count from inc group by 1 '
    "order by count desc, 1 limit 12",
)(_dashboard("locations", "top_locations"))
query(
    "dashboard_race_of_category",
    'select offense_category as "Offense Category", victim_race as "Victim Race", '
    "count(*) as count from inc where offense_category = 'Robbery' and victim_race is not null "
    "group by 1, 2",
)(_dashboard("race", "victim_race_by_offense"))
query(
    "dashboard_selected_year",
    'select year as "Year", count(*) as count from inc where year = 1998 group by 1',
)(_dashboard("selected_year", "yearly_trends"))


@query(
    "map_counts",
    "select lpad(fips.fips, 5, '0') as fips, state, county, count(*) as count, "
    "round(ln(1 + count(*)), 6) as log_count from inc join fips on state = state_name "
    "and county = replace(county_name, ' County', '') where fips.fips <> '0' "
    "group by fips.fips, state, county",
)
def map_counts(spark, sf):
    rows = incidents(spark, sf, "state", "county", "offense_category")
    counts = marts.map_tables(marts.heatmap_mart(rows, fips(spark, sf)))["counts"]
    return counts.withColumn("log_count", F.round("log_count", 6))


_MONTHLY = (
    "select state, county, year, month, count(*) as crime_count, max(population) as population "
    "from inc group by 1, 2, 3, 4"
)


def _monthly(spark, sf):
    return hotspot.county_month(
        incidents(spark, sf, "state", "county", "population", "incident_date")
    )


@query("county_month", _MONTHLY)
def county_month(spark, sf):
    return _monthly(spark, sf)


@query(
    "county_month_by_population",
    "select state, county, population, year, month, count(*) as crime_count from inc "
    "group by 1, 2, 3, 4, 5",
)
def county_month_by_population(spark, sf):
    rows = incidents(spark, sf, "state", "county", "population", "incident_date")
    return hotspot.county_month(rows, by_population=True)


_ORDER = "partition by state, county order by year, month"


@query(
    "lag_month",
    f"select *, lag(crime_count, 1, 0) over ({_ORDER}) as crime_last_month from ({_MONTHLY})",
)
def lag_month(spark, sf):
    return op.lag_month(_monthly(spark, sf))


@query(
    "lag_month_calendar",
    f"select m.*, coalesce(p.crime_count, 0) as crime_last_month from ({_MONTHLY}) m "
    f"left join ({_MONTHLY}) p on m.state = p.state and m.county = p.county "
    "and m.year * 12 + m.month = p.year * 12 + p.month + 1",
)
def lag_month_calendar(spark, sf):
    return op.lag_month(_monthly(spark, sf), gaps="calendar")


@query(
    "hotspot_global",
    "select *, case when crime_count >= (select quantile_cont(crime_count, 0.9) "
    f"from ({_MONTHLY})) then 1 else 0 end as is_hotspot from ({_MONTHLY})",
)
def hotspot_global(spark, sf):
    return hotspot.hotspot_label(_monthly(spark, sf))


@query(
    "hotspot_global_approx",
    "select *, case when crime_count >= (select quantile_disc(crime_count, 0.9) "
    f"from ({_MONTHLY})) then 1 else 0 end as is_hotspot from ({_MONTHLY})",
)
def hotspot_global_approx(spark, sf):
    return hotspot.hotspot_label(_monthly(spark, sf), exact=False)


@query(
    "hotspot_county",
    "select *, case when crime_count > threshold then 1 else 0 end as is_hotspot from ("
    "select *, quantile_cont(crime_count, 0.75) over (partition by state, county) as threshold "
    f"from ({_MONTHLY}))",
)
def hotspot_county(spark, sf):
    return hotspot.hotspot_by_county(_monthly(spark, sf), exact=True)


@query(
    "hotspot_county_approx",
    "select *, case when crime_count > threshold then 1 else 0 end as is_hotspot from ("
    "select *, quantile_disc(crime_count, 0.75) over (partition by state, county) as threshold "
    f"from ({_MONTHLY}))",
)
def hotspot_county_approx(spark, sf):
    return hotspot.hotspot_by_county(_monthly(spark, sf))


@query(
    "hotspot_balance",
    "select is_hotspot, count(*) as count from (select case when crime_count >= ("
    f"select quantile_cont(crime_count, 0.9) from ({_MONTHLY})) then 1 else 0 end as is_hotspot "
    f"from ({_MONTHLY})) group by 1",
)
def hotspot_balance(spark, sf):
    return op.count_by(hotspot.hotspot_label(_monthly(spark, sf)), "is_hotspot")


@query(
    "hotspot_features",
    "select state, county, year, month, crime_count, population, "
    "round(crime_count / (population / 1000.0), 6) as crime_rate_per_1000, "
    "round(sin(2 * pi() * month / 12), 6) as sin_month, "
    "round(cos(2 * pi() * month / 12), 6) as cos_month, "
    f"lag(crime_count, 1, 0) over ({_ORDER}) as crime_last_month, "
    "cast(dense_rank() over (order by state) - 1 as int) as state_idx, "
    f"cast(dense_rank() over (order by county) - 1 as int) as county_idx from ({_MONTHLY})",
)
def hotspot_features(spark, sf):
    out = hotspot.features(_monthly(spark, sf))
    measured = ("crime_rate_per_1000", "sin_month", "cos_month")
    return out.withColumns({c: F.round(c, 6) for c in measured})


@query(
    "time_split",
    f"select year = (select max(year) from inc) as is_test, count(*) as count from ({_MONTHLY}) "
    "group by 1",
)
def time_split(spark, sf):
    train, test = hotspot.time_split(_monthly(spark, sf))
    parts = [
        part.agg(F.count(F.lit(1)).alias("count")).select(F.lit(flag).alias("is_test"), "count")
        for flag, part in ((False, train), (True, test))
    ]
    return op.union_states(parts)


def _run(spark, sf, model, encoding="text", measure=False):
    rows = incidents(spark, sf, "state", "county", "population", "incident_date")
    return hotspot.run_hotspot(rows, model, encoding=encoding, measure=measure)


@query("hotspot_rf")
def hotspot_rf(spark, sf):
    return _run(spark, sf, "forest").predictions


@query("hotspot_rf_by_frequency")
def hotspot_rf_by_frequency(spark, sf):
    return _run(spark, sf, "forest", "frequency").predictions


@query("hotspot_gbt")
def hotspot_gbt(spark, sf):
    return _run(spark, sf, "boosting").predictions


@query("hotspot_metrics")
def hotspot_metrics(spark, sf):
    metrics = _run(spark, sf, "forest", measure=True).metrics
    return spark.createDataFrame(
        [tuple(vars(metrics).values())], "auc double, f1 double, accuracy double, "
        "precision double, recall double"
    )


