"""Count reports and state rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from .. import operators as op
from .. import vocabulary as V
from .bindings import events, incidents
from .registry import query


# fixed values, as the SQL must know them without the package
_VIOLENT = (
    "'Assault Offenses', 'Homicide Offenses', 'Kidnapping/Abduction', 'Robbery', 'Sex Offenses', 'Sex Offenses, "
    "Non-forcible', 'Human Trafficking'"
)
_LOCAL = (
    "'Assault Offenses', 'Homicide Offenses', 'Kidnapping/Abduction', 'Robbery', 'Sex Offenses'"
)


@query(
    "violent_by_state",
    f"select state, count(*) as incident_count from inc where offense_category in ({_VIOLENT}) "
    "group by state order by incident_count desc, state limit 10",
)
def violent_by_state(spark, sf):
    rows = op.violent(incidents(spark, sf, "state", "offense_category"))
    return op.top_n(op.count_by(rows, "state", name="incident_count"), "incident_count", 10, ["state"])


@query(
    "crime_type_catalog",
    "select distinct offense_category, "
    f"case when offense_category in ({_VIOLENT}) then 'Violent' else 'Non-Violent' end as crime_type "
    "from inc",
)
def crime_type_catalog(spark, sf):
    categories = op.distinct_values(incidents(spark, sf, "offense_category"), "offense_category")
    typed = categories.withColumn("crime_type", fn.crime_type("offense_category"))
    return typed.orderBy("crime_type", "offense_category")


@query(
    "top_categories",
    "select offense_category, count(*) as count from inc group by 1 "
    "order by count desc, offense_category limit 10",
)
def top_categories(spark, sf):
    counts = op.count_by(incidents(spark, sf, "offense_category"), "offense_category")
    return op.top_n(counts, "count", 10, ["offense_category"])


@query(
    "offense_distribution",
    "select offense_category, offense_name, count(*) as count from inc group by 1, 2",
)
def offense_distribution(spark, sf):
    rows = incidents(spark, sf, "offense_category", "offense_name")
    return op.count_by(rows, "offense_category", "offense_name").orderBy(
        "offense_category", F.desc("count"), "offense_name"
    )


@query(
    "weapon_flag_three_policies",
    "select case when weapon_name not in ('Other', 'Unknown') then 'With Weapon' "
    "else 'Without Weapon' end as listed, "
    "case when weapon_name in ('Other', 'Unknown') then 'No' else 'Yes' end as assumed, "
    "weapon_name is not null and weapon_name <> '' and lower(weapon_name) <> 'unknown' as known, "
    "count(*) as count from inc group by 1, 2, 3",
)
def weapon_flag_three_policies(spark, sf):
    rows = incidents(spark, sf, "weapon_name")
    flags = rows.select(
        *[fn.weapon_flag("weapon_name", p).alias(p) for p in ("listed", "assumed", "known")]
    )
    return op.count_by(flags, "listed", "assumed", "known")


@query(
    "weapon_split",
    "select case when weapon_name not in ('Other', 'Unknown') then 'With Weapon' "
    "else 'Without Weapon' end as has_weapon, count(*) as count from inc group by 1",
)
def weapon_split(spark, sf):
    rows = incidents(spark, sf, "weapon_name")
    flags = rows.select(fn.weapon_flag("weapon_name", "listed").alias("has_weapon"))
    return op.count_by(flags, "has_weapon").orderBy(F.desc("count"))


@query(
    "top_weapons_known",
    "select weapon_name, count(*) as count from inc where weapon_name not in ('Other', 'Unknown') "
    "group by 1 order by count desc, weapon_name limit 10",
)
def top_weapons_known(spark, sf):
    rows = op.filter_not_in(incidents(spark, sf, "weapon_name"), "weapon_name", V.UNINFORMATIVE_WEAPONS)
    return op.top_n(op.count_by(rows, "weapon_name"), "count", 10, ["weapon_name"])


@query(
    "violent_by_county",
    "select state, county, count(*) as violent_incidents from inc "
    f"where offense_category in ({_LOCAL}) group by 1, 2",
)
def violent_by_county(spark, sf):
    rows = op.violent(
        incidents(spark, sf, "state", "county", "offense_category"), V.VIOLENT_CATEGORIES_LOCAL
    )
    return op.count_by(rows, "state", "county", name="violent_incidents").orderBy(
        "state", F.desc("violent_incidents"), "county"
    )


@query(
    "violent_by_agency",
    "select state, agency_name, count(*) as violent_incidents from inc "
    f"where offense_category in ({_LOCAL}) group by 1, 2",
)
def violent_by_agency(spark, sf):
    rows = op.violent(
        incidents(spark, sf, "state", "agency_name", "offense_category"), V.VIOLENT_CATEGORIES_LOCAL
    )
    return op.count_by(rows, "state", "agency_name", name="violent_incidents").orderBy(
        "state", F.desc("violent_incidents"), "agency_name"
    )


@query(
    "weapon_by_county",
    "select state, county, count(*) as weapon_crimes from inc "
    "where weapon_name is null or weapon_name not in ('Unknown', 'Other') group by 1, 2",
)
def weapon_by_county(spark, sf):
    rows = incidents(spark, sf, "state", "county", "weapon_name")
    involved = rows.filter(fn.weapon_flag("weapon_name", "assumed") == "Yes")
    return op.count_by(involved, "state", "county", name="weapon_crimes").orderBy(
        "state", F.desc("weapon_crimes"), "county"
    )


@query(
    "top_counties",
    "select county, count(*) as count from inc group by 1 order by count desc, county limit 10",
)
def top_counties(spark, sf):
    return op.top_n(op.count_by(incidents(spark, sf, "county"), "county"), "count", 10, ["county"])


@query(
    "sex_by_race",
    "select victim_sex, victim_race, count(*) as count from inc group by 1, 2 "
    "order by count desc, victim_sex, victim_race nulls first limit 10",
)
def sex_by_race(spark, sf):
    counts = op.count_by(incidents(spark, sf, "victim_sex", "victim_race"), "victim_sex", "victim_race")
    return op.top_n(counts, "count", 10, ["victim_sex", "victim_race"])


@query(
    "category_by_year",
    "select year, offense_category, count(*) as count from inc group by 1, 2 "
    "order by year, count desc, offense_category limit 20",
)
def category_by_year(spark, sf):
    counts = op.count_by(incidents(spark, sf, "year", "offense_category"), "year", "offense_category")
    return counts.orderBy("year", F.desc("count"), "offense_category").limit(20)


@query(
    "rate_by_county_pop",
    "select state, cast(sum(n) as bigint) as incidents, cast(sum(p) as bigint) as population, "
    "sum(n) / sum(p) * 100000 as rate from "
    "(select state, county, count(*) as n, max(population) as p from inc group by 1, 2) "
    "group by state",
)
def rate_by_county_pop(spark, sf):
    rows = incidents(spark, sf, "state", "county", "population")
    return op.rate_per_100k(rows, "state", "county").orderBy(F.desc("rate"), "state")


@query(
    "rate_by_agency_pop",
    "select state, cast(sum(n) as bigint) as incidents, cast(sum(p) as bigint) as population, "
    "sum(n) / sum(p) * 100000 as rate from "
    "(select state, agency_name, count(*) as n, max(population) as p from inc group by 1, 2) "
    "group by state",
)
def rate_by_agency_pop(spark, sf):
    return op.rate_per_100k(
        incidents(spark, sf, "state", "agency_name", "population"), "state", "agency_name"
    )


@query(
    "rate_without_population",
    "select state, count(*) as incidents, cast(count(*) as double) as rate from inc group by 1",
)
def rate_without_population(spark, sf):
    return op.rate_per_100k(incidents(spark, sf, "state"), "state", "agency_name")


@query(
    "unknown_rate_by_state",
    "select state, cast(sum(u) as bigint) as total_unknowns, count(*) as total_rows, "
    "sum(u) / count(*) as unknown_rate from (select state, "
    "(victim_sex = 'Unknown')::int + coalesce((victim_race = 'Unknown')::int, 0) + "
    "(offender_sex = 'Unknown')::int + coalesce((offender_race = 'Unknown')::int, 0) "
    "as u from inc) group by state",
)
def unknown_rate_by_state(spark, sf):
    return op.unknown_rate(incidents(spark, sf, "state", *V.UNKNOWN_RATE_COLUMNS))


@query("state_counties", "select distinct state, county from inc")
def state_counties(spark, sf):
    return op.distinct_values(incidents(spark, sf, "state", "county"), "state", "county")


@query("events_by_year", "select year(incident_date) as year, count(*) as count from ev group by 1")
def events_by_year(spark, sf):
    rows = events(spark, sf, "incident_date").select(fn.year_of("incident_date").alias("year"))
    return op.count_by(rows, "year")


@query(
    "max_county_row",
    "select county, count(*) as count from inc group by 1 order by count desc, county limit 1",
)
def max_county_row(spark, sf):
    return op.row_of_max(op.count_by(incidents(spark, sf, "county"), "county"), "count", ["county"])


@query(
    "mode_of_weapon",
    "select weapon_name as value, count(*) as count from inc where weapon_name is not null "
    "group by 1 order by count desc, value limit 1",
)
def mode_of_weapon(spark, sf):
    return op.mode_of(incidents(spark, sf, "weapon_name"), "weapon_name")
