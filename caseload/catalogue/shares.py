"""Shares, bands, pivots, rankings and change over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from .. import operators as op
from .. import vocabulary as V
from ..operators.filters import is_firearm, is_night
from .bindings import events, incidents
from .registry import query

# fixed values, as the SQL must know them without the package
_HIGH = (
    "case when offense_category in ('Homicide Offenses', 'Human Trafficking', 'Kidnapping/Abduction', 'Robbery', "
    "'Sex Offenses', 'Sex Offenses, Non-forcible', 'Assault Offenses') then 'High Severity' else 'Lower Severity' "
    "end"
)


def age_band_sql(column: str, dash: str) -> str:
    return (
        f"case when {column} = -1 then 'Unknown' "
        f"when {column} between 0 and 17 then '0{dash}17 (Minor)' "
        f"when {column} between 18 and 24 then '18{dash}24 (Young Adult)' "
        f"when {column} between 25 and 34 then '25{dash}34' "
        f"when {column} between 35 and 44 then '35{dash}44' "
        f"when {column} between 45 and 54 then '45{dash}54' "
        f"when {column} between 55 and 64 then '55{dash}64' "
        f"when {column} >= 65 then '65+ (Senior)' else 'Other/Invalid' end"
    )


_OFFENDER_BAND = (
    "case when offender_age < 18 then 'Under 18' when offender_age <= 25 then '18-25' "
    "when offender_age <= 40 then '26-40' when offender_age <= 60 then '41-60' else '60+' end"
)


def share_sql(keys: str, by: str, source: str) -> str:
    """Counts with total and percent within ``by``."""
    return (
        f"select {by}, {keys}, count(*) as count, "
        f"cast(sum(count(*)) over (partition by {by}) as bigint) as total, "
        f"count(*) / sum(count(*)) over (partition by {by}) * 100 as percent "
        f"from ({source}) group by {by}, {keys}"
    )


def _dominant(policy: str):
    def run(spark, sf):
        rows = incidents(spark, sf, "offense_category", "offender_age").withColumn(
            "age_group", fn.offender_age_band("offender_age", policy)
        )
        counts = op.count_by(rows, "offense_category", "age_group")
        return op.top_per_group(counts, ["offense_category"], "count", 1, ["age_group"])

    return run


def _dominant_sql(band: str) -> str:
    return (
        "select * from (select offense_category, age_group, count(*) as count, "
        "cast(row_number() over (partition by offense_category order by count(*) desc, age_group) "
        f"as int) as rank from (select offense_category, {band} as age_group from inc) "
        "group by 1, 2) where rank = 1"
    )


query("dominant_age_group_legacy", _dominant_sql(_OFFENDER_BAND))(_dominant("legacy"))
query(
    "dominant_age_group",
    _dominant_sql(
        "case when offender_age is null or offender_age = -1 then 'Unknown' else "
        f"{_OFFENDER_BAND} end"
    ),
)(_dominant("unknown"))


@query(
    "pivot_sex_share",
    "select *, \"M\" / total * 100 as \"M_percent\", \"F\" / total * 100 as \"F_percent\" from ("
    "select offense_category, count(*) filter (where offender_sex = 'M') as \"M\", "
    "count(*) filter (where offender_sex = 'F') as \"F\", count(*) as total from inc "
    "where offender_sex in ('M', 'F') group by 1)",
)
def pivot_sex_share(spark, sf):
    rows = incidents(spark, sf, "offense_category", "offender_sex")
    return op.pivot_share(rows, "offense_category", "offender_sex", ["M", "F"])


_SEXES = ("F", "M", "U", "Unknown")


@query(
    "crosstab_sex",
    "select offense_category, "
    + ", ".join(f"count(*) filter (where victim_sex = '{s}') as \"{s}\"" for s in _SEXES)
    + " from inc group by 1",
)
def crosstab_sex(spark, sf):
    rows = incidents(spark, sf, "offense_category", "victim_sex")
    return op.crosstab(rows, "offense_category", "victim_sex", _SEXES)


@query(
    "crosstab_sex_discovered",
    "select offense_category, "
    + ", ".join(f"count(*) filter (where victim_sex = '{s}') as \"{s}\"" for s in _SEXES)
    + " from inc group by 1",
)
def crosstab_sex_discovered(spark, sf):
    rows = incidents(spark, sf, "offense_category", "victim_sex")
    return op.crosstab(rows, "offense_category", "victim_sex")


@query("share_sex_window", share_sql("victim_sex", "offense_category", "select * from inc"))
def share_sex_window(spark, sf):
    rows = incidents(spark, sf, "offense_category", "victim_sex")
    return op.share_of_group(rows, ["victim_sex"], ["offense_category"])


@query(
    "share_sex_decimal",
    "select offense_category, victim_sex, count(*) as incident_count, "
    "cast(count(*) / sum(count(*)) over (partition by offense_category) * 100 as decimal(5, 2)) "
    "as percentage from inc group by 1, 2",
)
def share_sex_decimal(spark, sf):
    rows = incidents(spark, sf, "offense_category", "victim_sex")
    shares = op.share_of_group(rows, ["victim_sex"], ["offense_category"], "incident_count")
    return shares.select(
        "offense_category", "victim_sex", "incident_count",
        fn.pct_decimal("percent").alias("percentage"),
    )


def _hour_bands(policy: str):
    def run(spark, sf):
        rows = events(spark, sf, "state", "incident_hour").withColumn(
            "hour_range", fn.hour_band("incident_hour", policy)
        )
        return op.share_of_group(rows, ["hour_range"], ["state"])

    return run


_HOUR = (
    "case when incident_hour between 0 and 5 then '00-05 Night' "
    "when incident_hour between 6 and 11 then '06-11 Morning' "
    "when incident_hour between 12 and 17 then '12-17 Afternoon' "
)
query(
    "hour_band_share_legacy",
    share_sql(
        "hour_range", "state",
        f"select state, {_HOUR} else '18-23 Evening' end as hour_range from ev",
    ),
)(_hour_bands("legacy"))
query(
    "hour_band_share",
    share_sql(
        "hour_range", "state",
        f"select state, {_HOUR} when incident_hour between 18 and 23 then '18-23 Evening' "
        "else 'Unknown' end as hour_range from ev",
    ),
)(_hour_bands("unknown"))


@query(
    "season_counts",
    "select case when month in (12, 1, 2) then 'Winter' when month in (3, 4, 5) then 'Spring' "
    "when month in (6, 7, 8) then 'Summer' when month in (9, 10, 11) then 'Fall' "
    "else 'Unknown' end as season, count(*) as count from inc group by 1",
)
def season_counts(spark, sf):
    rows = incidents(spark, sf, "incident_date").select(
        fn.season(fn.month_of("incident_date")).alias("season")
    )
    return op.count_by(rows, "season").orderBy(F.desc("count"))


_YOY = (
    "select *, count - previous as change, (count - previous) / previous * 100 as percent_change "
    "from (select {keys}year, count(*) as count, "
    "lag(count(*)) over ({part} order by year) as previous from inc group by {keys}year)"
)


@query("yoy_total", _YOY.format(keys="", part=""))
def yoy_total(spark, sf):
    return op.yoy(op.count_by(incidents(spark, sf, "year"), "year"))


@query("yoy_by_category", _YOY.format(keys="offense_category, ", part="partition by offense_category"))
def yoy_by_category(spark, sf):
    counts = op.count_by(incidents(spark, sf, "year", "offense_category"), "year", "offense_category")
    return op.yoy(counts, by=["offense_category"])


@query(
    "total_change_by_category",
    "select offense_category, cast(sum(change) as bigint) as total_change from ("
    + _YOY.format(keys="offense_category, ", part="partition by offense_category")
    + ") group by 1",
)
def total_change_by_category(spark, sf):
    counts = op.count_by(incidents(spark, sf, "year", "offense_category"), "year", "offense_category")
    return op.total_change(counts, ["offense_category"]).orderBy(F.desc("total_change"))


def _rate_sql(by: str, condition: str, view: str, where: str = "") -> str:
    return (
        f"select *, subset / total * 100 as percent from (select {by}, count(*) as total, "
        f"count(*) filter (where {condition}) as subset from {view} group by {by}) {where}"
    )


@query(
    "firearm_rate",
    _rate_sql(
        "offense_category", "regexp_matches(lower(weapon_name), 'gun|firearm|rifle|shotgun|pistol')",
        "inc", "where subset > 0",
    ),
)
def firearm_rate(spark, sf):
    rows = incidents(spark, sf, "offense_category", "weapon_name")
    return op.subset_rate(rows, ["offense_category"], is_firearm(), drop_zero=True)


@query(
    "firearm_rows",
    "select weapon_name, count(*) as count from inc "
    "where regexp_matches(lower(weapon_name), 'gun|firearm|rifle|shotgun|pistol') group by 1",
)
def firearm_rows(spark, sf):
    return op.count_by(op.firearm_only(incidents(spark, sf, "weapon_name")), "weapon_name")


@query(
    "weapon_percent_by_state",
    _rate_sql(
        "state",
        "weapon_name is not null and weapon_name <> '' and lower(weapon_name) <> 'unknown'", "inc",
    ),
)
def weapon_percent_by_state(spark, sf):
    rows = incidents(spark, sf, "state", "weapon_name")
    return op.subset_rate(rows, ["state"], fn.weapon_flag("weapon_name", "known"))


@query(
    "top_weapons_per_state",
    "select * from (select state, weapon_name, count(*) as count, cast(row_number() over ("
    "partition by state order by count(*) desc, weapon_name nulls first) as int) as rank "
    "from inc group by 1, 2) where rank <= 3",
)
def top_weapons_per_state(spark, sf):
    counts = op.count_by(incidents(spark, sf, "state", "weapon_name"), "state", "weapon_name")
    return op.top_per_group(counts, ["state"], "count", 3, ["weapon_name"])


@query(
    "top_location_per_category",
    "select * from (select *, cast(row_number() over (partition by offense_category "
    "order by count desc, location_name) as int) as rank from ("
    + share_sql("location_name", "offense_category", "select * from inc")
    + ")) where rank <= 1",
)
def top_location_per_category(spark, sf):
    rows = incidents(spark, sf, "offense_category", "location_name")
    shares = op.share_of_group(rows, ["location_name"], ["offense_category"])
    return op.top_per_group(shares, ["offense_category"], "count", 1, ["location_name"])


def _total_sql(label: str, name: str, source: str) -> str:
    return (
        f"select {label} as {name}, count(*) as count, "
        f"count(*) / sum(count(*)) over () * 100 as percent from {source} group by 1"
    )


@query(
    "age_range_distribution",
    _total_sql(age_band_sql("victim_age", V.EN_DASH), "age_range", "inc"),
)
def age_range_distribution(spark, sf):
    rows = incidents(spark, sf, "victim_age").select(fn.age_band("victim_age").alias("age_range"))
    return op.share_of_total(rows, "age_range").orderBy(F.desc("count"))


@query("victim_type_share", share_sql("victim_type", "offense_category", "select * from inc"))
def victim_type_share(spark, sf):
    rows = incidents(spark, sf, "offense_category", "victim_type")
    return op.share_of_group(rows, ["victim_type"], ["offense_category"])


@query("race_share", share_sql("victim_race", "offense_category", "select * from inc"))
def race_share(spark, sf):
    rows = incidents(spark, sf, "offense_category", "victim_race")
    return op.share_of_group(rows, ["victim_race"], ["offense_category"])


_NIGHT = "incident_hour in (20, 21, 22, 23, 0, 1, 2, 3, 4, 5)"  # fixed values


@query(
    "night_share",
    _total_sql(age_band_sql("victim_age", V.EN_DASH), "age_range", f"ev where {_NIGHT}"),
)
def night_share(spark, sf):
    rows = op.night_only(events(spark, sf, "victim_age", "incident_hour"))
    return op.share_of_total(rows.select(fn.age_band("victim_age").alias("age_range")), "age_range")


@query(
    "night_vulnerability",
    _rate_sql(
        "age_range", _NIGHT,
        f"(select {age_band_sql('victim_age', V.EN_DASH)} as age_range, incident_hour from ev)",
    ),
)
def night_vulnerability(spark, sf):
    rows = events(spark, sf, "victim_age", "incident_hour").withColumn(
        "age_range", fn.age_band("victim_age")
    )
    return op.subset_rate(rows, ["age_range"], is_night())


@query(
    "top_locations",
    "select location_name, count(*) as count from inc group by 1 "
    "order by count desc, location_name limit 10",
)
def top_locations(spark, sf):
    counts = op.count_by(incidents(spark, sf, "location_name"), "location_name")
    return op.top_n(counts, "count", 10, ["location_name"])


@query(
    "location_theme",
    "select case when location_name in ('Residence/Home') then 'Residential' when location_name in "
    "('Highway/Road/Alley/Street/Sidewalk', 'Park/Playground', 'Parking/Drop Lot/Garage', 'Rest Area') then 'Public "
    "Space/Transport' when location_name in ('Bar/Nightclub', 'Convenience Store', 'Department/Discount Store', "
    "'Grocery/Supermarket', 'Hotel/Motel/Etc.', 'Restaurant', 'Shopping Mall', 'Service/Gas Station') then "
    "'Commercial (Retail/Service)' when location_name in ('Bank/Savings and Loan', 'Commercial/Office Building') "
    "then 'Commercial (Office/Financial)' when location_name like 'School%' then 'Education' when location_name in "
    "('Church/Synagogue/Temple/Mosque', 'Government/Public Building', 'Jail/Prison/Penitentiary/Corrections "
    "Facility') then 'Institutional' when location_name in ('Field/Woods', 'Lake/Waterway/Beach', "
    "'Camp/Campground') then 'Outdoor/Rural' when location_name in ('Other/Unknown') then 'Unknown' else 'Other' "
    "end as location_category, count(*) as count from inc group by 1",
)
def location_theme(spark, sf):
    rows = incidents(spark, sf, "location_name").select(
        fn.location_theme("location_name").alias("location_category")
    )
    return op.count_by(rows, "location_category").orderBy(F.desc("count"))


def _severity(column: str, label) -> object:
    def run(spark, sf):
        rows = incidents(spark, sf, "offense_category", column)
        labelled = rows.select(
            fn.severity("offense_category").alias("severity_level"), label(column).alias("label")
        )
        return op.share_of_group(labelled, ["label"], ["severity_level"])

    return run


for _name, _column, _label, _sql in (
    ("severity_by_victim_type", "victim_type", F.col, "victim_type"),
    ("severity_by_age", "victim_age", fn.age_band, age_band_sql("victim_age", V.EN_DASH)),
    (
        "severity_by_offender_age", "offender_age", lambda c: fn.age_band(c, V.HYPHEN),
        age_band_sql("offender_age", V.HYPHEN),
    ),
    (
        "severity_by_relationship", "relationship", fn.relationship_type,
        "case when relationship = 'Victim Was Stranger' then 'Stranger' "
        "when relationship is null or relationship = 'Relationship Unknown' then 'Unknown' "
        "else 'Known Relationship' end",
    ),
):
    query(
        _name,
        share_sql("label", "severity_level",
                  f"select {_HIGH} as severity_level, {_sql} as label from inc"),
    )(_severity(_column, _label))
