"""Profiling, rules and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as op
from .. import vocabulary as V
from ..plans import cleaning, profile
from .bindings import INC, incidents, table
from .registry import query

_TEXT = (
    "offense_name", "offense_category", "weapon_name", "location_name", "victim_type",
    "victim_sex", "victim_age_group", "victim_race", "victim_resident_status", "relationship",
    "state", "county", "agency_name",
)
_NUMBERS = ("population", "victim_age", "offender_age", "incident_hour", "year")


def _union(parts) -> str:
    return " union all ".join(parts)


_WITH_GAPS = tuple(c for c in INC if c not in ("population_gaps",)) + ("population_gaps",)
_STRINGS = set(_TEXT) | {"offender_sex", "offender_race"}


@query(
    "missing_report",
    _union(
        f"select '{c}' as column, count(*) filter (where {c} is null"
        + (f" or {c} = ''" if c in _STRINGS else "")
        + f") as missing, count(*) filter (where {c} is null"
        + (f" or {c} = ''" if c in _STRINGS else "")
        + ") / count(*) * 100 as percent from inc"
        for c in _WITH_GAPS
    ),
)
def missing_report(spark, sf):
    return profile.missing_report(incidents(spark, sf))


@query(
    "missing_report_nulls",
    _union(
        f"select '{c}' as column, count(*) filter (where {c} is null) as missing, "
        f"count(*) filter (where {c} is null) / count(*) * 100 as percent from inc"
        for c in _TEXT
    ),
)
def missing_report_nulls(spark, sf):
    return profile.missing_report(incidents(spark, sf, *_TEXT), blank=False)


@query(
    "describe_numeric",
    _union(
        f"select '{c}' as column, count({c}) as count, round(avg({c}), 6) as mean, "
        f"round(stddev_samp({c}), 6) as stddev, cast(min({c}) as double) as min, "
        f"cast(max({c}) as double) as max from inc"
        for c in _NUMBERS
    ),
)
def describe_numeric(spark, sf):
    stats = profile.describe_numeric(incidents(spark, sf, *_NUMBERS))
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


def _outliers_sql(k: float) -> str:
    return _union(
        f"select '{c}' as column, count(*) filter (where abs(({c} - m) / s) > {k}) as outliers "
        f"from inc, (select avg({c}) as m, stddev_samp({c}) as s from inc)"
        for c in _NUMBERS
    )


@query("zscore_outliers", _outliers_sql(3.0))
def zscore_outliers(spark, sf):
    return profile.zscore_outliers(incidents(spark, sf, *_NUMBERS))


@query("zscore_outliers_narrow", _outliers_sql(1.5))
def zscore_outliers_narrow(spark, sf):
    return profile.zscore_outliers(incidents(spark, sf, *_NUMBERS), k=1.5)


@query(
    "cardinality_exact",
    _union(
        f"select '{c}' as column, count(distinct {c}) as distinct, "
        f"count(distinct {c}) / count(*) as ratio from inc"
        for c in _TEXT
    ).replace(" as distinct,", ' as "distinct",'),
)
def cardinality_exact(spark, sf):
    return profile.cardinality_report(incidents(spark, sf, *_TEXT), exact=True)


@query("cardinality_approx")
def cardinality_approx(spark, sf):
    return profile.cardinality_report(incidents(spark, sf, *_TEXT))


@query(
    "top_values_all_columns",
    "select * from (select *, cast(row_number() over (partition by \"column\" "
    "order by count desc, value nulls first) as int) as rank from ("
    + _union(
        f"select '{c}' as column, {c} as value, count(*) as count from inc group by {c}"
        for c in _TEXT
    )
    + ")) where rank <= 10",
)
def top_values_all_columns(spark, sf):
    return profile.top_values(incidents(spark, sf, *_TEXT))


@query(
    "date_coverage",
    "select min(incident_date) as earliest, max(incident_date) as latest from inc",
)
def date_coverage(spark, sf):
    return profile.date_coverage(incidents(spark, sf, "incident_date"))


_CORRELATED = ("population", "victim_age", "offender_age", "incident_hour")


@query(
    "correlations",
    _union(
        f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as correlation from inc"
        for i, a in enumerate(_CORRELATED)
        for b in _CORRELATED[i + 1 :]
    ),
)
def correlations(spark, sf):
    pairs = profile.correlations(incidents(spark, sf, *_CORRELATED))
    return pairs.withColumn("correlation", F.round("correlation", 6))


@query(
    "sanity_checks",
    "select 'individual_without_age' as check, count(*) filter (where victim_type = 'Individual' "
    "and victim_age_group is null) as rows from inc union all "
    "select 'homicide_without_weapon', count(*) filter (where "
    "offense_category = 'Homicide Offenses' and weapon_name is null) from inc".replace(
        "as check", 'as "check"'
    ).replace("as rows", 'as "rows"'),
)
def sanity_checks(spark, sf):
    return profile.sanity_checks(
        incidents(spark, sf, "victim_type", "victim_age_group", "offense_category", "weapon_name")
    )


def _age_rules_sql(c: str) -> dict[str, str]:
    valid = f"{c} is not null and {c} <> -1"
    return {
        f"{c}: unknown": f"{c} = -1",
        f"{c}: valid": valid,
        f"{c}: below 0": f"{valid} and {c} < 0",
        f"{c}: above 100": f"{valid} and {c} > 100",
        f"{c}: above 120": f"{valid} and {c} > 120",
        f"{c}: impossible": f"{c} = 185",
    }


_RULES = {
    **_age_rules_sql("victim_age"),
    **_age_rules_sql("offender_age"),
    "population: zero": "population = 0",
    "population: negative": "population < 0",
    "year: out of range": "year not between 1996 and 2000",
    "incident_hour: out of range": "incident_hour not between 0 and 23",
}


@query(
    "rule_report",
    _union(
        f"select '{name}' as rule, count(*) filter (where {c}) as n from inc"
        for name, c in _RULES.items()
    ),
)
def rule_report(spark, sf):
    rows = incidents(spark, sf, "victim_age", "offender_age", "population", "year", "incident_hour")
    return profile.rule_report(
        rows, profile.default_rules("victim_age", "offender_age", (1996, 2000))
    )


@query(
    "offending_values",
    "select 'year' as column, cast(year as double) as value, count(*) as count from inc "
    "where year not between 1996 and 2000 group by 2 union all "
    "select 'incident_hour', cast(incident_hour as double), count(*) from inc "
    "where incident_hour not between 0 and 23 group by 2",
)
def offending_values(spark, sf):
    rows = incidents(spark, sf, "year", "incident_hour")
    return profile.offending_values(rows, {"year": (1996, 2000), "incident_hour": V.VALID_HOURS})


@query("overview", 'select count(*) as "rows", 5 as columns from inc')
def overview(spark, sf):
    return profile.overview(incidents(spark, sf, *_NUMBERS))


_CLEAN = ("offense_id", "state", "county", "weapon_name", "victim_race", "victim_age",
          "offender_age", "incident_hour", "victim_resident_status", "relationship")
_CRITICAL = ("weapon_name", "victim_age", "offender_age", "relationship")



def _clean_sql(min_rows: str) -> str:
    complete = " and ".join(f"{c} is not null" for c in _CRITICAL)
    nulls = " + ".join(f"(case when {c} is null then 1 else 0 end)" for c in _CLEAN)
    return (
        f"with t as (select {', '.join(_CLEAN)}, {complete} as complete, {nulls} as nulls from inc), "
        f"s as (select state, count(*) filter (where complete) >= {min_rows} as plenty "
        "from t group by state) "
        f"select {', '.join('t.' + c for c in _CLEAN)} from t join s on t.state = s.state "
        "where case when plenty then complete else nulls <= 2 end"
    )




@query("clean_by_state_enough", _clean_sql("10"))
def clean_by_state_enough(spark, sf):
    return cleaning.clean_by_state(incidents(spark, sf, *_CLEAN), _CRITICAL, min_rows=10)


@query("clean_by_state_short", _clean_sql("600000"))
def clean_by_state_short(spark, sf):
    return cleaning.clean_by_state(incidents(spark, sf, *_CLEAN), _CRITICAL)


@query(
    "impute_all",
    "with w as (select weapon_name as v from inc where weapon_name is not null group by 1 "
    "order by count(*) desc, v limit 1), "
    "h as (select cast(trunc(quantile_cont(incident_hour, 0.5)) as int) as v from inc), "
    "p as (select state, cast(trunc(quantile_cont(population_gaps, 0.5)) as bigint) as v "
    "from inc group by 1) "
    "select offense_id, inc.state as state, "
    "coalesce(weapon_name, (select v from w)) as weapon_name, "
    "coalesce(victim_race, 'Unknown') as victim_race, "
    "coalesce(incident_hour, (select v from h)) as incident_hour, "
    "coalesce(population_gaps, p.v) as population_gaps, "
    "population_gaps is null as population_gaps_imputed "
    "from inc join p on inc.state = p.state",
)
def impute_all(spark, sf):
    rows = incidents(
        spark, sf, "offense_id", "state", "weapon_name", "victim_race", "incident_hour",
        "population_gaps",
    )
    filled = cleaning.impute(
        rows, group_median_of={"population_gaps": "state"}, exact=True, flag=True
    )
    return filled.select(*rows.columns, "population_gaps_imputed")


@query("impute_approx")
def impute_approx(spark, sf):
    rows = incidents(
        spark, sf, "offense_id", "state", "weapon_name", "victim_race", "incident_hour",
        "population_gaps",
    )
    return cleaning.impute(rows, group_median_of={"population_gaps": "state"})


@query(
    "oversample_exact",
    "select victim_race, cast(greatest(count(*), (select count(*) // 4 from lineitem)) as bigint) "
    "as count from inc where victim_race is not null group by 1",
)
def oversample_exact(spark, sf):
    rows = incidents(spark, sf, "offense_id", "line_no", "victim_race").filter(
        "victim_race is not null"
    )
    target = table(spark, sf, "lineitem").count() // 4
    return op.count_by(cleaning.oversample_to(rows, target, "victim_race"), "victim_race")


@query("oversample_expected")
def oversample_expected(spark, sf):
    rows = incidents(spark, sf, "offense_id", "line_no", "state")
    return op.count_by(cleaning.oversample_about(rows, 600_000), "state")


_AGE_SQL = (
    "case when {c} = '-1' then -1 "
    "when regexp_matches({c}, '^\\d+-\\d+') then cast(floor((cast(regexp_extract({c}, "
    "'^(\\d+)-(\\d+)', 1) as bigint) + cast(regexp_extract({c}, '^(\\d+)-(\\d+)', 2) as bigint)) "
    "/ 2) as int) when regexp_matches({c}, '\\d+') then cast(regexp_extract({c}, '(\\d+)', 1) "
    "as int) else -1 end"
)
_DATED = (
    "select offense_id, year, victim_age_group, offender_age, case when year = 2000 then "
    "upper(strftime(incident_date, '%d-%b-%y')) else strftime(incident_date, '%Y-%m-%d') end "
    "as incident_date from inc"
)
_AGED = _AGE_SQL.format(c="victim_age_group")


def dated(spark, sf):
    """Dates as the sources write them: one year in short form."""
    rows = incidents(
        spark, sf, "offense_id", "year", "victim_age_group", "offender_age", "incident_date"
    )
    text = F.when(
        F.col("year") == 2000, F.upper(F.date_format("incident_date", "dd-MMM-yy"))
    ).otherwise(F.date_format("incident_date", "yyyy-MM-dd"))
    return rows.withColumn("incident_date", text)


DATED_SQL = (
    f"select * from (select offense_id, year, {_AGED} as victim_age_group, "
    "coalesce(offender_age, -1) as offender_age, "
    "case when year = 2000 then cast(strptime(incident_date, '%d-%b-%y') as date) "
    "else cast(incident_date as date) end as incident_date, "
    "case when year = 2000 then strftime(strptime(incident_date, '%d-%b-%y'), '%Y-%m-%d') "
    f"else incident_date end as incident_date_text from ({_DATED})) "
    "where victim_age_group is null or victim_age_group <> 185"
)


@query("standardise", DATED_SQL)
def standardise(spark, sf):
    return cleaning.standardise(dated(spark, sf), short_year=2000)[0]


METRICS_SQL = (
    "select count(*) as rows_in, count(victim_age_group) as victim_age_group_converted, "
    "count(offender_age) as offender_age_converted, "
    f"count(*) filter (where {_AGED} = 185) as rows_dropped, "
    "count(*) filter (where year = 2000) as dates_fixed from inc"
)


@query("standardise_metrics", METRICS_SQL)
def standardise_metrics(spark, sf):
    return cleaning.standardise(dated(spark, sf), short_year=2000)[1]


@query("drop_invalid_age", "select offense_id, victim_age from inc where victim_age is distinct from 185")
def drop_invalid_age(spark, sf):
    return op.drop_invalid_age(incidents(spark, sf, "offense_id", "victim_age"), column="victim_age")


@query(
    "drop_incomplete",
    f"select {', '.join(_CLEAN)} from inc where "
    + " and ".join(f"{c} is not null" for c in _CRITICAL),
)
def drop_incomplete(spark, sf):
    return op.drop_incomplete(incidents(spark, sf, *_CLEAN), _CRITICAL)


@query(
    "max_nulls",
    f"select {', '.join(_CLEAN)} from inc where "
    + " + ".join(f"(case when {c} is null then 1 else 0 end)" for c in _CLEAN)
    + " <= 2",
)
def max_nulls(spark, sf):
    return op.max_nulls(incidents(spark, sf, *_CLEAN))


@query(
    "rows_in_and_out",
    "select state, count(*) as rows_in, count(*) filter (where weapon_name is not null and "
    "victim_age is not null) as rows_out, count(*) filter (where weapon_name is not null and "
    "victim_age is not null) - count(*) as change from inc group by 1",
)
def rows_in_and_out(spark, sf):
    rows = incidents(spark, sf, "state", "weapon_name", "victim_age")
    return cleaning.row_change(rows, op.drop_incomplete(rows, ["weapon_name", "victim_age"]))
