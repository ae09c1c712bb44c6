"""Tables written by Spark below the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as op
from ..plans import marts
from ..plans.extract import extract_incidents
from ..schemas import (
    FLAT_SCHEMA,
    INCIDENT_SCHEMA,
    MART_SCHEMAS,
    PREDICTION_COLUMNS,
    RAW_FILES,
)
from ..session import fresh_path, settle
from ..sources import (
    read_fips,
    read_incidents,
    read_marts,
    read_raw_set,
    read_state_years,
    read_states,
    write_cleaned,
    write_marts,
    write_predictions,
    write_result,
)
from .bindings import fips, incidents, raw_tables
from .registry import query
from .relational import _extract_sql

_FLAT = (
    "offense_id", "agency_name", "county", "population", "location_name", "incident_date",
    "incident_hour", "offense_name", "offense_category", "weapon_name", "victim_type",
    "victim_sex", "victim_age_group", "victim_race", "victim_resident_status", "offender_sex",
    "relationship", "offender_age", "victim_id", "offender_race", "state", "year",
)
_TYPED = {
    "population": "double", "incident_hour": "double", "incident_date": "string",
    "offender_age": "string",
}


def _flat(spark, sf):
    """The test incidents in the 22-column form of the merged files."""
    rows = incidents(spark, sf, *_FLAT)
    return rows.withColumns({c: F.col(c).cast(t) for c, t in _TYPED.items()})


_FLAT_SQL = "select " + ", ".join(
    f"cast({c} as {_TYPED[c]}) as {c}" if c in _TYPED
    else f"nullif({c}, '') as {c}" if c == "weapon_name"
    else c
    for c in _FLAT
) + " from inc"


@query("csv_roundtrip", _FLAT_SQL)
def csv_roundtrip(spark, sf):
    """Display names in the file, internal names after it. A file is read whole by one task, packed or not."""
    path = fresh_path(spark, "incidents")
    write_cleaned(_flat(spark, sf), path, "csv", "gzip")
    return read_incidents(spark, path, INCIDENT_SCHEMA)


@query("parquet_partitioned", _FLAT_SQL.replace("nullif(weapon_name, '')", "weapon_name"))
def parquet_partitioned(spark, sf):
    path = fresh_path(spark, "cleaned")
    write_cleaned(_flat(spark, sf), path)
    return read_incidents(spark, path, INCIDENT_SCHEMA, "parquet")


@query(
    "state_year_files",
    "select case state when 'MIDDLE EAST' then 'Middle East' "
    "else state[1:1] || lower(state[2:]) end as state, year, offense_category, count(*) as count "
    "from inc group by 1, 2, 3",
)
def state_year_files(spark, sf):
    """One folder per state and year; both are taken from its name."""
    path = fresh_path(spark, "yearly")
    flat = _flat(spark, sf)
    name = F.concat_ws("_", F.replace(F.lower("state"), F.lit(" "), F.lit("_")), "year")
    columns = FLAT_SCHEMA.fieldNames()
    (
        op.display(flat.select(*columns, name.alias("_file")))
        .write.partitionBy("_file")
        .option("header", True)
        .csv(path)
    )
    rows = read_state_years(spark, f"{path}/*")
    return op.count_by(rows, "state", "year", "offense_category")


@query(
    "state_files",
    "select year, count(*) as count from inc group by 1",
)
def state_files(spark, sf):
    """Merged files of which one is absent."""
    path = fresh_path(spark, "states")
    flat = _flat(spark, sf)
    write_result(op.display(flat), f"{path}/all.csv")
    rows, _ = read_states(spark, [f"{path}/absent.csv", f"{path}/all.csv"])
    return op.count_by(rows, "year")


@query("state_file_rows", "select count(*) as count from inc")
def state_file_rows(spark, sf):
    path = fresh_path(spark, "states")
    write_result(op.display(_flat(spark, sf)), f"{path}/all.csv")
    _, per_file = read_states(spark, [f"{path}/all.csv", f"{path}/absent.csv"])
    return per_file.agg(F.sum("count").alias("count"))


@query("extract_from_csv", _extract_sql(age_fix=True))
def extract_from_csv(spark, sf):
    """The raw tables as CSV files with keys as float text, then extracted."""
    path = fresh_path(spark, "raw")
    for name, frame in raw_tables(spark, sf).items():
        texts = [
            F.concat(F.col(c).cast("string"), F.lit(".0")).alias(c.upper())
            if c.endswith("_id")
            else F.col(c).alias(c.upper())
            for c in frame.columns
        ]
        rows = frame.select(*texts, F.lit(2020).alias("DATA_YEAR"))
        write_result(rows, f"{path}/{RAW_FILES[name]}", compression="gzip")
    # the extraction reads a table more than once; its texts are parsed once
    return extract_incidents({name: settle(frame, name, "zstd") for name, frame in read_raw_set(spark, path).items()})


@query(
    "fips_file",
    "select cast(fips as string) as fips, county_name, state_name from fips",
)
def fips_file(spark, sf):
    path = fresh_path(spark, "fips")
    write_result(fips(spark, sf), path)
    return read_fips(spark, path)


@query(
    "marts_roundtrip",
    "select 'yearly' as mart, cast(year as string) as label, count(*) as count from inc group by 2 "
    "union all select 'weekday', dayname(incident_date), count(*) from inc group by 2 "
    "union all select 'state', state, count(*) from inc group by 2",
)
def marts_roundtrip(spark, sf):
    path = fresh_path(spark, "marts")
    rows = incidents(spark, sf, *_FLAT)
    write_marts(marts.build_marts(rows, fips(spark, sf), ["F", "M", "U", "Unknown"]), path)
    found = read_marts(spark, path)
    parts = [
        found["yearly_trends"].selectExpr("'yearly' as mart", "cast(Year as string) as label", "count"),
        found["day_of_week_patterns"].selectExpr("'weekday' as mart", "DayOfWeek as label", "count"),
        found["state_crime_rates"].selectExpr("'state' as mart", "State as label", "count"),
    ]
    return op.union_states(parts)


@query(
    "predictions_file",
    "select state, county, year, month, count(*) as crime_count, 1 as is_hotspot, "
    "1.0::double as prediction, 0.5::double as hotspot_probability from inc group by 1, 2, 3, 4",
)
def predictions_file(spark, sf):
    path = fresh_path(spark, "predictions")
    rows = incidents(spark, sf, "state", "county", "year", "month")
    monthly = op.count_by(rows, "state", "county", "year", "month", name="crime_count")
    scored = monthly.withColumns(
        {"is_hotspot": F.lit(1), "prediction": F.lit(1.0), "hotspot_probability": F.lit(0.5)}
    )
    write_predictions(scored, path)
    return spark.read.schema(MART_SCHEMAS["hotspot_predictions"][0]).option("header", True).csv(
        path
    ).select(*PREDICTION_COLUMNS)


