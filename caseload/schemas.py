"""Explicit schemas. Nothing in this package infers one."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


# internal name -> display name, in output order: the 20 columns of the flat
# incident table followed by the two added when states and years are merged.
DISPLAY_NAMES = {
    "offense_id": "Offense ID",
    "agency_name": "Agency Name",
    "county": "County",
    "population": "Population",
    "location_name": "Location Name",
    "incident_date": "Incident Date",
    "incident_hour": "Incident Hour",
    "offense_name": "Offense Name",
    "offense_category": "Offense Category",
    "weapon_name": "Weapon Name",
    "victim_type": "Victim Type",
    "victim_sex": "Victim Sex",
    "victim_age_group": "Victim Age Group",
    "victim_race": "Victim Race",
    "victim_resident_status": "Victim Resident Status",
    "offender_sex": "Offender Sex",
    "relationship": "Victim-Offender Relationship",
    "offender_age": "Offender Age",
    "victim_id": "Victim Id",
    "offender_race": "Offender Race",
    "state": "State",
    "year": "Year",
}
FLAT_COLUMNS = tuple(DISPLAY_NAMES)[:20]

_FLAT_TYPES = {
    "offense_id": _L,
    "population": _D,
    "incident_hour": _D,
    "victim_id": _L,
    "year": _I,
}
INCIDENT_SCHEMA = T.StructType(
    [T.StructField(n, _FLAT_TYPES.get(n, _S), True) for n in DISPLAY_NAMES]
)
FLAT_SCHEMA = T.StructType(INCIDENT_SCHEMA.fields[:20])

# Raw tables: every column is read as text; keys are coerced after the read
# because they arrive as integer or float text.
RAW_TABLES = {
    "incident": ("incident_id", "agency_id", "incident_date", "incident_hour"),
    "agencies": ("agency_id", "ucr_agency_name", "county_name", "population"),
    "offense": ("offense_id", "incident_id", "offense_type_id", "offense_code", "location_id"),
    "victim": (
        "victim_id", "incident_id", "victim_type_id", "age_id", "age_num", "race_id",
        "sex_code", "resident_status_code",
    ),
    "offender": ("offender_id", "sex_code", "age_id", "race_id", "age_num"),
    "victim_offense_link": ("victim_id", "offense_id"),
    "victim_offender_rel": ("victim_id", "offender_id", "relationship_id"),
    "weapon_link": ("offense_id", "weapon_id"),
    "offense_type": ("offense_type_id", "offense_code", "offense_name", "offense_category_name"),
    "location_type": ("location_id", "location_name"),
    "age": ("age_id", "age_name"),
    "race": ("race_id", "race_desc"),
    "relationship": ("relationship_id", "relationship_name"),
    "weapon_type": ("weapon_id", "weapon_name"),
    "victim_type": ("victim_type_id", "victim_type_name"),
}
# File name of each raw table.
RAW_FILES = {
    "agencies": "agencies.csv",
    "incident": "NIBRS_incident.csv",
    "offense": "NIBRS_OFFENSE.csv",
    "victim": "NIBRS_VICTIM.csv",
    "offender": "NIBRS_OFFENDER.csv",
    "victim_offense_link": "NIBRS_VICTIM_OFFENSE.csv",
    "victim_offender_rel": "NIBRS_VICTIM_OFFENDER_REL.csv",
    "weapon_link": "NIBRS_WEAPON.csv",
    "offense_type": "NIBRS_OFFENSE_TYPE.csv",
    "location_type": "NIBRS_LOCATION_TYPE.csv",
    "age": "NIBRS_AGE.csv",
    "race": "REF_RACE.csv",
    "relationship": "NIBRS_RELATIONSHIP.csv",
    "weapon_type": "NIBRS_WEAPON_TYPE.csv",
    "victim_type": "NIBRS_VICTIM_TYPE.csv",
}
KEY_COLUMNS = (
    "incident_id", "offense_id", "victim_id", "offender_id", "agency_id", "location_id",
    "weapon_id", "age_id", "race_id", "offense_type_id", "relationship_id", "victim_type_id",
)
TEXT_KEYS = ("offense_code",)

FIPS_SCHEMA = struct(fips=_S, county_name=_S, state_name=_S)

PREDICTION_COLUMNS = (
    "state", "county", "year", "month", "crime_count", "is_hotspot", "prediction",
    "hotspot_probability",
)

# mart name -> (columns with types, required by the reader)
MART_SCHEMAS = {
    "yearly_trends": (struct(Year=_I, count=_L), True),
    "monthly_trends": (struct(Year=_I, Month=_I, count=_L), True),
    "hourly_distribution": (struct(**{"Incident Hour": _D, "count": _L}), True),
    "offense_categories": (struct(**{"Offense Category": _S, "count": _L}), True),
    "top_offense_names": (struct(**{"Offense Name": _S, "count": _L}), True),
    "top_locations": (struct(**{"Location Name": _S, "count": _L}), True),
    "victim_age_distribution": (struct(**{"Victim Age Group": _S, "count": _L}), True),
    "victim_race_by_offense": (
        struct(**{"Offense Category": _S, "Victim Race": _S, "count": _L}), True),
    "victim_sex_by_offense": (
        struct(**{"Offense Category": _S, "Victim Sex": _S, "count": _L}), True),
    "weapon_usage": (struct(**{"Weapon Name": _S, "count": _L}), True),
    "state_crime_rates": (
        struct(State=_S, count=_L, Population=_D, CrimeRatePer100k=_D), True),
    "day_of_week_patterns": (struct(DayOfWeek=_S, count=_L), False),
    "victim_sex_by_offense_crosstab": (None, False),
    "county_heatmap": (
        struct(**{"State": _S, "County": _S, "Offense Category": _S, "count": _L, "fips": _S}),
        False,
    ),
    "hotspot_predictions": (
        struct(state=_S, county=_S, year=_I, month=_I, crime_count=_L, is_hotspot=_I,
               prediction=_D, hotspot_probability=_D),
        False,
    ),
    "victim_type_by_severity": (
        struct(**{"Severity_Level": _S, "Victim Type": _S, "count": _L, "Total": _L, "Percentage": _D}), False),
    "relationship_by_severity": (
        struct(**{"Severity_Level": _S, "Relationship Type": _S, "count": _L, "Total": _L, "Percentage": _D}), False),
    "victim_age_distribution_summary": (struct(**{"Age Range": _S, "count": _L, "Percentage": _D}), False),
    "victim_age_distribution_nighttime": (
        struct(**{"Age Range": _S, "Nighttime_Incident_Count": _L, "Percentage": _D}), False),
    "victim_age_vulnerability_nighttime": (
        struct(**{"Age Range": _S, "Total_Incident_Count": _L, "Nighttime_Incident_Count": _L,
                  "Vulnerability % (Nighttime)": _D}), False),
    "victim_sex_by_offense_percentages": (
        struct(**{"Offense Category": _S, "Victim Sex": _S, "Incident_Count": _L, "Total_Per_Category": _L,
                  "Percentage": _D}), False),
}
