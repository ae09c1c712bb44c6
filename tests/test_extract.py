from __future__ import annotations

import re
from pathlib import Path

import pytest

from caseload.plans.extract import Profile, extract_incidents
from caseload.schemas import FLAT_COLUMNS, RAW_FILES
from caseload.sources import read_raw, read_raw_set

FILES = {
    "agencies": "AGENCY_ID,UCR_AGENCY_NAME,COUNTY_NAME,POPULATION,DATA_YEAR\n1.0,Peñasco PD,TAOS,500,2022\n2,Metro,KING,,2022\n",
    "incident": "data_year,INCIDENT_ID,AGENCY_ID,INCIDENT_DATE,INCIDENT_HOUR\n"
    "2022,10,1,01-APR-20,5.0\n2022,11,2,2022-05-06,\n2022,12,9,junk,23\n2022,10.05,1,2022-01-01,1\n",
    "offense": "OFFENSE_ID,INCIDENT_ID,OFFENSE_TYPE_ID,LOCATION_ID\n100,10,1,20\n101,10,2,21\n102,11,1,99\n",
    "victim": "VICTIM_ID,INCIDENT_ID,VICTIM_TYPE_ID,AGE_ID,AGE_NUM,RACE_ID,SEX_CODE,RESIDENT_STATUS_CODE\n"
    "1000,10,4,5,33.0,1,F,R\n1001,10,4,5,,2,M,N\n1002,11,4,6,,1,F,\n",
    "offender": "OFFENDER_ID,SEX_CODE,AGE_ID,RACE_ID,AGE_NUM\n50,M,5,1,20\n51,F,6,2,\n",
    "victim_offense_link": "VICTIM_ID,OFFENSE_ID\n1000,100\n1001,100\n1000,101\n1002,100\n",
    "victim_offender_rel": "VICTIM_ID,OFFENDER_ID,RELATIONSHIP_ID\n1000,51,1\n1000,50,2\n",
    "weapon_link": "OFFENSE_ID,WEAPON_ID\n100,8\n100,7\n",
    "offense_type": "OFFENSE_TYPE_ID,OFFENSE_CODE,OFFENSE_NAME,OFFENSE_CATEGORY_NAME\n1,13A,Aggravated Assault,Assault Offenses\n2,120,Robbery,Robbery\n",
    "location_type": "LOCATION_ID,LOCATION_NAME\n20,Residence/Home\n21,Bar/Nightclub\n",
    "age": "AGE_ID,AGE_NAME\n5,Age in Years\n6,Unknown\n",
    "race": "RACE_ID,RACE_DESC\n1,White\n2,Asian\n",
    "relationship": "RELATIONSHIP_ID,RELATIONSHIP_NAME\n1,Victim Was Stranger\n2,Victim Was Spouse\n",
    "weapon_type": "WEAPON_ID,WEAPON_NAME\n7,Handgun\n8,Rifle\n",
    "victim_type": "VICTIM_TYPE_ID,VICTIM_TYPE_NAME\n4,Individual\n",
}


@pytest.fixture
def folder(tmp_path: Path) -> Path:
    for table, text in FILES.items():
        (tmp_path / RAW_FILES[table]).write_text(text, encoding="latin-1")
    return tmp_path


def flat(df, *columns):
    key = lambda t: [(x is not None, str(x)) for x in t]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)


def test_read_raw(spark, folder):
    agencies = read_raw(spark, str(folder / RAW_FILES["agencies"]), "agencies")
    assert agencies.columns == ["agency_id", "ucr_agency_name", "county_name", "population"]
    assert flat(agencies, "agency_id", "ucr_agency_name") == [(1, "Peñasco PD"), (2, "Metro")]
    incident = read_raw(spark, str(folder / RAW_FILES["incident"]), "incident")
    assert sorted(r[0] or 0 for r in incident.select("incident_id").collect()) == [0, 10, 11, 12]


def test_flat_table(spark, folder):
    out = extract_incidents(read_raw_set(spark, str(folder)))
    assert out.columns == list(FLAT_COLUMNS)
    rows = flat(out, "offense_id", "victim_id", "victim_age_group", "offender_age", "relationship", "weapon_name")
    assert rows == [
        (None, None, None, None, None, None),
        (None, None, None, None, None, None),
        (100, 1000, "33 years old", "20 years old", "Victim Was Spouse", "Handgun"),
        (100, 1001, "Age in Years", None, None, "Handgun"),
        (101, 1000, "33 years old", "20 years old", "Victim Was Spouse", None),
        (102, None, None, None, None, None),
    ]
    first = out.filter("victim_id = 1001").first()
    assert (first.agency_name, first.county, first.population, first.incident_hour) == ("Peñasco PD", "TAOS", 500.0, 5.0)
    assert (first.victim_sex, first.victim_race, first.victim_resident_status) == ("M", "Asian", "N")
    assert (first.offense_category, first.location_name, first.victim_type) == ("Assault Offenses", "Residence/Home", "Individual")


def test_profiles(spark, folder):
    tables = read_raw_set(spark, str(folder))
    plain = extract_incidents(tables, Profile(age_fix=False, date_fix=True))
    ages = {r[0] for r in plain.select("victim_age_group").collect()}
    assert ages == {None, "Age in Years"}
    dates = {str(r[0]) for r in plain.select("incident_date").collect()}
    assert dates == {"2020-04-01", "2022-05-06", "None", "2022-01-01"}
    coded = extract_incidents(tables, Profile(key="offense_code"))
    assert "offense_name" not in coded.columns


def test_link_without_offense(spark, folder):
    tables = read_raw_set(spark, str(folder))
    tables["victim_offense_link"] = tables["victim_offense_link"].select("victim_id").distinct()
    out = extract_incidents(tables)
    assert flat(out.filter("victim_id is not null"), "offense_id", "victim_id") == [
        (100, 1000), (100, 1001), (101, 1000), (101, 1001), (102, 1002),
    ]


def test_hot_incident_changes_nothing(spark, folder):
    tables = read_raw_set(spark, str(folder))
    calm = flat(extract_incidents(tables), *FLAT_COLUMNS)
    hot = flat(extract_incidents(tables, Profile(hot_share=0.2)), *FLAT_COLUMNS)
    assert calm == hot


def test_missing_files(spark, folder):
    (folder / RAW_FILES["weapon_type"]).unlink()
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_raw_set(spark, str(folder))
    tables = read_raw_set(spark, str(folder), on_missing="skip")
    assert "weapon_type" not in tables
    out = extract_incidents(tables)
    assert "weapon_name" not in out.columns and out.count() == 6
    with pytest.raises(ValueError):
        read_raw_set(spark, str(folder), on_missing="perhaps")


def test_large_lookups_meet_narrow_rows(spark, monkeypatch):
    """Agencies and offense types are joined before the cases are wide; only small names come last."""
    from caseload.catalogue.bindings import raw_tables
    from caseload.plans import extract

    seen = []

    def spy(rows, *more, _describe=extract.describe):
        seen.append(set(rows.columns))
        return _describe(rows, *more)

    monkeypatch.setattr(extract, "describe", spy)
    extract.extract_incidents(raw_tables(spark, "/root/testdata/sf0.001"))
    assert {"agency_name", "county", "population", "offense_name", "offense_category"} <= seen[0]
    assert "location_name" not in seen[0]


def spread_tables(spark, incidents):
    """Two offenses for each of 40 incidents, two victims for every offense, every other incident known by ``incidents``."""
    ids = spark.range(80).selectExpr("id as offense_id", "id % 40 as incident_id", "id % 3 as offense_type_id", "id % 4 as location_id")
    victims = spark.range(160).selectExpr(
        "id as victim_id", "id % 40 as incident_id", "id % 2 as victim_type_id", "id % 2 as age_id", "'30' as age_num",
        "id % 2 as race_id", "'F' as sex_code", "'R' as resident_status_code")
    names = {"location_type": "location", "weapon_type": "weapon", "age": "age", "relationship": "relationship", "victim_type": "victim_type"}
    made = {n: spark.range(2).selectExpr(f"id as {c}_id", f"concat('{c}', id) as {c}_name") for n, c in names.items()}
    return made | {
        "incident": spark.createDataFrame(incidents, "incident_id long, agency_id long, incident_date string, incident_hour string"),
        "agencies": spark.range(3).selectExpr("id as agency_id", "concat('a', id) as ucr_agency_name", "'c' as county_name", "'9' as population"),
        "offense": ids, "victim": victims,
        "victim_offense_link": spark.range(160).selectExpr("id as victim_id", "id % 80 as offense_id"),
        "offender": spark.range(5).selectExpr("id as offender_id", "'M' as sex_code", "id % 2 as age_id", "id % 2 as race_id", "'20' as age_num"),
        "victim_offender_rel": spark.range(160).selectExpr("id as victim_id", "id % 7 as offender_id", "id % 2 as relationship_id"),
        "weapon_link": spark.range(60).selectExpr("id as offense_id", "id % 3 as weapon_id"),
        "offense_type": spark.range(3).selectExpr("id as offense_type_id", "concat('o', id) as offense_name", "'x' as offense_category_name"),
        "race": spark.range(2).selectExpr("id as race_id", "concat('r', id) as race_desc"),
    }


def test_cases_cross_no_shuffle(spark):
    """Incidents, offenses and victims are dealt by incident once each; rows with the three are not dealt again."""
    tables = spread_tables(spark, [(i, i % 3, "2020-01-01", "5") for i in range(50)])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = extract_incidents(tables, Profile(hot={}))
        plan = out._jdf.queryExecution().executedPlan().toString()
        dealt = re.findall(r"Exchange hashpartitioning\((incident_id#\d+L[^)]*)\)", plan)
        assert len(dealt) == 3 and not any("offense_id" in keys for keys in dealt)
        got = flat(out, *FLAT_COLUMNS)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # any share makes keys hot: the cases are joined first and dealt with their incident
    assert got == flat(extract_incidents(tables, Profile(hot_share=1e-3)), *FLAT_COLUMNS)
    assert len(got) == 170  # 160 links, and ten incidents without an offense


def test_hot_incidents_are_not_dealt_by_incident_alone(spark):
    """Ids that a third of the incidents hold, null among them, leave the join to be split by its left side."""
    from caseload.plans.extract import find_hot

    even = [(i, i % 3, "2020-01-01", "5") for i in range(40)]
    assert find_hot(spread_tables(spark, even), 0.2)["incident"] == []
    for key in (None, 7):
        tables = spread_tables(spark, even + [(key, 1, "2020-01-02", "6")] * 20)
        hot = find_hot(tables, 0.2)
        assert len(hot["incident"]) == 1 and hot["offense_incident"] == []
        calm, known = extract_incidents(tables, Profile(hot={})), extract_incidents(tables, Profile(hot_share=0.2))
        assert flat(calm, *FLAT_COLUMNS) == flat(known, *FLAT_COLUMNS)


def test_few_agencies_come_last_and_many_first(spark, monkeypatch):
    from caseload.plans import extract

    joined = []

    def spy(rows, agencies, _with=extract.with_agency):
        joined.append("victim_id" in rows.columns)
        return _with(rows, agencies)

    monkeypatch.setattr(extract, "with_agency", spy)
    tables = spread_tables(spark, [(i, i % 4, "2020-01-01", "5") for i in range(50)])
    few = flat(extract_incidents(tables, Profile(hot={})), *FLAT_COLUMNS)
    monkeypatch.setattr(extract, "fits", lambda df: False)
    assert few == flat(extract_incidents(tables, Profile(hot={})), *FLAT_COLUMNS) and joined == [True, False]
