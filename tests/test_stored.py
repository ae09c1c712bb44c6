"""Extraction from bucketed facts equals extraction from the raw tables, without a shuffle of facts."""

from __future__ import annotations

from collections import Counter

import pytest

from caseload.catalogue.bindings import raw_tables
from caseload.plans.extract import Profile, extract_incidents
from caseload.plans.stored import extract_stored, forget, keyed_facts, open_facts, store_facts

SF = "/root/testdata/sf0.001"


def rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def odd(spark):
    """Few rows with every oddity: a hot incident, ids without a partner, null and repeated keys."""
    def make(schema, data):
        return spark.createDataFrame(data, schema)

    offenses = [(100 + i, 1 if i < 60 else i % 9, i % 3, i % 4) for i in range(90)]
    victims = [(1000 + i, 1 if i < 60 else i % 9, i % 2, i % 3, float(i), i % 3, "F", "R") for i in range(80)]
    return {
        "incident": make("incident_id int, agency_id int, incident_date string, incident_hour string",
                         [(i, i % 3, "2020-01-01", "5.0") for i in range(12)] + [(None, 1, "2020-01-02", None), (3, 2, "again", "x")]),
        "agencies": make("agency_id int, ucr_agency_name string, county_name string, population string", [(0, "a", "c", "10"), (1, "b", "d", None)]),
        "offense": make("offense_id long, incident_id long, offense_type_id int, location_id int",
                        offenses + [(100, 1, 2, 2), (None, 2, 1, 1), (999, None, 1, 1), (998, 77, 1, 1)]),
        "victim": make("victim_id long, incident_id long, victim_type_id int, age_id int, age_num double, race_id int, sex_code string, resident_status_code string",
                       victims + [(1000, 1, 1, 1, 5.0, 1, "M", "N"), (1001, 2, 1, 1, 5.0, 1, "M", "N"), (None, 1, 1, 1, 1.0, 1, "U", None), (1990, None, 1, 1, 1.0, 1, "U", None)]),
        "victim_offense_link": make("victim_id long, offense_id long",
                                    [(1000 + i % 80, 100 + i % 90) for i in range(300)] + [(1000, None), (None, 100), (5, 100), (1000, 5), (1990, 999), (1001, 100)]),
        "offender": make("offender_id long, sex_code string, age_id int, race_id int, age_num double", [(i, "M", i % 3, i % 3, 20.0 + i) for i in range(5)] + [(4, "F", 1, 1, 3.0)]),
        "victim_offender_rel": make("victim_id long, offender_id long, relationship_id int", [(1000 + i % 70, i % 7, i % 2) for i in range(150)] + [(None, 1, 1), (1003, None, 0)]),
        "weapon_link": make("offense_id long, weapon_id int", [(100 + i % 80, i % 5) for i in range(170)] + [(None, 1), (100, None)]),
        "offense_type": make("offense_type_id int, offense_name string, offense_category_name string", [(0, "x", "X"), (1, "y", "Y")]),
        "location_type": make("location_id int, location_name string", [(i, f"l{i}") for i in range(3)]),
        "weapon_type": make("weapon_id int, weapon_name string", [(i, f"w{i}") for i in range(4)]),
        "age": make("age_id int, age_name string", [(0, "Age in Years"), (1, "Unknown")]),
        "race": make("race_id int, race_desc string", [(0, "r"), (1, "s")]),
        "relationship": make("relationship_id int, relationship_name string", [(0, "p"), (1, "q")]),
        "victim_type": make("victim_type_id int, victim_type_name string", [(0, "v"), (1, "w")]),
    }


@pytest.mark.parametrize("drop", [(), ("weapon_link",), ("victim_offender_rel", "offender")])
@pytest.mark.parametrize("share", [0.3, 1.0])
def test_equals_extraction_from_raw_tables(spark, odd, drop, share):
    """With and without a hot incident (60 of about 90 offenses belong to one)."""
    tables = {n: t for n, t in odd.items() if n not in drop}
    stored = store_facts(tables, buckets=3, hot_share=share)
    assert ("offense" in stored.hot) == (share < 1)
    if share < 1:
        assert stored.even["offense"].filter("incident_id = 1").isEmpty() and not stored.hot["offense"].filter("incident_id = 1").isEmpty()
    want = rows(extract_incidents(tables))
    assert rows(extract_stored(stored, tables)) == want and sum(want.values()) > 100
    forget(stored)


def test_no_fact_is_shuffled_and_no_job_reads_one(spark):
    tables = raw_tables(spark, SF)
    stored = store_facts(tables, buckets=5)
    df = extract_stored(stored, tables)
    text = plan(df)
    assert "Exchange hashpartitioning" not in text and "Exchange rangepartitioning" not in text
    assert text.count("SortMergeJoin") == 5 and "Bucketed: true" in text
    df.collect()
    assert "Exchange hashpartitioning" not in plan(df).split("== Initial Plan ==")[0]
    assert "Exchange hashpartitioning" in plan(extract_incidents(tables))


def test_tables_are_opened_by_a_later_session(spark, odd, tmp_path):
    folder = str(tmp_path / "facts")
    stored = store_facts(odd, folder, buckets=4)
    want = rows(extract_stored(stored, odd))
    forget(stored)
    again = open_facts(spark, folder)
    assert again.buckets == 4 and rows(extract_stored(again, odd)) == want
    assert "Bucketed: true" in plan(extract_stored(again, odd, Profile(age_fix=False)))
    # the session's own joins are planned as before
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_owners_come_from_buckets(spark):
    """The incident of a link or weapon is taken from the written parent, not made again from its raw table."""
    asked = {}

    def kept(name, df):
        asked[name] = plan(df)
        return [df.sparkSession.range(0).selectExpr("id as victim_id", "id as offense_id", "id as incident_id")]

    keyed_facts(raw_tables(spark, SF), kept=kept)
    assert set(asked) == {"incident", "offense", "victim", "victim_offense_link", "weapon_link", "first_offender"}
    # one scan of lines for the links, none for their victims
    assert asked["victim_offense_link"].split("== Initial Plan ==")[0].count("FileScan parquet") == 1
