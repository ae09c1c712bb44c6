from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from caseload.operators import count_by
from caseload.plans import marts
from caseload.session import settle


@pytest.fixture(scope="module")
def incidents(spark):
    rng = random.Random(5)
    pick = lambda *xs: rng.choice(xs)
    values = [
        (
            dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(1800)), rng.randrange(24),
            pick("Robbery", "Arson", "Fraud Offenses"), pick("n1", "n2"), pick("l1", "l2", "l3"),
            pick("20", "30", "-1"), pick("White", "Asian", None), pick("F", "M", "U"), pick("Gun", None),
            pick("TX", "TX", "TX", "NY"), pick("A", "B"), pick("p1", "p2"), rng.randrange(1, 900),
        )
        for _ in range(900)
    ]
    df = spark.createDataFrame(
        values,
        "incident_date date, incident_hour int, offense_category string, offense_name string, location_name string, "
        "victim_age_group string, victim_race string, victim_sex string, weapon_name string, state string, county string, "
        "agency_name string, population long",
    )
    return settle(df)


@pytest.fixture(scope="module")
def built(incidents):
    return marts.build_marts(incidents)


def test_every_mart_keeps_every_row(incidents, built):
    totals = {n: m.agg({"count": "sum"}).first()[0] for n, m in built.items() if "count" in m.columns}
    with_null = {"victim_race_by_offense": "victim_race", "weapon_usage": "weapon_name"}
    for name, total in totals.items():
        column = with_null.get(name)
        want = incidents.filter(f"{column} is not null").count() if column else 900
        assert total == want, name


def test_one_pass_equals_single_counts(incidents, built, rows):
    for name, columns in marts.COUNT_MARTS.items():
        labelled = incidents.select(*[F.expr(e).alias(n) for n, _, e in columns])
        alone = count_by(labelled, *[n for n, _, _ in columns], drop_null_keys=True)
        assert rows(built[name]) == rows(alone), name


def test_crosstab_equals_the_long_table(built):
    cross = built["victim_sex_by_offense_crosstab"].collect()
    long = {(r[0], r[1]): r[2] for r in built["victim_sex_by_offense"].collect()}
    assert {(r["Offense Category"], s): r[s] for r in cross for s in ("F", "M", "U")} == long


def test_rate_is_count_over_population(built):
    for r in built["state_crime_rates"].collect():
        assert r["CrimeRatePer100k"] == pytest.approx(r["count"] / r["Population"] * 100_000)


def test_dashboard(built, rows):
    tables = marts.dashboard_tables(built, 2021, "Arson", top_categories=2)
    assert tables["total_incidents"].first()[0] == 900
    assert [r["Month Name"] for r in tables["months"].collect()][:3] == ["Jan", "Feb", "Mar"]
    assert {r["Offense Category"] for r in tables["race"].collect()} == {"Arson"}
    assert len({r["Offense Category"] for r in tables["sex"].collect()}) == 2
    assert sum(r["percent"] for r in tables["weapons"].collect()) == pytest.approx(100)
    rates = [r["CrimeRatePer100k"] for r in tables["states"].collect()]
    assert rates == sorted(rates, reverse=True)
    assert [r[0] for r in tables["years"].collect()] == [2020, 2021, 2022, 2023, 2024]


def test_map_tables(spark, incidents, rows):
    fips = spark.createDataFrame([("48001", "A", "TX"), ("36003", "B", "NY")], "fips string, county_name string, state_name string")
    heat = marts.heatmap_mart(incidents, fips)
    predictions = spark.createDataFrame([("TX", "A", 0.5), ("TX", "A", 1.0), ("TX", "Z", 1.0)], "state string, county string, hotspot_probability double")
    tables = marts.map_tables(heat, predictions)
    assert {r["fips"] for r in tables["counts"].collect()} == {"48001", "36003"}
    assert rows(tables["probability"]) == [("TX", "A", 0.75, "48001")]


def test_rates_with_unnamed_agencies(spark, rows):
    values = [("TX", "p", 100), ("TX", None, 900), ("TX", "q", 200), (None, "p", 5)]
    df = spark.createDataFrame(values, "state string, agency_name string, population long")
    df = df.selectExpr("*", "'c' as county", "'x' as offense_category", "date'2020-01-01' as incident_date")
    want = [("TX", 3, 300, 1000.0)]
    assert rows(marts.state_rate_mart(df)) == want
    assert rows(marts.build_marts(df)["state_crime_rates"]) == want
