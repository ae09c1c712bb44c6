from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from caseload.plans import cleaning, profile

SCHEMA = "state string, weapon_name string, county string, victim_race string, n int"


def frame(spark):
    values = [("big", "Gun", "c", "w", i) for i in range(8)] + [("big", None, "c", None, 8)]
    values += [("small", "Gun", "c", "w", 10), ("small", None, None, "w", 11), ("small", None, None, None, 12)]
    values += [(None, "Gun", "c", "w", 13)]
    return spark.createDataFrame(values, SCHEMA)


def test_states_choose_their_filter(spark, rows):
    out = cleaning.clean_by_state(frame(spark), ["weapon_name", "county"], min_rows=5)
    assert [r[0] for r in rows(out, "n")] == [*range(8), 10, 11]


def test_oversampling_is_exact_and_repeatable(spark):
    out = cleaning.clean_by_state(frame(spark), ["weapon_name", "county"], min_rows=5)
    first = cleaning.oversample_to(out, 5)
    counts = Counter(r["state"] for r in first.collect())
    assert counts == {"big": 8, "small": 5}
    per_row = Counter(r["n"] for r in first.filter("state = 'small'").collect())
    assert sorted(per_row.values()) == [2, 3]
    again = cleaning.oversample_to(out.repartition(5), 5)
    assert Counter(map(tuple, first.collect())) == Counter(map(tuple, again.collect()))


def test_oversampling_orders_one_range_of_a_group(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cleaning, "RANGE_ROWS", 10)
    sizes = {"a": 37, "b": 50, "c": 1, "d": 333, "e": 334, "f": 1000, None: 5}
    made = [(g, i // 3) for g, n in sizes.items() for i in range(n)]  # rows that occur three times as well
    spark.createDataFrame(made, "state string, n int").repartition(5).write.parquet(f"{tmp_path}/given")
    df = spark.read.parquet(f"{tmp_path}/given")
    target, want = 1000, Counter()
    hashes = df.withColumn("h", F.xxhash64("state", "n", F.lit(42))).collect()
    for g, n in sizes.items():
        ranked = sorted((r.h, r.state, r.n) for r in hashes if r.state == g) if g else []
        for k, (_, state, i) in enumerate(ranked):
            want[state, i] += target // n + (k < target % n)
    want += Counter((g, i) for g, i in made if g is None)
    out = cleaning.oversample_to(df, target)
    assert Counter(map(tuple, out.collect())) == want
    # the rows given are read once; of the copy kept of them only the ranges cut are shuffled
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert f"{tmp_path}/given" not in plan
    moved = cleaning.oversample_to(df, target).filter("state = 'd'")._jdf.queryExecution().executedPlan().toString()
    assert moved.count("Exchange hashpartitioning") == 1


def test_oversampling_in_expectation(spark):
    df = spark.range(3000).selectExpr("'s' as state", "id")
    got = cleaning.oversample_about(df, 10_000)
    per_row = Counter(r["id"] for r in got.collect())
    assert set(per_row.values()) == {3, 4} and len(per_row) == 3000
    assert abs(got.count() - 10_000) < 200
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, cleaning.oversample_about(df.repartition(3), 10_000).collect()))


@pytest.mark.parametrize("exact", [True, False])
def test_imputation(spark, rows, exact):
    values = [("a", "Gun", 10.0, 3), ("a", None, None, None), ("a", "Gun", 30.0, 5), ("a", "Axe", 20.0, 5), ("b", None, None, 7), (None, "Axe", None, 5)]
    df = spark.createDataFrame(values, "state string, weapon_name string, population double, incident_hour int")
    df = df.withColumn("victim_race", F.lit(None).cast("string"))
    out = cleaning.impute(df, exact=exact, flag=True)
    assert rows(out, "state", "weapon_name", "population", "incident_hour", "victim_race") == [
        (None, "Axe", None, 5, "Unknown"), ("a", "Axe", 20.0, 5, "Unknown"), ("a", "Axe", 20.0, 5, "Unknown"),
        ("a", "Gun", 10.0, 3, "Unknown"), ("a", "Gun", 30.0, 5, "Unknown"), ("b", "Axe", None, 7, "Unknown"),
    ]
    assert out.filter("weapon_name_imputed").count() == 2
    assert out.filter("population_imputed").count() == 3


def test_mode_of_an_empty_column(spark):
    df = spark.createDataFrame([("a", None)], "state string, weapon_name string")
    assert cleaning.impute(df).first()["weapon_name"] == "Unknown_weapon_name"


def test_standard_forms(spark, rows):
    values = [("185", "20", "01-APR-20", 2020), (None, "x", "junk", 2020), ("25-34", "-1", "2021-01-02", 2021)]
    df = spark.createDataFrame(values, "victim_age_group string, offender_age string, incident_date string, year int")
    out, metrics = cleaning.standardise(df)
    assert [(r.victim_age_group, r.offender_age, str(r.incident_date), r.incident_date_text) for r in out.orderBy("year").collect()] == [
        (-1, -1, "None", "junk"), (29, -1, "2021-01-02", "2021-01-02"),
    ]
    assert metrics.first().asDict() == {
        "rows_in": 3, "victim_age_group_converted": 2, "offender_age_converted": 3, "rows_dropped": 1, "dates_fixed": 2,
    }


def test_age_185_leaves_and_missing_stays(spark):
    from caseload.operators import drop_invalid_age

    df = spark.createDataFrame([(185,), (None,), (30,)], "victim_age_group int")
    assert sorted(r[0] or 0 for r in drop_invalid_age(df).collect()) == [0, 30]


def test_rules(spark, rows):
    values = [(-1, 0.0, 2020, 5), (None, -2.0, 1999, 24), (185, 10.0, None, None), (-3, 5.0, 2025, 0)]
    df = spark.createDataFrame(values, "victim_age_group int, population double, year int, incident_hour int")
    df = df.withColumn("offender_age", F.col("victim_age_group"))
    found = {r["rule"]: r["n"] for r in profile.rule_report(df, profile.default_rules()).collect()}
    assert found["victim_age_group: unknown"] == 1 and found["victim_age_group: valid"] == 2
    assert found["victim_age_group: below 0"] == 1 and found["victim_age_group: impossible"] == 1
    assert found["population: zero"] == 1 and found["population: negative"] == 1
    assert found["year: out of range"] == 2 and found["incident_hour: out of range"] == 1
    bad = profile.offending_values(df, {"year": (2020, 2024), "incident_hour": (0, 23)})
    assert rows(bad) == [("incident_hour", 24.0, 1), ("year", 1999.0, 1), ("year", 2025.0, 1)]


def test_profile_sections(spark):
    values = [("TX", "Gun", "a", 1, 2020), ("TX", "", None, 2, 2021), ("NY", None, "b", 900, 2021)]
    df = spark.createDataFrame(values, "state string, weapon_name string, county string, population int, year int")
    for c in ("victim_type", "victim_age_group", "offense_category", "victim_sex", "victim_race"):
        df = df.withColumn(c, F.lit("Individual" if c == "victim_type" else None).cast("string"))
    df = df.withColumn("incident_date", F.to_date(F.lit("2020-01-31")))
    report = profile.profile(df)
    missing = {r["column"]: r["missing"] for r in report["missing"].collect()}
    assert missing["weapon_name"] == 2 and missing["county"] == 1 and missing["population"] == 0
    checks = {r["check"]: r["rows"] for r in report["sanity"].collect()}
    assert checks == {"individual_without_age": 3, "homicide_without_weapon": 0}
    assert {r["column"] for r in report["correlations"].selectExpr("a as column").collect()} == {"population"}
    approx = {r["column"]: r["distinct"] for r in report["cardinality"].collect()}
    exact = {r["column"]: r["distinct"] for r in profile.cardinality_report(df, exact=True).collect()}
    assert approx["state"] == exact["state"] == 2
    for name, section in report.items():
        assert section.count() >= 1, name


def test_no_spread_means_no_outliers(spark):
    df = spark.createDataFrame([(5, float(i)) for i in range(20)] + [(5, 1e6)], "flat int, x double")
    found = {r["column"]: r["outliers"] for r in profile.zscore_outliers(df).collect()}
    assert found == {"flat": 0, "x": 1}
