from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caseload import functions as fn
from caseload.functions.nulls import is_missing


def apply(spark, schema, values, *columns):
    df = spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], schema)
    out = [tuple(r) for r in df.select(*columns).collect()]
    return [r[0] for r in out] if len(columns) == 1 else out


def test_parse_age(spark):
    cases = {
        "30 Years Old": 30, "25-34": 29, "Not Specified": -1, None: -1, "Over 98 Years Old": 98,
        "-1": -1, "  7 ": 7, "25-34 years": 29, "between 3 and 9": 3, "": -1, "x-5": 5,
        "99999999999999999999": None,
    }
    got = apply(spark, "a string", list(cases), fn.parse_age("a"))
    assert got == list(cases.values())


def test_parse_age_twice_changes_nothing(spark):
    values = ["30 Years Old", None, "25-34", "junk"]
    once = fn.parse_age("a")
    assert apply(spark, "a string", values, once) == apply(spark, "a string", values, fn.parse_age(once))


def test_age_label(spark):
    got = apply(
        spark, "n string, a string",
        [("Age in Years", "33.0"), ("AGE IN YEARS", None), ("Unknown", "4"), (None, "5")],
        fn.age_label("n", "a"),
    )
    assert got == ["33 years old", "AGE IN YEARS", "Unknown", None]


def test_short_dates_of_one_year(spark):
    values = [("01-APR-20", 2020), ("2020-04-01", 2020), ("junk", 2020), (" 01-APR-21 ", 2021), (None, 2020)]
    got = apply(spark, "d string, y int", values, fn.fix_2020_date("d", "y"))
    assert got == ["2020-04-01", "2020-04-01", "junk", "01-APR-21", None]
    got = apply(spark, "d string, y int", values, fn.parse_date_lenient(fn.fix_2020_date("d", "y")))
    assert got == [dt.date(2020, 4, 1), dt.date(2020, 4, 1), None, None, None]


def test_dates_in_any_form(spark):
    cases = {
        "2020-04-01": dt.date(2020, 4, 1), "1-apr-20": dt.date(2020, 4, 1),
        "01-APR-2020": dt.date(2020, 4, 1), "02/01/2020": dt.date(2020, 1, 2),
        "01/31/2020": dt.date(2020, 1, 31), "31/01/2020": dt.date(2020, 1, 31), "": None,
        "junk": None, None: None, "2020-13-45": None, "45/45/2020": None,
    }
    got = apply(spark, "d string", list(cases), fn.parse_date_any("d"))
    assert got == list(cases.values())


def test_strict_date_stops(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        apply(spark, "d string", ["01-APR-20"], fn.parse_date("d"))


def test_calendar_names(spark):
    got = apply(
        spark, "d date", [dt.date(2024, 2, 29)],
        fn.day_name("d"), fn.month_abbr(F.month("d")), fn.year_of("d"), fn.month_of("d"),
        fn.season(F.month("d")), fn.season(F.lit(None).cast("int")),
    )
    assert got == [("Thursday", "Feb", 2024, 2, "Winter", "Unknown")]


def test_weapon_policies(spark):
    values = [None, "Unknown", "Other", "", "Handgun"]
    got = apply(
        spark, "w string", values, *[fn.weapon_flag("w", p) for p in ("listed", "assumed", "known")]
    )
    assert got == [
        ("Without Weapon", "Yes", False),
        ("Without Weapon", "No", False),
        ("Without Weapon", "No", True),
        ("With Weapon", "Yes", False),
        ("With Weapon", "Yes", True),
    ]
    with pytest.raises(ValueError):
        fn.weapon_flag("w", "other")


def test_age_bands(spark):
    values = [None, -1, 0, 17, 18, 25, 26, 40, 41, 60, 61, 65, -5]
    legacy = apply(spark, "a int", values, fn.offender_age_band("a", "legacy"))
    assert legacy == [
        "60+", "Under 18", "Under 18", "Under 18", "18-25", "18-25", "26-40", "26-40", "41-60",
        "41-60", "60+", "60+", "Under 18",
    ]
    default = apply(spark, "a int", values, fn.offender_age_band("a"))
    assert default[:2] == ["Unknown", "Unknown"] and default[2:] == legacy[2:]
    band = apply(spark, "a int", values, fn.age_band("a", "-"))
    assert band == [
        "Other/Invalid", "Unknown", "0-17 (Minor)", "0-17 (Minor)", "18-24 (Young Adult)", "25-34",
        "25-34", "35-44", "35-44", "55-64", "55-64", "65+ (Senior)", "Other/Invalid",
    ]
    assert apply(spark, "a int", [20], fn.age_band("a")) == ["18–24 (Young Adult)"]


def test_hour_bands(spark):
    values = [None, 0, 5, 6, 23, 24]
    assert apply(spark, "h int", values, fn.hour_band("h", "legacy")) == [
        "18-23 Evening", "00-05 Night", "00-05 Night", "06-11 Morning", "18-23 Evening",
        "18-23 Evening",
    ]
    assert apply(spark, "h int", values, fn.hour_band("h"))[0::5] == ["Unknown", "Unknown"]


def test_themes_and_relationships(spark):
    names = ["School", "School-College/University", "Residence/Home", "Rest Area", "ATM", None, "Other/Unknown"]
    assert apply(spark, "l string", names, fn.location_theme("l")) == [
        "Education", "Education", "Residential", "Public Space/Transport", "Other", "Other", "Unknown",
    ]
    values = ["Victim Was Stranger", "Relationship Unknown", None, "Victim Was Spouse"]
    assert apply(spark, "r string", values, fn.relationship_type("r")) == [
        "Stranger", "Unknown", "Unknown", "Known Relationship",
    ]
    assert apply(spark, "c string", ["Robbery", "Arson", None], fn.severity("c"), fn.crime_type("c")) == [
        ("High Severity", "Violent"), ("Lower Severity", "Non-Violent"), ("Lower Severity", "Non-Violent"),
    ]


def test_keys(spark):
    cases = {"1.0": 1, "10.05": None, None: None, "7": 7, " 8.0 ": 8, "nan": None, "100.0": 100}
    assert apply(spark, "k string", list(cases), fn.coerce_key("k")) == list(cases.values())


def test_keys_by_one_pattern(spark):
    cases = {"+5": 5, "-3.0": -3, "": None, ".0": None, "1.0.0": None, "7.": None, "1e3": None, "9" * 30: None, "12.00": None}
    assert apply(spark, "k string", list(cases), fn.coerce_key("k")) == list(cases.values())
    plan = spark.createDataFrame([("1",)], "k string").select(fn.coerce_key("k"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan


def test_county_names(spark):
    cases = {
        "Orleans Parish": "ORLEANS", "king county": "KING", " Adams ": "ADAMS", None: None,
        "County Line County": "COUNTY LINE",
    }
    assert apply(spark, "c string", list(cases), fn.normalise_county("c")) == list(cases.values())
    assert apply(spark, "c string", ["ADAMS, ARAPAHOE; DOUGLAS"], fn.normalise_county("c", "first")) == ["ADAMS"]
    assert apply(spark, "c string", ["1001", "53033", "123456", None], fn.fips5("c")) == ["01001", "53033", "123456", None]


def test_state_names(spark):
    values = ["NY", "Texas", "Ohio", None]
    assert apply(spark, "s string", values, fn.state_name("s"), fn.state_code("s")) == [
        ("NEW YORK", "NY"), ("TEXAS", "TX"), ("OHIO", None), (None, None),
    ]


def test_rates(spark):
    got = apply(
        spark, "n int, p double", [(5, 0.0), (5, None), (5, -1.0), (5, 1000.0)],
        fn.rate_or_zero("n", "p"), fn.pct("n", "p"),
    )
    assert got == [(0.0, None), (0.0, None), (0.0, -500.0), (5.0, 0.5)]


def test_numbers(spark):
    assert apply(spark, "t string", ["30", "30.0", "30 Years Old", "", None], fn.to_int("t")) == [30, 30, None, None, None]
    assert apply(spark, "t string", ["1e3", "-.5", "x", "1."], fn.as_number("t")) == [1000.0, -0.5, None, 1.0]
    assert [str(v) for v in apply(spark, "p double", [12.345, 99.995], fn.pct_decimal("p"))] == ["12.35", "100.00"]


def test_missing_follows_the_type(spark):
    df = spark.createDataFrame([(None, None, None), ("", float("nan"), 0), ("x", 1.0, 2)], "s string, d double, i int")
    flags = [is_missing(f.name, f.dataType) for f in df.schema]
    assert [tuple(r) for r in df.select(*flags).collect()] == [(True,) * 3, (True, True, False), (False,) * 3]
