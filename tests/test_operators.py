from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseload import operators as op
from caseload.operators.joins import join_unique
from caseload.vocabulary import WEEKDAYS


def test_ties_go_to_the_smaller_name(spark, rows):
    df = spark.createDataFrame([("x", "b"), ("x", "a"), ("y", "c")], "g string, v string")
    counts = op.count_by(df, "g", "v")
    assert rows(op.top_per_group(counts, ["g"], "count", 1, ["v"]), "g", "v") == [("x", "a"), ("y", "c")]
    assert op.mode_of(df, "v").first()["value"] == "a"
    assert op.row_of_max(op.count_by(df, "v"), "count", ["v"]).first()["v"] == "a"
    assert [r["v"] for r in op.top_n(op.count_by(df, "v"), "count", 2, ["v"]).collect()] == ["a", "b"]


def test_mode_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v string")
    assert op.mode_of(df, "v").count() == 0
    assert tuple(op.mode_of(df, "v", "Unknown_v").first()) == ("Unknown_v", 0)


def test_null_keys(spark, rows):
    df = spark.createDataFrame([("a",), (None,), (None,)], "k string")
    assert rows(op.count_by(df, "k")) == [(None, 2), ("a", 1)]
    assert rows(op.count_by(df, "k", drop_null_keys=True)) == [("a", 1)]
    assert rows(op.filter_not_in(df, "k", ["b"])) == [("a",)]


def test_shares(spark, rows):
    df = spark.createDataFrame([("a", "x")] * 3 + [("a", "y")] + [("b", "x")], "g string, v string")
    assert rows(op.share_of_group(df, ["v"], ["g"])) == [
        ("a", "x", 3, 4, 75.0), ("a", "y", 1, 4, 25.0), ("b", "x", 1, 1, 100.0),
    ]
    assert rows(op.share_of_total(df, "g")) == [("a", 4, 80.0), ("b", 1, 20.0)]
    found = op.subset_rate(df, ["g"], F.col("v") == "y")
    assert rows(found) == [("a", 4, 1, 25.0), ("b", 1, 0, 0.0)]
    assert rows(op.subset_rate(df, ["g"], F.col("v") == "y", drop_zero=True), "g") == [("a",)]


def test_pivots(spark, rows):
    df = spark.createDataFrame([("a", "M"), ("a", "M"), ("a", "F"), ("b", "U")], "c string, s string")
    shares = op.pivot_share(df, "c", "s", ["M", "F"])
    assert shares.columns == ["c", "M", "F", "total", "M_percent", "F_percent"]
    assert rows(shares, "c", "M", "F", "total") == [("a", 2, 1, 3)]
    assert rows(op.crosstab(df, "c", "s"), "c", "F", "M", "U") == [("a", 1, 2, 0), ("b", 0, 0, 1)]


def test_lag_over_a_gap(spark, rows):
    df = spark.createDataFrame([("s", "c", 2020, m, n) for m, n in ((1, 5), (2, 7), (5, 9))],
                               "state string, county string, year int, month int, crime_count long")
    assert rows(op.lag_month(df), "month", "crime_last_month") == [(1, 0), (2, 5), (5, 7)]
    assert rows(op.lag_month(df, gaps="calendar"), "month", "crime_last_month") == [(1, 0), (2, 5), (5, 0)]


def test_change_over_years(spark, rows):
    df = spark.createDataFrame([(2020, 10), (2021, 15), (2022, 0), (2023, 3)], "year int, count long")
    assert rows(op.yoy(df)) == [
        (2020, 10, None, None, None), (2021, 15, 10, 5, 50.0), (2022, 0, 15, -15, -100.0), (2023, 3, 0, 3, None),
    ]


def test_weekdays_start_on_monday(spark):
    df = spark.createDataFrame([(d,) for d in sorted(WEEKDAYS)], "DayOfWeek string")
    assert tuple(r[0] for r in op.sort_weekday(df).collect()) == WEEKDAYS


def test_rate_falls_back_to_counts(spark, rows):
    df = spark.createDataFrame([("a", "u", 100, 1), ("a", "u", 200, 1), ("a", "w", 300, 1)],
                               "state string, unit string, population long, x int")
    assert rows(op.rate_per_100k(df, unit="unit")) == [("a", 3, 500, 600.0)]
    assert rows(op.rate_per_100k(df.drop("population"), unit="unit")) == [("a", 3, 3.0)]


def test_label_codes_are_dense_and_ordered(spark):
    labels = [f"L{i:04d}" for i in range(500)]
    shuffled = labels * 2 + [None]
    random.Random(1).shuffle(shuffled)
    df = spark.createDataFrame([(x,) for x in shuffled], "l string").repartition(7)
    codes = {r["l"]: r["l_idx"] for r in op.label_code(df, "l").collect()}
    assert codes == {x: i for i, x in enumerate(labels)}


@pytest.mark.parametrize("direct", [0, 10**9])
@pytest.mark.parametrize("p", [0.0, 0.5, 0.9, 1.0])
def test_exact_quantile(spark, direct, p):
    rng = np.random.default_rng(3)
    data = {"a": rng.exponential(10, 700).round(1), "b": np.full(40, 4.0), "c": rng.normal(0, 1, 301)}
    df = spark.createDataFrame([(g, float(v)) for g, vs in data.items() for v in vs] + [("a", None)], "g string, v double")
    got = {r["g"]: r["quantile"] for r in op.exact_quantile(df, "v", p, ["g"], direct, 8).collect()}
    for g, vs in data.items():
        assert got[g] == pytest.approx(np.quantile(vs, p))
    total = op.exact_quantile(df, "v", p, (), direct, 8).first()["quantile"]
    assert total == pytest.approx(np.quantile(np.concatenate(list(data.values())), p))


def test_approx_quantile_is_close(spark):
    df = spark.range(10_001).selectExpr("cast(id as double) as v", "id % 3 as g")
    assert abs(op.approx_quantile(df, "v", 0.9).first()[0] - 9000) <= 2
    medians = {r["g"]: r["median"] for r in op.group_median(df, ["g"], "v").collect()}
    assert all(abs(m - 5000) <= 4 for m in medians.values())


def brute_left_join(left, right):
    out = []
    for k, a in left:
        hits = [b for key, b in right if k is not None and key == k]
        out += [(k, a, b) for b in hits] or [(k, a, None)]
    return Counter(out)


@pytest.mark.parametrize("max_rows", [0, 1000])
@pytest.mark.parametrize("sparse", [False, True])
def test_join_with_a_hot_key(spark, max_rows, sparse):
    left = [(i, f"l{i}") for i in range(60)] + [(7, "again"), (None, "n1"), (None, "n2"), (999, "none")]
    right = [(7, f"r{i}") for i in range(200)] + [(7, "copy")] * 100 + [(i, f"q{i}") for i in range(50)] + [(None, "x")]
    ldf = spark.createDataFrame(left, "k long, a string")
    rdf = spark.createDataFrame(right, "k long, b string").repartition(3)
    assert len(op.hot_keys(rdf, ["k"], 0.2)) == 1
    joined = op.join_facts(ldf, rdf, ["k"], share=0.2, max_rows=max_rows, sparse=sparse)
    assert Counter(tuple(r) for r in joined.select("k", "a", "b").collect()) == brute_left_join(left, right)
    probed = op.join_facts(ldf, rdf, ["k"], share=0.2, max_rows=max_rows, sparse=sparse, probe=(rdf, ["k"]))
    assert Counter(tuple(r) for r in probed.select("k", "a", "b").collect()) == brute_left_join(left, right)


def test_null_keys_are_spread(spark):
    left = spark.range(0, 4000, 1, 4).selectExpr("cast(null as long) as k", "id as a")
    right = spark.range(10).selectExpr("id as k", "id as b")
    joined = op.join_facts(left, right.hint("merge"), ["k"], sparse=True)
    sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    assert joined.count() == 4000 and len(sizes) > 1
    assert max(r["count"] for r in sizes) < 2000


def test_attach_beyond_the_row_limit(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    side = spark.createDataFrame([("a", 10), ("c", 30)], "k string, w int")
    assert rows(op.attach(df, side, ["k"]), "v", "w") == rows(op.attach(df, side, ["k"], max_rows=1), "v", "w")


def test_first_per_key_and_unique_join(spark, rows):
    right = spark.createDataFrame([(1, 9), (1, 3), (2, 5), (None, 1)], "k long, w long")
    left = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k long")
    assert rows(op.join_first(left, right, "k", ["w"], ["w"])) == [(None, None), (1, 3), (1, 3), (3, None)]
    assert rows(op.first_per_key(right, ["k"], ["w"])) == [(None, 1), (1, 3), (2, 5)]
    unique = op.first_per_key(right.filter("k is not null"), ["k"], ["w"])
    assert rows(join_unique(left, unique, "k"))[-1] == (3, None)


def test_keep_top_groups(spark, rows):
    df = spark.createDataFrame([("a", 5), ("b", 1), ("b", 1), ("c", 2)], "g string, n int")
    assert rows(op.keep_top_groups(df, "g", 1)) == [("b", 1), ("b", 1)]
    assert rows(op.keep_top_groups(df, "g", 2, weight="n")) == [("a", 5), ("b", 1), ("b", 1)]


def test_county_codes(spark, rows):
    fips = spark.createDataFrame(
        [("8001", "Adams County", "Colorado"), ("8005", "Arapahoe County", "Colorado"),
         ("22071", "Orleans Parish", "Louisiana"), ("0", "Nowhere County", "Colorado")],
        "fips string, county_name string, state_name string",
    )
    df = spark.createDataFrame(
        [("CO", "ADAMS"), ("Colorado", "adams county"), ("Louisiana", "Orleans Parish"), ("CO", "NOWHERE"),
         ("CO", "ADAMS, ARAPAHOE; DOUGLAS"), (None, "ADAMS")],
        "state string, county string",
    )
    assert rows(op.attach_fips(df, fips), "county", "fips") == [
        ("ADAMS", "08001"), ("Orleans Parish", "22071"), ("adams county", "08001"),
    ]
    assert op.attach_fips(df, fips, keep_unmatched=True).filter("fips is null").count() == 3
    assert op.attach_fips(df, fips, multi="first").count() == 4
    exploded = rows(op.attach_fips(df, fips, multi="explode"), "county", "fips")
    assert ("Arapahoe", "08005") in exploded and len(exploded) == 5
    assert rows(op.explode_counties(df.filter("county like '%;%'")), "county") == [("Adams",), ("Arapahoe",), ("Douglas",)]


def test_names_and_unions(spark, rows):
    df = spark.createDataFrame([(1, 2)], ["Victim-Offender (Rel.)", " a/b "])
    assert op.sanitize_columns(df).columns == ["Victim_Offender_Rel", "a_b"]
    assert op.project_ordered(df, ["nope", " a/b "]).columns == [" a/b "]
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, i int")
    assert rows(op.union_states([a, b])) == [(1, "x"), (2, "y")]
    assert rows(op.union_states([a, b.drop("s")], allow_missing=True)) == [(1, "x"), (2, None)]
    with pytest.raises(Exception, match="s"):
        op.union_states([a, b.drop("s")])


def test_unknown_rate_counts_fields(spark, rows):
    df = spark.createDataFrame([("a", "Unknown", "Unknown"), ("a", "F", None)], "state string, p string, q string")
    assert rows(op.unknown_rate(df, ["p", "q"])) == [("a", 2, 2, 1.0)]


def test_what_is_too_large_is_not_broadcast(spark):
    from caseload.operators.joins import small

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()

    df = spark.range(100).selectExpr("id", "repeat('x', 1000) as text", "array(1, 2) as a")
    assert hinted(small(df))
    assert not hinted(small(df, max_rows=99))
    assert not hinted(small(df, max_bytes=100_000))
    assert hinted(small(df.filter("id < 0"), max_rows=0))


def test_hot_keys_read_a_table_once(spark, rows):
    from caseload.operators.joins import _key_hashes, hot_keys_of

    df = spark.range(100).selectExpr("if(id < 60, 1, id) as a", "if(id % 2 = 0, null, if(id < 50, 2, id)) as b")
    assert hot_keys_of({"x": (df, ["a"]), "y": (df, ["b"])}, 0.3) == {
        "x": hot_keys_of({"": (df, ["a"])}, 0.3)[""], "y": hot_keys_of({"": (df, ["b"])}, 0.3)[""]}
    both = _key_hashes(df, {"x": ["a"], "y": ["b"]})
    assert both._jdf.queryExecution().executedPlan().toString().count("Range (") == 1
    each = [_key_hashes(df, {n: [c]}) for n, c in (("x", "a"), ("y", "b"))]
    assert rows(both) == rows(each[0].union(each[1]))
