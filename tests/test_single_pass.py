"""Fills from one pass, observed counters, exact ranks, and patience."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from caseload.catalogue.bindings import incidents
from caseload.operators.quantiles import quantile_of_counts
from caseload.plans import cleaning, hotspot, profile

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("t") / "inc")
    incidents(spark, SF).drop("population").withColumnRenamed("population_gaps", "population").write.parquet(path)
    return spark.read.parquet(path)


# -- fills ------------------------------------------------------------------------------------


def test_fills_scan_the_rows_once(spark, stored, monkeypatch):
    plans = []
    keep = cleaning.settle

    def watched(df, label="settled"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, label)

    monkeypatch.setattr(cleaning, "settle", watched)
    fills = cleaning.learn_fills(stored)
    assert len(plans) == 1 and plans[0].count("FileScan") == 1 and "Expand" in plans[0] and "partial_count" in plans[0]
    assert re.search(r"ReadSchema: struct<\w+:\w+,\w+:\w+,\w+:\w+,\w+:\w+>", plans[0])  # the columns of the statistics alone
    for frame in [*fills.single.values(), *[f for _, f in fills.grouped.values()]]:
        assert "FileScan" in frame._jdf.queryExecution().executedPlan().toString()
        assert stored.inputFiles()[0].rsplit("/", 1)[0] not in frame._jdf.queryExecution().executedPlan().toString()


def test_fills_equal_those_of_plain_python(spark):
    rng = random.Random(3)
    data = [
        (rng.choice(["a", "b", None]), rng.choice([None, *range(9)]), rng.choice(["x", "y", None, "z"]), rng.choice([None, *range(0, 400, 7)]), None)
        for _ in range(500)
    ] + [(None, None, "empty", None, None)] * 3
    df = spark.createDataFrame(data, "weapon_name string, incident_hour int, state string, population long, victim_race string")
    got = cleaning.apply_fills(df, cleaning.learn_fills(df), flag=True)
    median = lambda v: int((sorted(v)[(len(v) - 1) // 2] + sorted(v)[len(v) // 2]) / 2)
    weapons = [r[0] for r in data if r[0]]
    mode = min(set(weapons), key=lambda w: (-weapons.count(w), w))
    hour = median([r[1] for r in data if r[1] is not None])
    people = {s: [r[3] for r in data if r[2] == s and r[3] is not None] for s in {r[2] for r in data}}
    people = {s: median(v) if v else None for s, v in people.items()}
    want = [
        (w or mode, hour if h is None else h, s, people[s] if p is None else p, "Unknown", w is None, h is None, p is None, True)
        for w, h, s, p, _ in data
    ]
    names = ["weapon_name", "incident_hour", "state", "population", "victim_race", *[f"{c}_imputed" for c in ("weapon_name", "incident_hour", "population", "victim_race")]]
    key = lambda t: [(x is not None, str(x)) for x in t]
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=key) == sorted(want, key=key)


def test_fills_of_columns_without_values(spark):
    df = spark.createDataFrame([(None, None, "s", None)] * 2, "weapon_name string, incident_hour int, state string, population long")
    got = cleaning.impute(df, exact=True).collect()
    assert {tuple(r) for r in got} == {("Unknown_weapon_name", None, "s", None)}
    assert cleaning.impute(df.limit(0), exact=True).collect() == []
    assert cleaning.learn_fills(df.select("state"), mode_columns=(), median_columns=(), group_median_of={}).single == {}


def test_sliced_quantile_of_counts(spark):
    rows = [(g, float(v), 1 + (v * g) % 5) for g in (1, 2) for v in range(200)]
    freq = spark.createDataFrame(rows, "g int, value double, freq long")
    direct = {tuple(r) for r in quantile_of_counts(freq, 0.3, ["g"]).collect()}
    assert {tuple(r) for r in quantile_of_counts(freq, 0.3, ["g"], direct_limit=20).collect()} == direct


# -- observed counters ------------------------------------------------------------------------


def test_observed_counters_equal_counted_ones(spark, stored, tmp_path):
    plain, counters = cleaning.standardise(stored, short_year=1998)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("observed", "observed")
    frame, seen = cleaning.standardise_observed(stored, short_year=1998, path=str(tmp_path / "out"))
    jobs = tracker.getJobIdsForGroup("observed")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1 and len(tracker.getJobInfo(jobs[0]).stageIds) == 1  # one scan, no shuffle
    assert seen == counters.first().asDict()
    order = sorted(plain.columns)
    assert frame.select(*order).exceptAll(plain.select(*order)).isEmpty() and plain.select(*order).exceptAll(frame.select(*order)).isEmpty()


def test_observed_without_ages_or_dates(spark):
    df = spark.createDataFrame([("185", 1), (None, 2), ("185 Years Old", 3)], "victim_age_group string, n int")
    frame, seen = cleaning.standardise_observed(df)
    assert [tuple(r) for r in frame.orderBy("n").collect()] == [(-1, 2)]
    assert seen == {"rows_in": 3, "victim_age_group_converted": 2, "rows_dropped": 2}


# -- exact area -------------------------------------------------------------------------------


def pairwise(data):
    good, bad = [s for s, y in data if y == 1], [s for s, y in data if y == 0]
    return sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad)) if good and bad else None


@pytest.mark.parametrize("distinct", [1, 3, 40, 10_000])
def test_area_equals_all_pairs(spark, distinct):
    rng = random.Random(distinct)
    data = [(rng.randrange(distinct) / 7, int(rng.random() < 0.4)) for _ in range(700)]
    df = spark.createDataFrame(data, "score double, is_hotspot int").repartition(5)
    for ranges in (1, 2, 17):
        got = hotspot.exact_auc(df, ranges=ranges).first()
        assert got.positives == sum(y for _, y in data) and got.negatives == 700 - got.positives
        assert math.isclose(got.auc, pairwise(data), rel_tol=1e-12)


def test_area_of_odd_input(spark):
    make = lambda data: hotspot.exact_auc(spark.createDataFrame(data, "score double, is_hotspot int")).first()
    assert tuple(make([])) == (0, 0, None) and tuple(make([(0.5, 1)])) == (1, 0, None)
    assert tuple(make([(0.5, 1), (0.1, 0), (None, 0), (0.9, None)])) == (1, 1, 1.0)
    assert tuple(make([(0.0, 1), (-0.0, 0), (float("inf"), 1)])) == (2, 1, 0.75)


def test_area_beyond_the_bins_of_the_evaluator(spark):
    """50,000 different scores: exact, where bins of scores are not."""
    df = spark.range(50_000).select(((F.col("id") * 7919) % 50_000 / 50_000).alias("score"), ((F.col("id") * 31) % 97 < 40).cast("int").alias("is_hotspot"))
    data = sorted((r.score, r.is_hotspot) for r in df.collect())
    below, halves = 0, 0
    for _, y in data:
        halves, below = (halves + below, below) if y else (halves, below + 1)
    good = sum(y for _, y in data)
    assert math.isclose(hotspot.exact_auc(df).first().auc, halves / good / (50_000 - good), rel_tol=1e-13)


# -- patience ---------------------------------------------------------------------------------


def patient(losses, patience):
    best = None
    for n, x in enumerate(losses, 1):
        if math.isnan(x):
            continue
        if best is None or x < losses[best - 1]:
            best = n
        if n - best >= patience:
            return best, losses[best - 1], n
    last = max(n for n, x in enumerate(losses, 1) if not math.isnan(x))
    return best, losses[best - 1], last


@pytest.mark.parametrize("losses", [
    [5, 4, 3, 2, 1], [1, 2, 3, 4, 5], [3, 3, 3, 3], [5, 1, 2, 2, 0.5, 9, 9, 9, 0.1], [2.0], [5, float("nan"), 4, 6, 7, 1], [2, 2, 1, 1, 1, 1, 0],
])
@pytest.mark.parametrize("patience", [1, 3, 20])
def test_chosen_round(spark, losses, patience):
    df = spark.createDataFrame([(n, float(x)) for n, x in enumerate(losses, 1)], "round int, loss double")
    assert tuple(hotspot.chosen_round(df, patience).first()) == patient(list(map(float, losses)), patience)


def test_boosting_stops_and_is_cut(spark):
    """Noise labels: the validation loss rises soon; the cut model is the prefix of the long one."""
    df = spark.range(400).select(
        ((F.col("id") * 37 % 101) / 101).alias("a"), ((F.col("id") * 53 % 89) / 89).alias("b"), ((F.col("id") * 71 % 13) % 2).cast("int").alias("is_hotspot"),
    )
    data = hotspot.assemble(df, ["a", "b"]).repartition(1).cache()
    train, valid = data.filter("a < 0.7"), data.filter("a >= 0.7")
    params = {"stepSize": 0.5, "maxDepth": 4, "maxIter": 60, "seed": 1}
    found = hotspot.train_gbt_patiently(train, valid, params=params, patience=3)
    losses = [r.loss for r in found.losses.orderBy("round").collect()]
    assert (found.best_round, losses[found.best_round - 1], found.last_round) == patient(losses, 3)
    assert found.model.getNumTrees == found.best_round < 60 and len(losses) < 60
    scored = hotspot.score(found.model, valid).select("hotspot_probability", "prediction", "features")
    assert scored.count() == valid.count()
    margin = found.model.evaluateEachIteration(valid)
    assert math.isclose(margin[-1], losses[found.best_round - 1], rel_tol=1e-9)
    data.unpersist()


def test_unknown_stopping_rule(spark):
    with pytest.raises(ValueError, match="stopping rule"):
        hotspot.run_hotspot(incidents(spark, SF, "state", "county", "population", "incident_date"), "boosting", stop="never")


# -- first values by candidates ---------------------------------------------------------------


@pytest.mark.parametrize("tracked", [100, 10_000])
def test_candidates_give_the_rows_of_the_full_count(spark, tracked):
    """Frequent, tied, null, single and absent values; proven or counted whole."""
    rng = random.Random(9)
    data = [
        (rng.choice(["a", "b", None]), f"v{int(rng.paretovariate(0.6))}", f"id{i}", None, rng.choice("xyz") if i % 10 else f"tail{i}") for i in range(4000)
    ]
    df = spark.createDataFrame(data, "few string, heavy string, single string, nothing string, tail string").repartition(4)
    top, how = profile.top_values_by_candidates(df, n=3, tracked=tracked)
    want = {tuple(r) for r in profile.top_values(df, n=3).collect()}
    assert {tuple(r) for r in top.select("column", "value", "count", "rank").collect()} == {(c, v, n, r) for c, v, n, r in want}
    methods = {r["column"]: r["method"] for r in how.collect()}
    assert methods["few"] == methods["nothing"] == methods["tail"] == profile.CANDIDATES
    assert methods["single"] == (profile.ALL_VALUES if tracked < 4000 else methods["single"])


def test_candidates_of_an_empty_table(spark):
    top, how = profile.top_values_by_candidates(spark.createDataFrame([], "a string, b string"))
    assert top.collect() == [] and {r["method"] for r in how.collect()} == {profile.CANDIDATES}


def test_candidates_are_counted_in_incidents_joined_once(spark, monkeypatch):
    from caseload.catalogue import QUERIES

    seen = []
    keep = profile.top_values_by_candidates
    monkeypatch.setattr(profile, "top_values_by_candidates", lambda df, *a, **k: seen.append(df) or keep(df, *a, **k))
    assert QUERIES["top_values_candidates"](spark, SF).count() > 0
    assert "Join" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
