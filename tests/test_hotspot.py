from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseload.plans import hotspot


@pytest.fixture(scope="module")
def incidents(spark):
    rng = np.random.default_rng(11)
    values = []
    for county in range(12):
        for month in range(36):
            day = dt.date(2020 + month // 12, month % 12 + 1, 3)
            n = int(rng.poisson(1 + 2 * county + (3 if month % 12 in (5, 6, 7) else 0)))
            values += [("S" + str(county % 3), f"C{county:02d}", float(1000 + county), day)] * n
    return spark.createDataFrame(values, "state string, county string, population double, incident_date date")


def test_monthly_population_and_null_keys(spark, rows):
    day = dt.date(2020, 1, 1)
    values = [("s", "c", None, day), ("s", "c", 5.0, day), ("s", "d", None, day), (None, "c", 1.0, day)]
    df = spark.createDataFrame(values, "state string, county string, population double, incident_date date")
    assert rows(hotspot.county_month(df), "county", "crime_count", "population") == [("c", 2, 5.0), ("d", 1, 0.0)]
    assert hotspot.county_month(df, drop_null_keys=False).count() == 3
    assert hotspot.county_month(df, by_population=True).count() == 3


@pytest.mark.parametrize("exact", [True, False])
def test_labels(incidents, exact):
    monthly = hotspot.county_month(incidents)
    counts = np.array([r[0] for r in monthly.select("crime_count").collect()])
    limit = np.quantile(counts, 0.9, method="linear" if exact else "inverted_cdf")
    labelled = hotspot.hotspot_label(monthly, exact=exact)
    assert labelled.agg(F.sum("is_hotspot")).first()[0] == int((counts >= limit).sum())
    for r in hotspot.hotspot_by_county(monthly, exact=exact).collect():
        assert r["is_hotspot"] == int(r["crime_count"] > r["threshold"])


def test_two_encodings(incidents):
    monthly = hotspot.county_month(incidents)
    text = {r["county"]: r["county_idx"] for r in hotspot.features(monthly).collect()}
    assert text == {f"C{i:02d}": i for i in range(12)}
    by_frequency = hotspot.features(monthly, encoding="frequency")
    assert by_frequency.select("county_idx").distinct().count() == 12
    assert hotspot.max_bins(by_frequency, 2) >= 12


def test_forest(incidents):
    run = hotspot.run_hotspot(incidents)
    assert run.predictions.columns == list(hotspot.PREDICTION_COLUMNS)
    rows = run.predictions.collect()
    assert {r["year"] for r in rows} == {2022}
    assert all(0 <= r["hotspot_probability"] <= 1 for r in rows)
    truth, guess = np.array([[r["is_hotspot"], r["prediction"]] for r in rows]).T
    hits = ((truth == 1) & (guess == 1)).sum()
    precision, recall = hits / (guess == 1).sum(), hits / (truth == 1).sum()
    assert run.metrics.accuracy == pytest.approx((truth == guess).mean())
    assert run.metrics.precision == pytest.approx(precision)
    assert run.metrics.recall == pytest.approx(recall)
    assert run.metrics.f1 == pytest.approx(2 * precision * recall / (precision + recall))
    scores = np.array([r["hotspot_probability"] for r in rows])
    pos, neg = scores[truth == 1], scores[truth == 0]
    auc = ((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg)).mean()
    assert run.metrics.auc == pytest.approx(auc, abs=0.02)
    assert run.model.getNumTrees == 50


def test_boosting(incidents):
    run = hotspot.run_hotspot(incidents, "boosting", params={"stepSize": 0.3, "maxDepth": 3, "maxIter": 5, "seed": 42})
    assert run.metrics.accuracy > 0.8
    with pytest.raises(ValueError):
        hotspot.run_hotspot(incidents, "other")


def test_scoring_fills_missing_inputs(incidents):
    monthly = hotspot.hotspot_label(hotspot.county_month(incidents))
    data = hotspot.features(monthly)
    train, test = hotspot.time_split(data)
    model = hotspot.train_rf(hotspot.assemble(train), params={"numTrees": 3, "maxDepth": 2, "seed": 1})
    gaps = test.withColumn("crime_last_month", F.lit(None).cast("long")).withColumn("county_idx", F.lit(None).cast("int"))
    scored = hotspot.score(model, gaps)
    assert scored.count() == test.count()
    assert hotspot.score(model, scored.drop("features")).count() == test.count()


def test_one_class_scores_zero(incidents):
    monthly = hotspot.hotspot_label(hotspot.county_month(incidents))
    train, test = hotspot.time_split(hotspot.assemble(hotspot.features(monthly)))
    model = hotspot.train_rf(train, params={"numTrees": 3, "maxDepth": 2, "seed": 1})
    metrics = hotspot.evaluate(hotspot.score(model, test.withColumn("is_hotspot", F.lit(0))))
    assert (metrics.auc, metrics.f1) == (0.0, 0.0)


def test_measures_of_one_class(spark):
    rows = [(1, 1.0, 0.2), (1, 0.0, 0.7), (1, 1.0, 0.9), (1, 0.0, 0.4)]
    scored = spark.createDataFrame(rows, "is_hotspot int, prediction double, score double")
    kept = hotspot.evaluate(scored, "score")
    assert (kept.auc, kept.f1, kept.precision, kept.recall) == (0.0, 0.0, 1.0, 0.5)
    found = hotspot.evaluate(scored, "score", one_class="undefined")
    assert found.auc != found.auc and (round(found.f1, 9), found.accuracy, found.precision, found.recall) == (0.666666667, 0.5, 1.0, 0.5)
    none = hotspot.evaluate(scored.withColumn("is_hotspot", F.lit(0)), "score", one_class="undefined")
    assert (none.f1, none.accuracy, none.precision) == (0.0, 0.5, 0.0) and none.recall != none.recall
