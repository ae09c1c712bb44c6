"""Partitions replaced, marts from partial counts, ambiguous names, bad rows, crosstabs of any width."""

from __future__ import annotations

import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from caseload import operators as op
from caseload.catalogue import upkeep
from caseload.catalogue.bindings import fips, incidents
from caseload.catalogue.upkeep import _MART_ROWS
from caseload.plans import marts, sketches
from caseload.sources import bad_row_count, read_raw, read_raw_set, replace_partitions

SF = "/root/testdata/sf0.001"


def test_replaced_partition_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "n int, state string, year int")
    replace_partitions(make([(1, "a", 1), (2, "a", 2), (3, None, 1)]), path)
    files = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    time.sleep(0.05)
    replace_partitions(make([(7, "a", 2), (8, "a", 2), (9, "b", 1)]), path)
    rows = spark.read.schema("n int, state string, year int").parquet(path)
    assert sorted(tuple(r) for r in rows.fillna("-").collect()) == [(1, "a", 1), (3, "-", 1), (7, "a", 2), (8, "a", 2), (9, "b", 1)]
    now = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    kept = {f: t for f, t in files.items() if "year=2" not in f}
    assert len(kept) == 2 and kept.items() <= now.items() and not {f for f in files if "year=2" in f} & set(now)


@pytest.fixture(scope="module")
def inc(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("t") / "inc")
    incidents(spark, SF, *_MART_ROWS).write.parquet(path)
    return spark.read.parquet(path)


def test_every_mart_from_partials(spark, inc):
    partials = spark.createDataFrame(marts.partial_counts(inc).collect(), marts.partial_counts(inc).schema)
    ours, theirs = marts.marts_from_partials(partials, fips(spark, SF)), marts.build_marts(inc, fips(spark, SF))
    assert set(ours) == set(theirs)
    for name, mart in theirs.items():
        columns = mart.columns
        rows = lambda df: sorted(map(str, map(tuple, df.select(*columns).collect())))
        assert rows(ours[name]) == rows(mart), name


def test_partials_scan_once_and_carry_counts(inc):
    plan = marts.partial_counts(inc)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan


def test_partials_without_populations_or_rows(spark, inc):
    partials = marts.partial_counts(inc.drop("population"))
    built = marts.marts_from_partials(partials)
    assert "state_crime_rates" not in built and built["yearly_trends"].count() > 0
    assert marts.marts_from_partials(marts.partial_counts(inc.limit(0)))["yearly_trends"].collect() == []


def test_ambiguous_names(spark):
    codes = spark.createDataFrame(
        [("51059", "Fairfax County", "Virginia"), ("51600", "Fairfax Parish", "Virginia"), ("1001", "King County", "Virginia"), ("01001", "King", "Virginia")],
        "fips string, county_name string, state_name string",
    )
    rows = spark.createDataFrame([("VIRGINIA", "FAIRFAX", 1), ("VIRGINIA", "KING", 2)], "state string, county string, n int")
    said = lambda **k: sorted((r.n, r.fips) for r in op.attach_fips(rows, codes, **k).collect())
    assert said() == [(2, "01001")] and said(ambiguous="first") == [(1, "51059"), (2, "01001")]
    assert said(ambiguous="all") == [(1, "51059"), (1, "51600"), (2, "01001")]
    kept = op.attach_fips(rows, codes, keep_unmatched=True).collect()
    assert sorted((r.n, r.fips) for r in kept) == [(1, None), (2, "01001")]
    assert [(r.county, r.codes) for r in op.ambiguous_fips(codes).collect()] == [("FAIRFAX", ["51059", "51600"])]
    with pytest.raises(ValueError):
        op.attach_fips(rows, codes, ambiguous="maybe")


def test_bad_rows_of_a_raw_table(spark, tmp_path):
    file = tmp_path / "NIBRS_incident.csv"
    file.write_text('INCIDENT_ID,AGENCY_ID,INCIDENT_DATE,INCIDENT_HOUR\n1,2,2020-01-01,5\n2,3\n3,4,2020-01-02,6,7\n4,5,"a, ""b""",\n', encoding="latin-1")
    read = lambda policy: read_raw(spark, str(file), "incident", bad_rows=policy)
    assert sorted(r.incident_id for r in read("keep").collect()) == [1, 2, 3, 4]
    assert sorted((r.incident_id, r.incident_date) for r in read("drop").collect()) == [(1, "2020-01-01"), (4, 'a, "b"')]
    assert read("drop").columns == read("keep").columns
    marked = read("mark")
    assert tuple(bad_row_count(marked).first()) == (4, 2)
    assert sorted(r["_bad_row"] for r in marked.filter("_bad_row is not null").collect()) == ["2,3", "3,4,2020-01-02,6,7"]
    with pytest.raises(PySparkException, match="bad row in"):
        read("fail").collect()
    with pytest.raises(ValueError):
        read("ignore")
    only = read_raw_set(spark, str(tmp_path), {"incident": "NIBRS_incident.csv"}, bad_rows="drop")
    assert only["incident"].count() == 2


def test_crosstab_of_twenty_thousand_columns(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("row"), F.concat(F.lit("c"), F.col("id") % 20_000).alias("col"))
    spark.sparkContext.setJobGroup("wide", "wide")
    table = op.crosstab_map(df, "row", "col")
    started = spark.sparkContext.statusTracker().getJobIdsForGroup("wide")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(started) == 0
    got = {r.row: r for r in table.select("row", F.size("counts").alias("n"), "total", F.col("counts")["c7"].alias("c7")).collect()}
    assert {k: (r.n, r.total) for k, r in got.items()} == {k: (20_000, 20_000) for k in range(3)} and got[0].c7 == 1


def test_crosstab_map_of_nulls(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "x"), (None, "y"), ("b", None)], "row string, col string")
    assert {(r.row, tuple(r.counts.items()), r.total) for r in op.crosstab_map(df, "row", "col").collect()} == {
        ("a", (("x", 1),), 1), (None, (("x", 1), ("y", 1)), 2),
    }


def test_sketches_of_odd_columns(spark):
    df = spark.createDataFrame([("s", 1, "a", 1.0), ("s", 1, "b", None), ("s", 2, "a", 5.0), ("t", 1, None, None)], "state string, year int, c string, v double")
    stored = sketches.stored_sketches(df, ["c"], ["v"])
    assert stored.count() == 6
    assert {(r.state, r.distinct) for r in sketches.distinct_counts(stored, ["state"]).collect()} == {("s", 2), ("t", 0)}
    assert {(r.state, r.quantile) for r in sketches.quantiles(stored, 1.0, ["state"]).collect()} == {("s", 5.0)}
    assert [r.distinct for r in sketches.distinct_counts(stored).collect()] == [2]


def _of_tables(df):
    return [f for f in df.inputFiles() if f"{SF}/lineitem" in f]


@pytest.mark.parametrize("run", [lambda spark: upkeep._kept_up(spark, SF), lambda spark: upkeep.state_year_replaced(spark, SF)])
def test_partitions_come_from_one_copy(spark, monkeypatch, run):
    written = []
    for name in ("write_cleaned", "replace_partitions"):
        def spy(df, *more, _write=getattr(upkeep, name)):
            written.append(_of_tables(df))
            return _write(df, *more)
        monkeypatch.setattr(upkeep, name, spy)
    run(spark)
    assert written == [[], [], []]


def test_sketches_come_from_one_copy(spark):
    assert not _of_tables(upkeep.sketches_merged(spark, SF))


def test_lines_are_shuffled_once_to_their_orders(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = incidents(spark, SF, "state", "county")._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    at = next(n for n, line in enumerate(plan) if "FileScan" in line and "l_orderkey" in line)
    depth, above = 10_000, 0
    for line in reversed(plan[: at + 1]):
        now = len(line) - len(line.lstrip(" :+-"))
        if now < depth:
            depth, above = now, above + ("Exchange" in line)
    assert above == 1
