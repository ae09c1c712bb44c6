"""The plans are the ones meant: one scan, few shuffles, nothing in Python."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from caseload import operators as op
from caseload.catalogue import QUERIES, bindings
from caseload.catalogue.bindings import incidents
from caseload.plans import cleaning, marts, profile

SF = "/root/testdata/sf0.001"
PACKAGE = Path(__file__).resolve().parent.parent / "caseload"


def executed(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """The incidents as one stored table, as the reports meet them."""
    path = str(tmp_path_factory.mktemp("t") / "inc")
    incidents(spark, SF).withColumnRenamed("population_gaps", "people").write.parquet(path)
    return spark.read.parquet(path)


def test_no_python_in_the_package():
    source = "\n".join(p.read_text() for p in PACKAGE.rglob("*.py"))
    for word in ("toPandas", "pandas_udf", "F.udf", "mapInPandas", "applyInPandas", ".rdd", "localCheckpoint", "crossJoin", "toLocalIterator"):
        assert word not in source, word


def test_reports_run_in_the_jvm(spark):
    for name in ("standardise", "extract_star", "severity_by_age", "heatmap_fips", "hotspot_features"):
        assert not re.search("ArrowEval|BatchEval|MapInPandas", planned(QUERIES[name](spark, SF))), name


def test_share_of_group_shuffles_rows_once(table):
    plan = planned(op.share_of_group(table, ["victim_sex"], ["offense_category"]))
    assert plan.count("FileScan") == 1
    below, above = plan.split("Exchange hashpartitioning")[-1], plan
    assert "partial_count" in below and above.count("Exchange hashpartitioning") == 2
    assert re.search(r"ReadSchema: struct<(offense_category:string,victim_sex:string|victim_sex:string,offense_category:string)>", plan)


def test_share_of_total_scans_once(table):
    plan = executed(op.share_of_total(table, "victim_sex"))
    assert "ReusedExchange" in plan and plan.count("FileScan") <= 1


def test_top_per_group_limits_before_the_shuffle(table):
    counts = op.count_by(table, "state", "weapon_name")
    plan = planned(op.top_per_group(counts, ["state"], "count", 3, ["weapon_name"]))
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in planned(op.top_n(counts, "count", 5))


def test_filters_and_columns_reach_the_scan(table):
    plan = planned(op.count_by(op.violent(table), "state"))
    assert re.search(r"PushedFilters: \[In\(offense_category", plan)
    assert "ReadSchema: struct<offense_category:string,state:string>" in plan or (
        "ReadSchema: struct<state:string,offense_category:string>" in plan
    )


def test_attached_sides_are_broadcast_only_when_small(spark, table):
    side = op.count_by(table, "state", name="n")
    assert "BroadcastHashJoin" in planned(op.attach(table, side, ["state"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in planned(op.attach(table, side, ["state"], max_rows=1))
        assert "BroadcastHashJoin" in planned(op.attach(table, side, ["state"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cleaning_moves_no_row(table):
    for df in (
        cleaning.clean_by_state(table, ["weapon_name"], 10),
        cleaning.impute(table, group_median_of={"people": "state"}),
        cleaning.standardise(table.withColumn("incident_date", F.col("incident_date").cast("string")))[0],
    ):
        main = planned(df).split("Subquery")[0]
        assert "Exchange hashpartitioning" not in main and "SortMergeJoin" not in main


def test_one_scan_per_report(table):
    for df in (
        profile.missing_report(table), profile.describe_numeric(table), profile.top_values(table),
        profile.cardinality_report(table), profile.correlations(table), profile.cardinality_report(table, exact=True),
        profile.rule_report(table, profile.default_rules("victim_age")),
    ):
        assert planned(df).count("FileScan") == 1


def test_marts_do_not_read_the_table_again(table):
    built = marts.build_marts(table)
    for name, mart in built.items():
        scans = [line for line in planned(mart).splitlines() if "FileScan" in line]
        assert scans and all("/settled-" in line for line in scans), name


def test_joins_of_large_tables_come_before_lookups(spark):
    plan = planned(QUERIES["extract_star"](spark, SF))
    # read from the top: lookups are the outermost joins
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin) \[(\w+)#", plan)
    names = [key for _, key in joins]
    assert names.index("incident_id") > names.index("agency_id")


def test_null_keys_stay_a_join_key(spark):
    left = spark.range(10).selectExpr("nullif(id, 3) as k", "id as a")
    right = spark.range(10).selectExpr("id as k", "id as b")
    plan = planned(op.join_facts(left, right.hint("merge"), ["k"], sparse=True))
    assert re.search(r"Exchange hashpartitioning\(k#\d+L, _spread#\d+L", plan)


def many_orders(spark, folder) -> str:
    """Tables of 200,100 orders with three lines each, one of them of no order."""
    made = {
        "region": spark.sql("select * from values (0, 'AFRICA'), (1, 'ASIA') as t(r_regionkey, r_name)"),
        "nation": spark.range(4).selectExpr("cast(id as int) as n_nationkey", "concat('N', id) as n_name", "cast(id % 2 as int) as n_regionkey"),
        "customer": spark.range(8).selectExpr("id as c_custkey", "cast(id % 4 as int) as c_nationkey"),
        "orders": spark.range(200_100).selectExpr("id as o_orderkey", "id % 8 as o_custkey"),
        "lineitem": spark.range(600_300).selectExpr("nullif(id % 200100, 7) as l_orderkey", "cast(id % 3 as int) as l_linenumber"),
    }
    for name, df in made.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_lines_of_many_orders_are_not_sorted(spark, tmp_path, rows, monkeypatch):
    sf = many_orders(spark, tmp_path)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 4000)
    try:
        plan = planned(incidents(spark, sf, "state", "county"))
        assert "ShuffledHashJoin [l_orderkey" in plan and "SortMergeJoin [l_orderkey" not in plan
        monkeypatch.setattr(bindings, "HASHED_ROWS", 10)  # more orders than may be hashed: sorted, which can spill
        assert "SortMergeJoin [l_orderkey" in planned(incidents(spark, sf, "state", "county"))
        got = rows(QUERIES["union_states"](spark, sf), "state", "county", "count")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # order 7 of customer 7, thus nation 3, has lost its three lines
    assert got == [("AFRICA", "N0", 150_075), ("AFRICA", "N2", 150_075), ("ASIA", "N1", 150_075), ("ASIA", "N3", 150_072)]


def test_stacked_states_join_once(spark):
    plan = planned(QUERIES["union_states"](spark, SF))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 5 and all("/settled-" in line for line in scans) and "Join" not in plan


def test_extraction_by_code_deals_rows_by_incident_once(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = planned(QUERIES["extract_star_by_code"](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # by their names in the tables behind: no exchange has the incident and the offense as its keys
    joins = re.findall(r"SortMergeJoin \[(incident_id#\d+L, offense_id#\d+L)\]", plan)
    assert len(joins) == 1 and f"Exchange hashpartitioning({joins[0]}" not in plan
    assert not re.search(r"Exchange hashpartitioning\(incident_id#\d+L, offense_id#", plan)
