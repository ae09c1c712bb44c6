"""Joins, extraction, unions and county codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as op
from ..plans.extract import Profile, extract_incidents
from ..plans.stored import StoredFacts, extract_stored, store_facts
from ..session import settle
from .bindings import fips, incidents, raw_tables, table
from .registry import query

_AGE = (
    "case when lower({n}) = 'age in years' and {v} is not null "
    "then concat(cast(cast(cast({v} as double) as bigint) as string), ' years old') else {n} end"
)


def _extract_sql(age_fix: bool) -> str:
    victim_age = _AGE.format(n="va.age_name", v="v.age_num") if age_fix else "va.age_name"
    offender_age = _AGE.format(n="oa.age_name", v="o.age_num") if age_fix else "oa.age_name"
    return (
        "with fo as (select * from (select *, row_number() over (partition by victim_id "
        "order by offender_id, relationship_id) as rn from raw_victim_offender_rel) where rn = 1), "
        "fw as (select * from (select *, row_number() over (partition by offense_id "
        "order by weapon_id) as rn from raw_weapon_link) where rn = 1) "
        "select f.offense_id, a.ucr_agency_name as agency_name, a.county_name as county, "
        "cast(a.population as double) as population, lt.location_name, i.incident_date, "
        "cast(i.incident_hour as double) as incident_hour, ot.offense_name, "
        "ot.offense_category_name as offense_category, wt.weapon_name, "
        "vt.victim_type_name as victim_type, v.sex_code as victim_sex, "
        f"{victim_age} as victim_age_group, vr.race_desc as victim_race, "
        "v.resident_status_code as victim_resident_status, o.sex_code as offender_sex, "
        f"re.relationship_name as relationship, {offender_age} as offender_age, "
        "v.victim_id, orc.race_desc as offender_race "
        "from raw_incident i left join raw_agencies a on i.agency_id = a.agency_id "
        "left join raw_offense f on i.incident_id = f.incident_id "
        "left join raw_offense_type ot on f.offense_type_id = ot.offense_type_id "
        "left join raw_location_type lt on f.location_id = lt.location_id "
        "left join (select l.victim_id, l.offense_id, x.incident_id, x.victim_type_id, x.age_id, "
        "x.age_num, x.race_id, x.sex_code, x.resident_status_code "
        "from raw_victim_offense_link l left join raw_victim x on l.victim_id = x.victim_id) v "
        "on f.offense_id = v.offense_id and i.incident_id = v.incident_id "
        "left join raw_age va on v.age_id = va.age_id "
        "left join raw_race vr on v.race_id = vr.race_id "
        "left join raw_victim_type vt on v.victim_type_id = vt.victim_type_id "
        "left join fo on v.victim_id = fo.victim_id "
        "left join raw_offender o on fo.offender_id = o.offender_id "
        "left join raw_age oa on o.age_id = oa.age_id "
        "left join raw_race orc on o.race_id = orc.race_id "
        "left join raw_relationship re on fo.relationship_id = re.relationship_id "
        "left join fw on f.offense_id = fw.offense_id "
        "left join raw_weapon_type wt on fw.weapon_id = wt.weapon_id"
    )


@query("extract_star", _extract_sql(age_fix=True))
def extract_star(spark, sf):
    return extract_incidents(raw_tables(spark, sf))


@query("extract_star_by_code", _extract_sql(age_fix=False))
def extract_star_by_code(spark, sf):
    """The variant keyed by offense code that leaves ages as looked up."""
    tables = raw_tables(spark, sf)
    for name in ("offense", "offense_type"):
        tables[name] = tables[name].withColumn("offense_code", F.col("offense_type_id"))
    return extract_incidents(tables, Profile(key="offense_code", age_fix=False))


_STORED: dict[tuple[str, str], StoredFacts] = {}


def _stored(spark, sf) -> StoredFacts:
    """The facts of a folder, written once in a session."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _STORED:
        _STORED[at] = store_facts(raw_tables(spark, sf))
    return _STORED[at]


@query("extract_star_bucketed", _extract_sql(age_fix=True))
def extract_star_bucketed(spark, sf):
    """The same table from facts that lie in buckets by incident."""
    return extract_stored(_stored(spark, sf), raw_tables(spark, sf))


@query(
    "stored_fact_rows",
    "select 'incident' as fact, count(*) as count from raw_incident union all "
    "select 'offense', count(*) from raw_offense union all "
    "select 'victim', count(*) from raw_victim union all "
    "select 'victim_offense_link', count(*) from raw_victim_offense_link join raw_victim using (victim_id) union all "
    "select 'weapon_link', count(*) from raw_weapon_link where offense_id in (select offense_id from raw_offense) union all "
    "select 'first_offender', count(distinct victim_id) from raw_victim_offender_rel",
)
def stored_fact_rows(spark, sf):
    """Rows of every stored fact; all of them know their incident."""
    stored = _stored(spark, sf)
    parts = [
        side.filter("incident_id is not null").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("fact"), "n")
        for tables in (stored.even, stored.hot) for name, side in tables.items()
    ]
    return op.union_states(parts).groupBy("fact").agg(F.sum("n").alias("count"))


@query(
    "extract_star_dates",
    "select distinct o_orderkey as incident_key, cast(o_orderdate as date) as incident_date, "
    "l_orderkey * 10 + l_linenumber as offense_id "
    "from orders left join lineitem on o_orderkey = l_orderkey",
)
def extract_star_dates(spark, sf):
    """Dates normalised during extraction; the agency carries the incident key."""
    tables = raw_tables(spark, sf)
    tables["incident"] = tables["incident"].withColumn("agency_id", F.col("incident_id"))
    tables["agencies"] = tables["incident"].select(
        "agency_id",
        F.col("incident_id").cast("string").alias("ucr_agency_name"),
        F.lit(None).cast("string").alias("county_name"),
        F.lit(None).cast("string").alias("population"),
    )
    flat = extract_incidents(tables, Profile(date_fix=True))
    return flat.select(
        F.col("agency_name").cast("bigint").alias("incident_key"), "incident_date", "offense_id"
    ).distinct()


@query(
    "join_facts_left",
    "select o_orderkey, l_linenumber, l_partkey from orders left join lineitem "
    "on o_orderkey = l_orderkey",
)
def join_facts_left(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey"
    )
    return op.join_facts(orders, lines, ["o_orderkey"])


@query(
    "join_first",
    "select o_orderkey, l_linenumber, l_partkey, l_suppkey from orders left join (select * from ("
    "select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, "
    "l_suppkey) as rn from lineitem) where rn = 1) on o_orderkey = l_orderkey",
)
def join_first(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    carried = ["l_linenumber", "l_partkey", "l_suppkey"]
    return op.join_first(orders, lines, "o_orderkey", carried, carried)


@query(
    "first_per_key",
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey from (select *, row_number() over ("
    "partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as rn from lineitem) "
    "where rn = 1",
)
def first_per_key(spark, sf):
    columns = ["l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, sf, "lineitem").select("l_orderkey", *columns)
    return op.first_per_key(lines, ["l_orderkey"], columns)


@query(
    "lookup_left",
    "select o_orderkey, o_custkey, c_name as customer_name, c_mktsegment as segment from orders "
    "left join customer on o_custkey = c_custkey",
)
def lookup_left(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return op.lookup(
        orders, table(spark, sf, "customer"), "o_custkey",
        {"c_name": "customer_name", "c_mktsegment": "segment"}, dim_key="c_custkey",
    )


@query(
    "picked_key_join",
    "select l_orderkey, l_linenumber, p_name from lineitem left join part "
    "on l_partkey = p_partkey",
)
def picked_key_join(spark, sf):
    lines = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey as code")
    parts = table(spark, sf, "part").selectExpr("p_partkey as code", "p_name")
    key = op.pick_key(lines, parts, ("type_id", "code"))
    return op.lookup(lines, parts, key, {"p_name": "p_name"}).drop(key)


@query(
    "union_states",
    "select state, county, count(*) as count from inc group by 1, 2",
)
def union_states(spark, sf):
    """One frame per state, stacked by name in whatever column order; the incidents are joined once."""
    rows = settle(incidents(spark, sf, "state", "county"))
    states = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
    frames = [rows.filter(F.col("state") == s) for s in states]
    frames[1] = frames[1].select("county", "state")
    return op.count_by(op.union_states(frames), "state", "county")


@query(
    "union_missing_columns",
    "select o_orderkey as id, o_orderstatus as status, cast(null as string) as segment from orders "
    "union all select c_custkey, null, c_mktsegment from customer",
)
def union_missing_columns(spark, sf):
    orders = table(spark, sf, "orders").selectExpr("o_orderkey as id", "o_orderstatus as status")
    customers = table(spark, sf, "customer").selectExpr("c_custkey as id", "c_mktsegment as segment")
    return op.union_states([orders, customers], allow_missing=True)


@query(
    "project_rename_sanitize",
    'select c_custkey as "Customer_Id", c_mktsegment as "Segment_A_B", '
    "c_name as \"Nr_Name\" from customer",
)
def project_rename_sanitize(spark, sf):
    rows = op.rename_map(
        table(spark, sf, "customer"),
        {"c_custkey": " Customer Id", "c_mktsegment": "Segment (A/B)", "c_name": "Nr. Name", "x": "y"},
    )
    wanted = [" Customer Id", "not there", "Segment (A/B)", "Nr. Name"]
    return op.sanitize_columns(op.project_ordered(rows, wanted))


_HEAT = (
    "select state, county, offense_category, count(*) as count from inc group by 1, 2, 3"
)


@query(
    "heatmap_fips",
    f"select h.*, lpad(fips.fips, 5, '0') as fips from ({_HEAT}) h join fips "
    "on upper(h.state) = upper(fips.state_name) "
    "and upper(h.county) = upper(replace(fips.county_name, ' County', '')) "
    "where lpad(fips.fips, 5, '0') <> '00000'",
)
def heatmap_fips(spark, sf):
    rows = incidents(spark, sf, "state", "county", "offense_category")
    counts = op.count_by(rows, "state", "county", "offense_category")
    return op.attach_fips(counts, fips(spark, sf))


@query(
    "heatmap_fips_unmatched",
    f"select h.*, case when fips.fips <> '0' then lpad(fips.fips, 5, '0') end as fips "
    f"from ({_HEAT}) h left join fips "
    "on upper(h.state) = upper(fips.state_name) "
    "and upper(h.county) = upper(replace(fips.county_name, ' County', ''))",
)
def heatmap_fips_unmatched(spark, sf):
    rows = incidents(spark, sf, "state", "county", "offense_category")
    counts = op.count_by(rows, "state", "county", "offense_category")
    return op.attach_fips(counts, fips(spark, sf), keep_unmatched=True)


_JOINED = (
    "select o_orderkey, concat(n_name, ', ', r_name, ' ;', c_mktsegment) as county from orders "
    "join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey "
    "join region on n_regionkey = r_regionkey"
)


def _county_lists(spark, sf):
    return (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, sf, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
        .selectExpr(
            "o_orderkey", "r_name as state", "n_name",
            "concat(n_name, ', ', r_name, ' ;', c_mktsegment) as county",
        )
    )


@query(
    "multi_county_explode",
    "select o_orderkey, lower(trim(unnest(regexp_split_to_array(county, '[;,]')))) as county "
    f"from ({_JOINED})",
)
def multi_county_explode(spark, sf):
    lists = _county_lists(spark, sf).select("o_orderkey", "county")
    return op.explode_counties(lists).withColumn("county", F.lower("county"))


@query(
    "multi_county_fips",
    "select o_orderkey, lpad(cast(c_nationkey * 7 as string), 5, '0') as fips from orders "
    "join customer on o_custkey = c_custkey where c_nationkey <> 0",
)
def multi_county_fips(spark, sf):
    """Of the places listed one is a county with a code."""
    lists = _county_lists(spark, sf).select("o_orderkey", "state", "county")
    coded = op.attach_fips(lists, fips(spark, sf), multi="explode")
    return coded.select("o_orderkey", "fips")


@query(
    "first_county_fips",
    "select o_orderkey, lpad(cast(c_nationkey * 7 as string), 5, '0') as fips from orders "
    "join customer on o_custkey = c_custkey where c_nationkey <> 0",
)
def first_county_fips(spark, sf):
    lists = _county_lists(spark, sf).select("o_orderkey", "state", "county")
    return op.attach_fips(lists, fips(spark, sf), multi="first").select("o_orderkey", "fips")


@query(
    "predictions_by_fips",
    "select p.state, p.county, round(p.m, 6) as hotspot_probability, "
    "lpad(fips.fips, 5, '0') as fips "
    "from (select state, county, avg(n) as m from (select state, county, year, month, "
    "count(*) as n from inc group by 1, 2, 3, 4) group by 1, 2) p join fips "
    "on p.state = fips.state_name and p.county = replace(fips.county_name, ' County', '') "
    "where fips.fips <> '0'",
)
def predictions_by_fips(spark, sf):
    rows = incidents(spark, sf, "state", "county", "year", "month")
    monthly = op.count_by(rows, "state", "county", "year", "month", name="n")
    coded = op.attach_fips(op.distinct_values(rows, "state", "county"), fips(spark, sf))
    out = op.predictions_by_fips(monthly, coded, "n").withColumnRenamed("n", "hotspot_probability")
    return out.withColumn("hotspot_probability", F.round("hotspot_probability", 6))


@query(
    "keep_top_groups",
    "select offense_id, line_no, offense_category from inc where offense_category in ("
    "select offense_category from inc group by 1 order by count(*) desc, offense_category limit 8)",
)
def keep_top_groups(spark, sf):
    rows = incidents(spark, sf, "offense_id", "line_no", "offense_category")
    return op.keep_top_groups(rows, "offense_category", 8)


@query(
    "label_codes",
    "select location_name, cast(dense_rank() over (order by location_name) - 1 as int) "
    "as location_name_idx from (select distinct location_name from inc)",
)
def label_codes(spark, sf):
    return op.label_code(incidents(spark, sf, "location_name"), "location_name")


@query(
    "label_codes_many",
    "select p_partkey as label, cast(row_number() over (order by p_partkey) - 1 as int) as code "
    "from (select distinct lpad(cast(l_partkey as string), 9, '0') as p_partkey from lineitem)",
)
def label_codes_many(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("lpad(cast(l_partkey as string), 9, '0') as label")
    return op.label_code(rows, "label", "code")


@query("year_and_category_filter", "select offense_id, year, offense_category from inc "
       "where year = 1998 and offense_category = 'Robbery'")
def year_and_category_filter(spark, sf):
    rows = incidents(spark, sf, "offense_id", "year", "offense_category")
    return op.select_category(op.select_year(rows, 1998), "Robbery")


@query(
    "hot_suppliers",
    "select l_suppkey, count(*) as count from lineitem group by 1 having count(*) > "
    "0.005 * (select count(*) from lineitem)",
)
def hot_suppliers(spark, sf):
    """Keys above a share of all rows, found by the sketch and then counted."""
    lines = table(spark, sf, "lineitem").select("l_suppkey")
    hot = op.hot_keys(lines, ["l_suppkey"], 0.005)
    return op.count_by(lines.filter(F.xxhash64("l_suppkey").isin(*hot)), "l_suppkey")


