"""Scalar functions over the tables, and quantiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from .. import operators as op
from ..plans import hotspot
from .bindings import events, incidents, raw_tables, table
from .quality import _AGE_SQL
from .registry import query


@query(
    "parse_age",
    f"select offense_id, victim_age_group, {_AGE_SQL.format(c='victim_age_group')} as age from inc",
)
def parse_age(spark, sf):
    rows = incidents(spark, sf, "offense_id", "victim_age_group")
    return rows.withColumn("age", fn.parse_age("victim_age_group"))


@query(
    "age_label",
    "select victim_id, case when lower(age_name) = 'age in years' and age_num is not null "
    "then concat(cast(cast(cast(age_num as double) as bigint) as string), ' years old') "
    "else age_name end as label "
    "from raw_victim v left join raw_age a on v.age_id = a.age_id",
)
def age_label(spark, sf):
    t = raw_tables(spark, sf)
    named = op.lookup(t["victim"], t["age"], "age_id", {"age_name": "age_name"})
    return named.select("victim_id", fn.age_label("age_name", "age_num").alias("label"))


@query(
    "parse_date_any",
    "select o_orderkey, cast(o_orderdate as date) as parsed from orders",
)
def parse_date_any(spark, sf):
    """Each order date written in one of five formats, and read back."""
    date = F.col("o_orderdate").cast("date")
    late = F.year(date) >= 2000
    text = (
        F.when(F.col("o_orderstatus") == "P", F.date_format(date, "yyyy-MM-dd"))
        .when((F.col("o_orderstatus") == "F") & late, F.date_format(date, "dd-MMM-yy"))
        .when(F.col("o_orderstatus") == "F", F.date_format(date, "d-MMM-yyyy"))
        .otherwise(F.date_format(date, "dd/MM/yyyy"))
    )
    rows = table(spark, sf, "orders").select("o_orderkey", text.alias("text"))
    return rows.select("o_orderkey", fn.parse_date_any("text").alias("parsed"))


@query(
    "fixed_date_text",
    "select o_orderkey, strftime(cast(o_orderdate as date), '%Y-%m-%d') as text from orders",
)
def fixed_date_text(spark, sf):
    date = F.col("o_orderdate").cast("date")
    short = F.concat(F.lit(" "), F.upper(F.date_format(date, "dd-MMM-yy")))
    text = F.when(F.year(date) == 2000, short).otherwise(F.date_format(date, "yyyy-MM-dd"))
    rows = table(spark, sf, "orders").select("o_orderkey", text.alias("raw"), F.year(date).alias("y"))
    return rows.select("o_orderkey", fn.fix_2020_date("raw", "y", 2000).alias("text"))


@query(
    "date_parts",
    "select distinct incident_date, cast(year(incident_date) as int) as year, "
    "cast(month(incident_date) as int) as month, dayname(incident_date) as day_name, "
    "strftime(incident_date, '%b') as month_abbr, incident_date as strict, incident_date as lenient "
    "from inc",
)
def date_parts(spark, sf):
    days = op.distinct_values(incidents(spark, sf, "incident_date"), "incident_date")
    text = F.date_format("incident_date", "yyyy-MM-dd")
    return days.select(
        "incident_date",
        fn.year_of("incident_date").alias("year"),
        fn.month_of("incident_date").alias("month"),
        fn.day_name("incident_date").alias("day_name"),
        fn.month_abbr(F.month("incident_date")).alias("month_abbr"),
        fn.parse_date(text).alias("strict"),
        fn.parse_date_lenient(text).alias("lenient"),
    )


@query(
    "coerced_keys",
    "select l_orderkey, l_orderkey as key_a, cast(l_quantity as bigint) as key_b from lineitem",
)
def coerced_keys(spark, sf):
    rows = table(spark, sf, "lineitem")
    return rows.select(
        "l_orderkey",
        fn.coerce_key(F.concat(F.col("l_orderkey").cast("string"), F.lit(".0"))).alias("key_a"),
        fn.coerce_key(F.col("l_quantity")).alias("key_b"),
    )


@query(
    "text_functions",
    "select c_custkey, lower(c_name) as lower, upper(c_name) as upper, c_name as trimmed, "
    "concat(n_name, '/', c_mktsegment) as joined, upper(n_name) as county, n_name as bare, "
    "n_name as first_part, lpad(cast(c_nationkey as string), 5, '0') as fips, "
    "upper(c_mktsegment[1:1]) || lower(c_mktsegment[2:]) as title, "
    "cast(c_custkey as string) as text, cast(c_nationkey as double) as number "
    "from customer join nation on c_nationkey = n_nationkey",
)
def text_functions(spark, sf):
    rows = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.expr("c_nationkey = n_nationkey")
    )
    county = F.concat(F.lit(" "), F.col("n_name"), F.lit(" County"))
    return rows.select(
        "c_custkey",
        fn.lower("c_name").alias("lower"),
        fn.upper("c_name").alias("upper"),
        fn.trim(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("trimmed"),
        fn.concat("n_name", F.lit("/"), "c_mktsegment").alias("joined"),
        fn.normalise_county(county).alias("county"),
        fn.strip_suffix(F.concat(F.col("n_name"), F.lit(" Parish"))).alias("bare"),
        fn.first_part(F.concat(F.col("n_name"), F.lit("; NATION_X, NATION_Y"))).alias("first_part"),
        fn.fips5("c_nationkey").alias("fips"),
        fn.title(F.lower("c_mktsegment")).alias("title"),
        fn.as_text("c_custkey").alias("text"),
        fn.as_number(F.col("c_nationkey").cast("string")).alias("number"),
    )


@query(
    "state_names",
    "select r_name, upper(r_name) as state_name, cast(null as string) as state_code from region",
)
def state_names(spark, sf):
    return table(spark, sf, "region").select(
        "r_name",
        fn.state_name("r_name").alias("state_name"),
        fn.state_code("r_name").alias("state_code"),
    )


@query(
    "numeric_functions",
    "select offense_id, line_no, population, case when population > 0 then "
    "victim_age / (population / 1000.0::double) else 0 end as per_1000, "
    "round(ln(1 + population), 6) as log_count, abs(victim_age) as absolute, "
    "victim_age / nullif(incident_hour, 0) * 100 as pct, cast(population as int) as as_int, "
    "round(population / 8.0::double, 2) as rounded, "
    "(case when victim_age is null then 1 else 0 end) + (case when incident_hour is null then 1 "
    "else 0 end) as missing, coalesce(victim_age, offender_age) as first_present, "
    "coalesce(incident_hour, 0) as filled "
    "from inc",
)
def numeric_functions(spark, sf):
    rows = incidents(
        spark, sf, "offense_id", "line_no", "population", "victim_age", "offender_age",
        "incident_hour",
    )
    schema = rows.schema
    out = rows.select(
        "offense_id",
        "line_no",
        "population",
        fn.rate_or_zero("victim_age", "population").alias("per_1000"),
        F.round(fn.log_count("population"), 6).alias("log_count"),
        fn.absolute("victim_age").alias("absolute"),
        fn.pct("victim_age", "incident_hour").alias("pct"),
        fn.to_int(F.concat(F.col("population").cast("string"), F.lit(".0"))).alias("as_int"),
        fn.round2(F.col("population") / 8).alias("rounded"),
        fn.indicator_sum(
            [fn.is_missing(c, schema[c].dataType) for c in ("victim_age", "incident_hour")]
        ).alias("missing"),
        fn.first_present("victim_age", "offender_age").alias("first_present"),
        F.col("incident_hour").alias("filled"),
    )
    return fn.fill(out, {"filled": 0})


@query(
    "seasonality_features",
    "select state, county, year, month, round(sin(2 * pi() * month / 12), 6) as sin_month, "
    "round(cos(2 * pi() * month / 12), 6) as cos_month, "
    "round(n / (p / 1000.0), 6) as crime_rate_per_1000 from "
    "(select state, county, year, month, count(*) as n, max(population) as p from inc "
    "group by 1, 2, 3, 4)",
)
def seasonality_features(spark, sf):
    rows = incidents(spark, sf, "state", "county", "population", "incident_date")
    out = hotspot.season_and_rate(hotspot.county_month(rows))
    measured = ("sin_month", "cos_month", "crime_rate_per_1000")
    return out.select(
        "state", "county", "year", "month", *[F.round(c, 6).alias(c) for c in measured]
    )


@query("exact_quantile_total", "select quantile_cont(population, 0.9) as quantile from inc")
def exact_quantile_total(spark, sf):
    return op.exact_quantile(incidents(spark, sf, "population"), "population", 0.9)


@query(
    "exact_quantile_sliced",
    "select state, quantile_cont(population, 0.9) as quantile from inc group by 1",
)
def exact_quantile_sliced(spark, sf):
    """The way taken when a group has too many distinct values for one task."""
    rows = incidents(spark, sf, "state", "population")
    return op.exact_quantile(rows, "population", 0.9, ["state"], direct_limit=0, slices=16)


@query(
    "median_by_state",
    "select state, quantile_cont(population_gaps, 0.5) as median from inc group by 1",
)
def median_by_state(spark, sf):
    return op.group_median(
        incidents(spark, sf, "state", "population_gaps"), ["state"], "population_gaps", exact=True
    )


@query("median_by_state_approx")
def median_by_state_approx(spark, sf):
    return op.group_median(
        incidents(spark, sf, "state", "population_gaps"), ["state"], "population_gaps"
    )


@query("median_hour_approx")
def median_hour_approx(spark, sf):
    return op.approx_quantile(events(spark, sf, "incident_hour"), "incident_hour", 0.5, 0.01)


@query(
    "mean_hour",
    "select offense_category, round(avg(incident_hour), 6) as mean_hour from ev group by 1",
)
def mean_hour(spark, sf):
    rows = events(spark, sf, "offense_category", "incident_hour")
    means = op.mean_by(rows, "offense_category", column="incident_hour", name="mean_hour")
    return means.withColumn("mean_hour", F.round("mean_hour", 6))
