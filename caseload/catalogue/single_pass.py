"""Statistics learned or observed in one pass, exact ranks, and boosting with patience."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from ..plans import cleaning, hotspot, profile
from ..session import settle
from .bindings import incidents, table
from .quality import _TEXT, DATED_SQL, METRICS_SQL, dated
from .registry import query

_GAPS = ("offense_id", "state", "weapon_name", "victim_race", "incident_hour", "population_gaps")


@query(
    "impute_learned",
    "with old as (select * from inc where year < (select max(year) from inc)), "
    "w as (select weapon_name as v from old where weapon_name is not null group by 1 order by count(*) desc, v limit 1), "
    "h as (select cast(trunc(quantile_cont(incident_hour, 0.5)) as int) as v from old), "
    "p as (select state, cast(trunc(quantile_cont(population_gaps, 0.5)) as bigint) as v from old group by 1) "
    "select offense_id, inc.state as state, coalesce(weapon_name, (select v from w)) as weapon_name, "
    "coalesce(victim_race, 'Unknown') as victim_race, coalesce(incident_hour, (select v from h)) as incident_hour, "
    "coalesce(population_gaps, p.v) as population_gaps, weapon_name is null as weapon_name_imputed "
    "from inc left join p on inc.state = p.state where year = (select max(year) from inc)",
)
def impute_learned(spark, sf):
    """The last year filled with what the years before it say."""
    old, last = hotspot.time_split(incidents(spark, sf, "year", *_GAPS))
    fills = cleaning.learn_fills(old, group_median_of={"population_gaps": "state"})
    return cleaning.apply_fills(last, fills, flag=True).select(*_GAPS, "weapon_name_imputed")


@query("standardise_observed", METRICS_SQL)
def standardise_observed(spark, sf):
    """The counters of a frame that was written once."""
    _, found = cleaning.standardise_observed(dated(spark, sf), short_year=2000)
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{n} long" for n in found))


@query("standardise_observed_rows", DATED_SQL)
def standardise_observed_rows(spark, sf):
    return cleaning.standardise_observed(dated(spark, sf), short_year=2000)[0]


@query(
    "evaluate_many_scores",
    "with s as (select case when l_discount > 0.05 then 1 else 0 end as label, "
    "case when l_linenumber = 3 then null else l_extendedprice::double * (1 + l_tax::double) + 500 * (l_discount > 0.07)::int end as score from lineitem), "
    "g as (select score, count(*) filter (label = 1) as p, count(*) filter (label = 0) as q from s where score is not null group by 1), "
    "r as (select *, coalesce(sum(q) over (order by score rows between unbounded preceding and 1 preceding), 0) as below from g) "
    "select sum(p)::bigint as positives, sum(q)::bigint as negatives, "
    "round(sum(2 * p * below + p * q)::double / (2 * sum(p)::double * sum(q)::double), 12) as auc from r",
)
def evaluate_many_scores(spark, sf):
    """The exact area over tens of thousands of different scores."""
    price = F.col("l_extendedprice").cast("double") * (1 + F.col("l_tax").cast("double"))
    scored = table(spark, sf, "lineitem").select(
        (F.col("l_discount") > 0.05).cast("int").alias("label"),
        F.when(F.col("l_linenumber") != 3, price + 500 * (F.col("l_discount") > 0.07).cast("int")).alias("score"),
    )
    return hotspot.exact_auc(scored, "label").withColumn("auc", F.round("auc", 12))


# a loss for every part size, which falls, rises and has ties
_LOSSES = (
    "select p_size::int as round, case when p_size = 7 then null else "
    "(abs(p_size - 20) + p_size % 3 + (count(*) % 2))::double end as loss from part group by p_size"
)


@query(
    "patience_rule",
    f"with l as (select * from ({_LOSSES}) where loss is not null), "
    "b as (select round, min(loss) over (order by round) as low from l), "
    "c as (select b.round, (select min(round) from l where l.loss = b.low and l.round <= b.round) as best, low from b) "
    "select best as best_round, low as best_loss, round as last_round from c "
    "where round = coalesce((select min(round) from c where round - best >= 6), (select max(round) from c))",
)
def patience_rule(spark, sf):
    sizes = table(spark, sf, "part").groupBy(F.col("p_size").cast("int").alias("round")).agg((F.count(F.lit(1)) % 2).alias("odd"))
    loss = F.abs(F.col("round") - 20) + F.col("round") % 3 + F.col("odd")
    return hotspot.chosen_round(sizes.select("round", F.when(F.col("round") != 7, loss.cast("double")).alias("loss")), 6)


@query(
    "hotspot_gbt_patience",
    "select 'best' as rule, true as holds union all select 'patience', true union all select 'trees', true "
    "union all select 'scores', true",
)
def hotspot_gbt_patience(spark, sf):
    """Boosting of the county-months that ends by patience: the chosen round computed again from the
    losses of all rounds, the model's trees, and its scores against those of a model of that length."""
    params = {"stepSize": 0.3, "maxDepth": 3, "maxIter": 24, "seed": 42}
    rows = incidents(spark, sf, "state", "county", "population", "incident_date")
    data = settle(hotspot.features(hotspot.hotspot_label(hotspot.county_month(rows))))
    train, test = hotspot.time_split(hotspot.assemble(data))
    bins = hotspot.max_bins(data)
    found = hotspot.train_gbt_patiently(train, test, bins, params, patience=4)
    losses = [r.loss for r in found.losses.orderBy("round").collect()]  # one row for each round
    best, stop = 0, len(losses) - 1
    for n, x in enumerate(losses):
        best = n if x < losses[best] else best
        if n - best >= 4:
            stop = n
            break
    again = GBTClassifier(labelCol=hotspot.LABEL, maxBins=bins, checkpointInterval=10, **{**params, "maxIter": best + 1}).fit(train)
    key = ["state", "county", "year", "month"]
    ours = hotspot.score(found.model, test).select(*key, "hotspot_probability")
    theirs = hotspot.score(again, test).select(*key, F.col("hotspot_probability").alias("other"))
    same = ours.join(theirs, key).agg(F.max(F.abs(F.col("hotspot_probability") - F.col("other"))).alias("d")).first().d
    holds = [
        ("best", found.best_round == best + 1), ("patience", found.last_round == stop + 1),
        ("trees", found.model.getNumTrees == best + 1), ("scores", same < 1e-9),
    ]
    return spark.createDataFrame(holds, "rule string, holds boolean")


@query("top_values_candidates", like="top_values_all_columns")
def top_values_candidates(spark, sf):
    """The incidents are joined once; both passes, and that over columns counted whole, read that copy."""
    return profile.top_values_by_candidates(settle(incidents(spark, sf, *_TEXT), "rows"))[0]


def _mixed(spark, sf):
    """A column of few values, one of few frequent and many single ones, one of single values."""
    mixed = F.when(F.col("l_partkey") % 10 < 9, F.concat(F.lit("common "), F.col("l_partkey") % 10)).otherwise(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"))
    single = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("few"), mixed.alias("mixed"), single.alias("single"))


@query(
    "top_values_methods",
    "select 'few' as column, 'candidates' as method union all select 'mixed', 'candidates' union all select 'single', 'all values'",
)
def top_values_methods(spark, sf):
    """How each column's first values were proven."""
    return profile.top_values_by_candidates(_mixed(spark, sf), n=5, tracked=1000)[1].select("column", "method")


_MIXED_SQL = (
    "select l_returnflag as few, case when l_partkey % 10 < 9 then 'common ' || (l_partkey % 10) "
    "else l_orderkey || '-' || l_linenumber || '-' || l_partkey end as mixed from lineitem"
)


@query(
    "top_values_mixed",
    "select * from (select *, cast(row_number() over (partition by \"column\" order by count desc, value) as int) as rank from ("
    f"select 'few' as column, few as value, count(*) as count from ({_MIXED_SQL}) group by 2 union all "
    f"select 'mixed', mixed, count(*) from ({_MIXED_SQL}) group by 2)) where rank <= 5",
)
def top_values_mixed(spark, sf):
    return profile.top_values_by_candidates(_mixed(spark, sf), ["few", "mixed"], n=5, tracked=1000)[0]
