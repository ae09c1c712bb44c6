"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
data and cores. Every query is run to its last row into a sink that discards.
"""

from __future__ import annotations

import json
import os
import sys
import time

from caseload.catalogue import QUERIES
from caseload.session import local_session, release

HEADLINE = (
    "rate_by_agency_pop", "rate_by_county_pop", "violent_by_state", "offense_distribution",
    "unknown_rate_by_state", "share_sex_window", "yoy_by_category", "top_weapons_per_state",
    "pivot_sex_share", "age_range_distribution", "night_vulnerability", "severity_by_relationship",
    "missing_report", "describe_numeric", "zscore_outliers", "correlations",
    "top_values_all_columns", "cardinality_exact", "rule_report", "clean_by_state_enough",
    "impute_all", "oversample_exact", "standardise", "extract_star", "all_marts_total",
    "heatmap_fips", "county_month", "lag_month", "hotspot_global", "hotspot_features",
    "hotspot_rf",
)
# timed as well, but not part of the total, which stays comparable from round to round;
# the first of them writes the bucketed facts that the second reads
BESIDE = (
    "stored_fact_rows", "extract_star_bucketed", "impute_learned", "standardise_observed", "evaluate_many_scores",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "caseload-bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    times = {}
    for name in HEADLINE + BESIDE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times[n] for n in HEADLINE), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
