"""DataFrame -> DataFrame operators."""

from .filters import (
    drop_incomplete,
    drop_invalid_age,
    filter_not_in,
    firearm_only,
    max_nulls,
    night_only,
    null_count,
    select_category,
    select_year,
    violent,
)
from .grouping import (
    count_by,
    crosstab,
    crosstab_map,
    distinct_values,
    mean_by,
    mode_of,
    pivot_share,
    rate_of_units,
    rate_per_100k,
    row_of_max,
    share_of_group,
    share_of_total,
    subset_rate,
    sum_by,
    unknown_rate,
)
from .joins import (
    ambiguous_fips,
    attach,
    attach_fips,
    hot_keys,
    join_facts,
    join_first,
    join_unique,
    keep_top_groups,
    lookup,
    pick_key,
    predictions_by_fips,
)
from .quantiles import approx_quantile, exact_quantile, group_median
from .ranking import (
    label_code,
    lag_month,
    sort_by_metric,
    sort_weekday,
    top_n,
    top_per_group,
    total_change,
    yoy,
)
from .shape import (
    display,
    explode_counties,
    first_per_key,
    long_rows,
    project_ordered,
    rename_map,
    sanitize_columns,
    sanitize_name,
    union_states,
)

__all__ = [
    "ambiguous_fips", "approx_quantile", "attach", "attach_fips", "count_by", "crosstab", "crosstab_map", "display",
    "distinct_values", "drop_incomplete", "drop_invalid_age", "exact_quantile",
    "explode_counties", "filter_not_in", "firearm_only", "first_per_key", "group_median",
    "hot_keys", "join_facts", "join_first", "join_unique", "keep_top_groups", "label_code", "lag_month",
    "long_rows", "lookup", "max_nulls", "mean_by", "mode_of", "night_only", "null_count",
    "pick_key", "pivot_share", "predictions_by_fips", "project_ordered", "rate_of_units", "rate_per_100k",
    "rename_map", "row_of_max", "sanitize_columns", "sanitize_name", "select_category",
    "select_year", "share_of_group", "share_of_total", "sort_by_metric", "sort_weekday",
    "subset_rate", "sum_by", "top_n", "top_per_group", "total_change", "union_states",
    "unknown_rate", "violent", "yoy",
]
