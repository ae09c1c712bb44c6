"""Readers and writers."""

from .readers import (
    bad_row_count,
    read_fips,
    read_incidents,
    read_marts,
    read_raw,
    read_raw_set,
    read_state_years,
    read_states,
    read_table,
    stated_mart,
)
from .writers import replace_partitions, write_cleaned, write_marts, write_predictions, write_result

__all__ = [
    "bad_row_count", "read_fips", "read_incidents", "read_marts", "read_raw", "read_raw_set",
    "read_state_years", "read_states", "read_table", "replace_partitions", "stated_mart", "write_cleaned", "write_marts",
    "write_predictions", "write_result",
]
