"""Column -> Column functions. All of them are built-in Spark expressions."""

from .bands import (
    age_band,
    crime_type,
    hour_band,
    location_theme,
    offender_age_band,
    relationship_type,
    season,
    severity,
    weapon_flag,
)
from .dates import (
    day_name,
    fix_2020_date,
    month_abbr,
    month_of,
    parse_date,
    parse_date_any,
    parse_date_lenient,
    year_of,
)
from .ages import age_label, parse_age
from .numbers import (
    absolute,
    indicator_sum,
    log_count,
    pct,
    pct_decimal,
    rate,
    rate_or_zero,
    round2,
    season_cos,
    season_sin,
    to_int,
)
from .nulls import fill, first_present, is_missing
from .text import (
    as_number,
    as_text,
    coerce_key,
    concat,
    fips5,
    first_part,
    lower,
    normalise_county,
    state_code,
    state_name,
    strip_suffix,
    title,
    trim,
    upper,
)

__all__ = [
    "absolute", "age_band", "age_label", "as_number", "as_text", "coerce_key", "concat",
    "crime_type", "day_name", "fill", "fips5", "first_part", "first_present", "fix_2020_date",
    "hour_band", "indicator_sum", "is_missing", "location_theme", "log_count", "lower",
    "month_abbr", "month_of", "normalise_county", "offender_age_band", "parse_age", "parse_date",
    "parse_date_any", "parse_date_lenient", "pct", "pct_decimal", "rate", "rate_or_zero",
    "relationship_type", "round2", "season", "season_cos", "season_sin", "severity",
    "state_code", "state_name", "strip_suffix", "title", "to_int", "trim", "upper",
    "weapon_flag", "year_of",
]
