"""Fixed values.

Category lists, labels, cut points and patterns that decide results. They are
data, not logic; the functions and operators take them as defaults and every
one of them can be replaced by an argument.
"""

from __future__ import annotations

# Offense categories counted as violent by the state report.
VIOLENT_CATEGORIES = (
    "Assault Offenses",
    "Homicide Offenses",
    "Kidnapping/Abduction",
    "Robbery",
    "Sex Offenses",
    "Sex Offenses, Non-forcible",
    "Human Trafficking",
)

# The shorter list used by the county and agency reports.
VIOLENT_CATEGORIES_LOCAL = (
    "Assault Offenses",
    "Homicide Offenses",
    "Kidnapping/Abduction",
    "Robbery",
    "Sex Offenses",
)

# Categories counted as high severity.
HIGH_SEVERITY_CATEGORIES = (
    "Homicide Offenses",
    "Human Trafficking",
    "Kidnapping/Abduction",
    "Robbery",
    "Sex Offenses",
    "Sex Offenses, Non-forcible",
    "Assault Offenses",
)

# Weapon names that say nothing about the weapon.
UNINFORMATIVE_WEAPONS = ("Other", "Unknown")

# Fixed value: what counts as a firearm, matched on the lower-cased name.
FIREARM_PATTERN = "gun|firearm|rifle|shotgun|pistol"

# Night hours, 8 PM to 5 AM.
NIGHT_HOURS = (20, 21, 22, 23, 0, 1, 2, 3, 4, 5)

# Hour bands as (first hour, last hour, label).
HOUR_BANDS = (
    (0, 5, "00-05 Night"),
    (6, 11, "06-11 Morning"),
    (12, 17, "12-17 Afternoon"),
    (18, 23, "18-23 Evening"),
)

# Seasons by month.
SEASONS = (
    ("Winter", (12, 1, 2)),
    ("Spring", (3, 4, 5)),
    ("Summer", (6, 7, 8)),
    ("Fall", (9, 10, 11)),
)

# Age ranges as (from, to, note); the last one is open ended.
AGE_RANGES = (
    (0, 17, "(Minor)"),
    (18, 24, "(Young Adult)"),
    (25, 34, ""),
    (35, 44, ""),
    (45, 54, ""),
    (55, 64, ""),
    (65, None, "(Senior)"),
)
EN_DASH = "–"
HYPHEN = "-"
UNKNOWN_AGE = -1
IMPOSSIBLE_AGE = 185

# The five offender age bands; below the first limit, then up to
# and including each of the others.
OFFENDER_MINOR = (18, "Under 18")
OFFENDER_AGE_BANDS = ((25, "18-25"), (40, "26-40"), (60, "41-60"))
OFFENDER_AGE_OVER = "60+"

# Location themes, first match wins.
LOCATION_THEMES = (
    ("Residential", ("Residence/Home",)),
    (
        "Public Space/Transport",
        (
            "Highway/Road/Alley/Street/Sidewalk",
            "Park/Playground",
            "Parking/Drop Lot/Garage",
            "Rest Area",
        ),
    ),
    (
        "Commercial (Retail/Service)",
        (
            "Bar/Nightclub",
            "Convenience Store",
            "Department/Discount Store",
            "Grocery/Supermarket",
            "Hotel/Motel/Etc.",
            "Restaurant",
            "Shopping Mall",
            "Service/Gas Station",
        ),
    ),
    ("Commercial (Office/Financial)", ("Bank/Savings and Loan", "Commercial/Office Building")),
    ("Education", ("School%",)),
    (
        "Institutional",
        (
            "Church/Synagogue/Temple/Mosque",
            "Government/Public Building",
            "Jail/Prison/Penitentiary/Corrections Facility",
        ),
    ),
    ("Outdoor/Rural", ("Field/Woods", "Lake/Waterway/Beach", "Camp/Campground")),
    ("Unknown", ("Other/Unknown",)),
)
LOCATION_THEME_OTHER = "Other"

# Relationship texts with a meaning of their own.
STRANGER = "Victim Was Stranger"
RELATIONSHIP_UNKNOWN = "Relationship Unknown"

# Fixed value: looked-up age name that stands for "see the number".
AGE_IN_YEARS = "age in years"
YEARS_OLD = " years old"

# State spellings met in the data -> full upper-case name.
STATE_NAMES = {
    "NY": "NEW YORK",
    "WA": "WASHINGTON",
    "NM": "NEW MEXICO",
    "TX": "TEXAS",
    "CO": "COLORADO",
    "Colorado": "COLORADO",
    "New Mexico": "NEW MEXICO",
    "Texas": "TEXAS",
    "Washington": "WASHINGTON",
}

# Lower-cased state text -> postal code.
STATE_CODES = {
    "texas": "TX",
    "ny": "NY",
    "washington": "WA",
    "new mexico": "NM",
    "colorado": "CO",
}

# Weekdays in calendar order.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Columns that must be present for a complete row.
CRITICAL_COLUMNS = (
    "offense_id",
    "county",
    "location_name",
    "offender_sex",
    "victim_sex",
    "offender_age",
    "victim_age_group",
    "offense_name",
    "offense_category",
)
# Rows a state must keep, nulls a row may have, seed.
MIN_ROWS_PER_STATE = 600_000
MAX_NULLS_PER_ROW = 2
SEED = 42

# Validation limits of the rule report.
VALID_YEARS = (2020, 2024)
VALID_HOURS = (0, 23)
OLD_AGE = 100
MAX_REASONABLE_AGE = 120

# Fields inspected by the unknown-field rate.
UNKNOWN_RATE_COLUMNS = ("victim_sex", "victim_race", "offender_sex", "offender_race")
UNKNOWN = "Unknown"

# Model settings.
FOREST = {"numTrees": 50, "maxDepth": 8, "seed": 42}
BOOSTING = {"stepSize": 0.05, "maxDepth": 6, "maxIter": 200, "seed": 42}
PATIENCE = 20  # rounds of boosting without gain
HOTSPOT_QUANTILE = 0.90
COUNTY_HOTSPOT_QUANTILE = 0.75
