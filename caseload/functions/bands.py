"""Classifications: flags, bands and themes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .. import vocabulary as V
from ._cols import as_col


def crime_type(c: Column | str, violent: Sequence[str] = V.VIOLENT_CATEGORIES) -> Column:
    return F.when(as_col(c).isin(*violent), "Violent").otherwise("Non-Violent")


def severity(c: Column | str, high: Sequence[str] = V.HIGH_SEVERITY_CATEGORIES) -> Column:
    return F.when(as_col(c).isin(*high), "High Severity").otherwise("Lower Severity")


def weapon_flag(c: Column | str, policy: str) -> Column:
    """Was a weapon involved? The three policies differ on a missing name.

    ``listed``   missing counts as without weapon
    ``assumed``  missing counts as a weapon
    ``known``    boolean: named, not blank and not 'unknown'
    """
    c = as_col(c)
    vague = c.isin(*V.UNINFORMATIVE_WEAPONS)
    if policy == "listed":
        return F.when(~vague, "With Weapon").otherwise("Without Weapon")
    if policy == "assumed":
        return F.when(vague, "No").otherwise("Yes")
    if policy == "known":
        return c.isNotNull() & (c != "") & (F.lower(c) != "unknown")
    raise ValueError(f"unknown weapon policy: {policy}")


def offender_age_band(c: Column | str, nulls: str = "unknown") -> Column:
    """Five bands. ``nulls='legacy'`` keeps -1 in the lowest band and a missing
    age in the highest; ``'unknown'`` gives both a band of their own."""
    c = as_col(c)
    band = F
    if nulls == "unknown":
        band = F.when(c.isNull() | (c == V.UNKNOWN_AGE), V.UNKNOWN)
    elif nulls != "legacy":
        raise ValueError(f"unknown null policy: {nulls}")
    adult_from, minor = V.OFFENDER_MINOR
    band = band.when(c < adult_from, minor)
    for upper, label in V.OFFENDER_AGE_BANDS:
        band = band.when(c <= upper, label)
    return band.otherwise(V.OFFENDER_AGE_OVER)


def age_band(c: Column | str, dash: str = V.EN_DASH) -> Column:
    """Seven age ranges, 'Unknown' for -1, 'Other/Invalid' for the rest."""
    c = as_col(c)
    band = F.when(c == V.UNKNOWN_AGE, V.UNKNOWN)
    for low, high, note in V.AGE_RANGES:
        span = f"{low}+" if high is None else f"{low}{dash}{high}"
        hit = c >= low if high is None else c.between(low, high)
        band = band.when(hit, f"{span} {note}".strip())
    return band.otherwise("Other/Invalid")


def hour_band(c: Column | str, nulls: str = "unknown") -> Column:
    """Four bands of the day. ``nulls='legacy'`` puts a missing or impossible
    hour in the evening band."""
    c = as_col(c)
    band = F
    for first, last, label in V.HOUR_BANDS:
        band = band.when(c.between(first, last), label)
    if nulls == "legacy":
        return band.otherwise(V.HOUR_BANDS[-1][2])
    if nulls != "unknown":
        raise ValueError(f"unknown null policy: {nulls}")
    return band.otherwise(V.UNKNOWN)


def season(month: Column | str) -> Column:
    month = as_col(month)
    out = F
    for label, months in V.SEASONS:
        out = out.when(month.isin(*months), label)
    return out.otherwise(V.UNKNOWN)


def location_theme(c: Column | str) -> Column:
    """Theme of a location name; an entry ending in % matches by prefix."""
    c = as_col(c)
    out = F
    for theme, names in V.LOCATION_THEMES:
        prefixes = [n[:-1] for n in names if n.endswith("%")]
        exact = [n for n in names if not n.endswith("%")]
        hit = c.isin(*exact) if exact else F.lit(False)
        for p in prefixes:
            hit = hit | c.startswith(p)
        out = out.when(hit, theme)
    return out.otherwise(V.LOCATION_THEME_OTHER)


def relationship_type(c: Column | str) -> Column:
    c = as_col(c)
    return (
        F.when(c == V.STRANGER, "Stranger")
        .when(c.isNull() | (c == V.RELATIONSHIP_UNKNOWN), V.UNKNOWN)
        .otherwise("Known Relationship")
    )
