"""Text, key and place-name functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from ..vocabulary import STATE_CODES, STATE_NAMES
from ._cols import as_col


# casts that fail cost an exception per row, so texts are looked at first
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def lower(c: Column | str) -> Column:
    return F.lower(as_col(c))


def upper(c: Column | str) -> Column:
    return F.upper(as_col(c))


def title(c: Column | str) -> Column:
    return F.initcap(as_col(c))


def trim(c: Column | str) -> Column:
    return F.trim(as_col(c))


def concat(*cs: Column | str) -> Column:
    """Null if any part is null."""
    return F.concat(*[as_col(c) for c in cs])


def as_text(c: Column | str) -> Column:
    return as_col(c).cast("string")


def as_number(c: Column | str, dtype: str = "double") -> Column:
    """Text to number; text that is not a number becomes null."""
    text = F.trim(as_col(c).cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast(dtype))


def coerce_key(c: Column | str) -> Column:
    """Key text ('12', '12.0') to bigint. Only a trailing '.0' is removed."""
    text = F.trim(as_col(c).cast("string"))
    # one pattern tells the shape; what stands before the point is then cut out without one
    return F.when(text.rlike(r"^[+-]?\d+(\.0)?$"), F.substring_index(text, ".", 1).try_cast("bigint"))


def text_key(c: Column | str) -> Column:
    """Code such as '120' or '13A' as text; '120.0' is the same code as '120'."""
    return F.regexp_replace(F.trim(as_col(c).cast("string")), r"^(\d+)\.0$", "$1")


def strip_suffix(c: Column | str, words: Sequence[str] = ("county", "parish")) -> Column:
    """Remove one trailing word such as ' County', whatever its case."""
    return F.regexp_replace(as_col(c), rf"(?i)\s+({'|'.join(words)})\s*$", "")


def first_part(c: Column | str, separators: str = "[;,]") -> Column:
    return F.trim(F.split(as_col(c), separators)[0])


def fips5(c: Column | str) -> Column:
    """Pad to five digits. Longer text is kept: lpad alone would cut it."""
    text = F.trim(as_col(c).cast("string"))
    return F.when(F.length(text) < 5, F.lpad(text, 5, "0")).otherwise(text)


def normalise_county(c: Column | str, multi: str = "none") -> Column:
    """Comparable county name: trimmed, without 'County'/'Parish', upper case.

    ``multi='first'`` keeps the first county of a list such as 'A, B; C'.
    """
    text = as_col(c)
    if multi == "first":
        text = F.split(text, "[;,]")[0]
    return F.upper(F.trim(strip_suffix(F.trim(text))))


def _mapped(c: Column, table: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), c)


def state_name(c: Column | str, names: Mapping[str, str] = STATE_NAMES) -> Column:
    """Full upper-case state name; an unlisted state is only upper-cased."""
    text = as_col(c)
    return F.coalesce(_mapped(text, names), F.upper(text))


def state_code(c: Column | str, codes: Mapping[str, str] = STATE_CODES) -> Column:
    """Postal code, null for an unlisted state."""
    return _mapped(F.lower(as_col(c)), codes)
