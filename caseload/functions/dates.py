"""Date parsing and parts. Lenient parsers give null instead of failing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._cols import as_col

ISO = "yyyy-MM-dd"
# Accepted forms as (shape, format), None for Spark's own cast;
# day first where both fit.
_ISO_FORM = (r"^\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?$", None)
_SHORT_FORM = (r"^\d{1,2}-[A-Za-z]{3}-\d{2}$", "d-MMM-yy")
_LONG_FORM = (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy")
_MONTH_FIRST_FORM = (r"^\d{1,2}/(1[3-9]|[23]\d)/\d{4}$", "M/d/yyyy")
_DAY_FIRST_FORM = (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy")
_ALL_FORMS = (_ISO_FORM, _SHORT_FORM, _LONG_FORM, _MONTH_FIRST_FORM, _DAY_FIRST_FORM)


def _parse(text: Column, *forms: tuple[str, str | None]) -> Column:
    """Date of a text by its shape.

    A failing parse costs an exception per row, so the shape picks the one
    format that fits instead of trying them in turn.
    """
    out = F
    for shape, form in forms:
        date = F.substring_index(F.substring_index(text, "T", 1), " ", 1).try_cast("date") if form is None else F.try_to_date(text, form)
        out = out.when(text.rlike(shape), date)
    return out


def parse_date(c: Column | str) -> Column:
    """Strict: text that is not a date stops the job."""
    return F.to_date(as_col(c))


def parse_date_lenient(c: Column | str) -> Column:
    """ISO text with or without a time of day, a date or a timestamp; anything else is null."""
    return _parse(F.trim(as_col(c).cast("string")), _ISO_FORM)


def parse_date_any(c: Column | str) -> Column:
    """Any accepted form, a date or a timestamp; text that is none of them is null."""
    return _parse(F.trim(as_col(c).cast("string")), *_ALL_FORMS)


def fix_2020_date(c: Column | str, year: Column | str, short_year: int = 2020) -> Column:
    """Date text in ISO form where the given year wrote it as dd-MMM-yy.

    Other years are only trimmed, and text that does not parse is kept.
    """
    text = F.trim(as_col(c))
    iso = F.date_format(_parse(text, _SHORT_FORM), ISO)
    return F.when(as_col(year) == short_year, F.coalesce(iso, text)).otherwise(text)


def year_of(c: Column | str) -> Column:
    return F.year(as_col(c))


def month_of(c: Column | str) -> Column:
    return F.month(as_col(c))


def day_name(c: Column | str) -> Column:
    """Full English name of the weekday."""
    return F.date_format(as_col(c), "EEEE")


def month_abbr(month: Column | str) -> Column:
    """1 -> 'Jan'."""
    return F.date_format(F.make_date(F.lit(2000), as_col(month), F.lit(1)), "MMM")
