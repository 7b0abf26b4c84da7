"""Date cleaning and week arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_WEEK = 7


def text_to_date(text: Column) -> Column:
    """Text (with or without a time part or leading blanks) to a date; NULL where it is none."""
    return text.try_cast("date")


def explode_dates(csv_text: Column) -> Column:
    """One date per item of a comma-separated list. A NULL list gives no row, a malformed item a NULL date."""
    return F.explode(F.split(csv_text, ","))


def week_start(day: Column) -> Column:
    """Monday of the week."""
    return F.trunc(day, "week")


def weeks_between(first: Column, last: Column) -> Column:
    """Array of the Mondays from first to last, both included."""
    return F.sequence(first, last, F.expr(f"interval {DAYS_PER_WEEK} days"))
