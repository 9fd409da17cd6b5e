"""Calendar expressions with the source dialect's conventions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Day labels by day-of-week number, Sunday = 0.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

# Year-month-day with one separator used twice, optionally followed by a time.
_DATE_SHAPE = (r"^\s*(\d{4,})([-/ \\])(\d{1,2})\2(\d{1,2})"
               r"([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?)?\s*$")


def year_of(column: Column | str) -> Column:
    return F.year(column).cast("long")


def quarter_of(column: Column | str) -> Column:
    return F.quarter(column).cast("long")


def month_of(column: Column | str) -> Column:
    return F.month(column).cast("long")


def iso_week(column: Column | str) -> Column:
    return F.weekofyear(column).cast("long")


def day_of_week(column: Column | str) -> Column:
    """Sunday = 0 … Saturday = 6 (Spark itself counts from Sunday = 1)."""
    return (F.dayofweek(column) - 1).cast("long")


def day_name(column: Column | str) -> Column:
    return F.element_at(F.array(*map(F.lit, DAY_NAMES)), F.dayofweek(column))


def month_text(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM")


def years_between(start: Column | str, end: dt.date) -> Column:
    """Calendar-year boundaries crossed, not completed years: 31 Dec → 1 Jan is 1."""
    return (F.lit(end.year) - F.year(start)).cast("long")


def months_before(day: dt.date, months: int) -> dt.date:
    """The same day ``months`` earlier, or that month's last day where it is shorter."""
    first = dt.date(day.year + (day.month - 1 - months) // 12, (day.month - 1 - months) % 12 + 1, 1)
    following = dt.date(first.year + first.month // 12, first.month % 12 + 1, 1)
    return min(first.replace(day=1) + dt.timedelta(days=day.day - 1),
               following - dt.timedelta(days=1))


def parse_date(column: Column) -> Column:
    """Text to date; null when the text is not a full year-month-day date.

    The shape check matters: Spark's own cast would read '2021' or '2021-01' as
    a date, and refuse slashes.
    """
    text = column.cast("string")
    return F.when(text.rlike(_DATE_SHAPE),
                  F.regexp_replace(text, _DATE_SHAPE, "$1-$3-$4").try_cast("date"))
