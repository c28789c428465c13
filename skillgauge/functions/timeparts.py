"""Calendar expressions on ``timestamp_ntz``; date arithmetic keeps them free of time zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(time: Column) -> Column:
    return time.cast("date")


def week_start(day: Column) -> Column:
    """Monday of the week holding ``day`` (a date)."""
    return F.date_sub(day, F.weekday(day))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def as_time(day: Column) -> Column:
    """Midnight of a date."""
    return day.cast("timestamp_ntz")


def mid_week(monday: Column) -> Column:
    return as_time(F.date_add(monday, 3))


def mid_month(first: Column) -> Column:
    return as_time(F.date_add(first, 14))


def mid_year(year: Column) -> Column:
    return as_time(F.make_date(year, F.lit(7), F.lit(1)))


def parse_time(text: Column) -> Column:
    """NULL for text that is no timestamp."""
    return text.try_cast("timestamp_ntz")
