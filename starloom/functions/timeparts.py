"""Epoch and day-number conversion, and the date parts of the time dimensions.

All functions assume the session time zone is UTC (``session.pin_utc``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_ZERO = "1960-01-01"  # fixed value: day 0 of the SAS calendar


def epoch_ms_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def epoch_ms_to_text(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss")


def epoch_ms_to_second(ms: Column) -> Column:
    """Whole seconds: the milliseconds are cut, not rounded."""
    return F.timestamp_seconds(F.call_function("div", ms, F.lit(1000)))


def sas_day_to_date(days: Column) -> Column:
    """Day number to date; 0, NULL, NaN and numbers that are no int mean no date."""
    return F.when(days != 0, F.date_add(F.lit(DAY_ZERO).cast("date"), days.try_cast("int")))


def date_to_sas_day(date: Column) -> Column:
    return F.datediff(date, F.lit(DAY_ZERO).cast("date"))


def weekday_from_monday(ts: Column) -> Column:
    """Monday = 0."""
    return F.weekday(ts)


def weekday_from_sunday(ts: Column) -> Column:
    """Sunday = 0."""
    return F.dayofweek(ts) - 1


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


WEEKDAYS = {
    "monday0": weekday_from_monday,
    "sunday0": weekday_from_sunday,
    "name": weekday_name,
}


def time_parts(ts: Column, weekday: str = "monday0", hour: bool = True) -> list[Column]:
    """hour, day, ISO week, month, year, weekday of ``ts``."""
    parts = [F.hour(ts).alias("hour")] if hour else []
    return parts + [
        F.dayofmonth(ts).alias("day"),
        F.weekofyear(ts).alias("week"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        WEEKDAYS[weekday](ts).alias("weekday"),
    ]
