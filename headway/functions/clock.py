"""Time parsing, delay and time-of-day rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.labels import first_match

# Limits and labels that results are compared on.
ON_TIME_SECONDS = 300
HOUR_BANDS = ((6, 9, "AM_PEAK"), (9, 16, "MIDDAY"), (16, 19, "PM_PEAK"))
OTHER_HOURS = "OFF_PEAK"
WEEKEND_DAYS = (1, 7)  # Sunday, Saturday


def parse_timestamp(text: Column) -> Column:
    """Timestamp from text; NULL where it cannot be read, also under ANSI mode."""
    return F.try_to_timestamp(text)


def parse_date(text: Column) -> Column:
    """Date from text; NULL where it cannot be read, also under ANSI mode."""
    return text.try_cast("date")


def in_zone(ts: Column, time_zone: str | None) -> Column:
    """Wall-clock time of an instant in ``time_zone``; the session zone when None."""
    return ts if time_zone is None else F.convert_timezone(None, F.lit(time_zone), ts)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Whole seconds as int, negative when ``later`` comes first."""
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)).try_cast("int")


def is_on_time(delay: Column, limit: int = ON_TIME_SECONDS) -> Column:
    """Early and up to ``limit`` late is on time; an unknown delay is not."""
    return F.coalesce(delay <= limit, F.lit(False))


def hour_bucket(hour: Column) -> Column:
    """Peak label of an hour of day; unknown hours are off peak."""
    return first_match(
        (((hour >= start) & (hour < end), label) for start, end, label in HOUR_BANDS), OTHER_HOURS
    )


def day_type(day: Column) -> Column:
    """``weekend`` or ``weekday``; unknown days are weekdays."""
    return first_match([(F.dayofweek(day).isin(*WEEKEND_DAYS), "weekend")], "weekday")
