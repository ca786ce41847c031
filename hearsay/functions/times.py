"""Time conversions. Timestamps are read in the session time zone; run with UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS = "yyyy-MM-dd HH:mm:ss"
DAYS = "yyyy-MM-dd"
HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS


def to_epoch_ms(text: Column, pattern: str = SECONDS) -> Column:
    return F.unix_millis(F.try_to_timestamp(text, F.lit(pattern)))


def from_epoch_ms(ms: Column, pattern: str = SECONDS) -> Column:
    return F.date_format(F.timestamp_millis(ms), pattern)


def add_days(text: Column, days: Column | int, from_midnight: bool = False) -> Column:
    """Date string plus n days; ``from_midnight`` drops the time of day first."""
    ts = F.try_to_timestamp(text, F.lit(SECONDS))
    if from_midnight:
        ts = F.date_trunc("day", ts)
    days = F.lit(days) if isinstance(days, int) else days
    return ts + F.make_interval(days=days)


def add_hours(text: Column, hours: Column | int) -> Column:
    hours = F.lit(hours) if isinstance(hours, int) else hours
    return F.try_to_timestamp(text, F.lit(SECONDS)) + F.make_interval(hours=hours)


def next_day(day: Column) -> Column:
    return F.date_add(F.to_date(day), 1)


def diff_days(later: Column, earlier: Column) -> Column:
    """Whole 24 hour periods between two timestamps, truncated toward zero."""
    return ((F.unix_millis(later) - F.unix_millis(earlier)) / F.lit(DAY_MS)).cast("int")


def hour_of(ms: Column) -> Column:
    return F.hour(F.timestamp_millis(ms))


def minute_of(ms: Column) -> Column:
    return F.minute(F.timestamp_millis(ms))


def second_of(ms: Column) -> Column:
    return F.second(F.timestamp_millis(ms))


def pad_two(text: Column) -> Column:
    return F.when(text.cast("int") <= 9, F.concat(F.lit("0"), text)).otherwise(text)


def strip_zero(text: Column) -> Column:
    return F.regexp_replace(text, "^0(?=.)", "")


def date_part_of(text: Column) -> Column:
    """The text before the first space."""
    return F.substring_index(text, " ", 1)
