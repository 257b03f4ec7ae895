"""Time expressions. Zone-less timestamps in, zone-less timestamps out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import to_double

DATE_TEXT = "yyyy-MM-dd HH:mm:ss"

# First and last whole epoch second of the years 0001 to 9999.
FIRST_SECOND = -62135596800
LAST_SECOND = 253402300799


def from_epoch(seconds: Column) -> Column:
    """Epoch seconds, fractions allowed, as a timestamp; NULL outside the years 0001 to 9999.

    An epoch in milli- or microseconds lies outside, and units are not guessed.
    """
    inside = (seconds >= FIRST_SECOND) & (seconds < LAST_SECOND + 1)
    return F.when(inside, F.timestamp_seconds(seconds))


def from_text(text: Column) -> Column:
    """Date text as a timestamp, NULL where it does not fit the format."""
    return F.try_to_timestamp(text, F.lit(DATE_TEXT))


def event_time(text: Column) -> Column:
    """Whole epoch, fractional epoch or date text as a timestamp; else NULL."""
    return F.coalesce(from_epoch(to_double(text)), from_text(text))


def now_epoch() -> Column:
    return F.unix_timestamp()


def plus_minutes(ts: Column, minutes: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))


def local_time(utc: Column, zone: str = "+01:00") -> Column:
    """Wall clock of a zone for a zone-less UTC time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def next_slot(ts: Column, every: int = 10) -> Column:
    """Next full slot strictly after ``ts``; ``every`` divides the hour."""
    minutes = (F.floor(F.minute(ts) / every) + 1) * every
    return plus_minutes(F.date_trunc("hour", ts).cast("timestamp_ntz"), minutes)


def minutes_until(start: Column, end: Column) -> Column:
    """Whole minutes from start to end, at least 1."""
    return F.greatest(F.lit(1), F.timestamp_diff("MINUTE", start, end).cast("int"))


def clock(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")


def as_text(ts: Column) -> Column:
    return F.date_format(ts, DATE_TEXT)


def hour_label(hour: Column) -> Column:
    return F.format_string("%02d:00", hour)


def is_peak(hour: Column) -> Column:
    return hour.between(7, 9) | hour.between(17, 19)


def floor_to(ts: Column, width: str) -> Column:
    """Start of the epoch-aligned tumbling window that holds ``ts``."""
    return F.window(ts, width)["start"]
