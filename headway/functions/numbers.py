"""Number expressions: tolerant casts, rounding and clamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: texts that count as a number. It keeps out the type suffixes
# and hexadecimal forms that a JVM parser would accept.
NUMBER_PATTERN = (
    r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
)


def to_double(text: Column) -> Column:
    """Text as a double, NULL where it is no number."""
    return F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))


def to_whole(text: Column) -> Column:
    """Text as an int, truncated toward zero; NULL where it is no number or too large."""
    return to_double(text).try_cast("int")


def mean_of(total: Column, n: Column) -> Column:
    """Average from a sum and a count; NULL for no values."""
    return F.try_divide(total.cast("double"), n.cast("double"))


def round2(value: Column) -> Column:
    """Two decimals, half away from zero."""
    return F.round(value, 2)


def whole_minutes(minutes: Column) -> Column:
    """Nearest integer, halves to the even neighbour."""
    return F.bround(minutes, 0).cast("int")


def clamp_minutes(minutes: Column, top: float = 15.0) -> Column:
    """Into [0, top]; NaN becomes 0 (Spark would rank NaN above every number)."""
    return F.greatest(F.lit(0.0), F.least(F.nanvl(minutes, F.lit(0.0)), F.lit(top)))


def clamp_delay(seconds: Column, lo: float = -300, hi: float = 1800) -> Column:
    return F.greatest(F.lit(lo), F.least(seconds, F.lit(hi)))


def minutes_of(value: Column) -> Column:
    """A bare number above 30 is seconds, else it is minutes already."""
    return F.when(~F.isnan(value) & (value > 30), value / 60.0).otherwise(value)
