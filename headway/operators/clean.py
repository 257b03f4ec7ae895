"""Cleaning of parsed telemetry, and the rows it turns away."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import route_code

# Delays outside these bounds (seconds, inclusive) are outliers.
LOWEST_DELAY = -300
HIGHEST_DELAY = 3600

#: How far an event time may lie ahead of the time its row came in. One clock that is
#: wrong by more would move the watermark, and with it drop the good rows after it.
AHEAD = "1 hour"


def not_ahead(df: DataFrame, ingested: Column, ahead: str = AHEAD, ts: str = "ts") -> DataFrame:
    """Rows whose event time is at most ``ahead`` later than ``ingested``; to be applied before a watermark."""
    return df.where(~is_ahead(ingested, ahead, ts))


def is_ahead(ingested: Column, ahead: str = AHEAD, ts: str = "ts") -> Column:
    return F.coalesce(F.col(ts) > ingested + F.expr(f"INTERVAL {ahead}"), F.lit(False))


def clean_telemetry(
    df: DataFrame, lo: int = LOWEST_DELAY, hi: int = HIGHEST_DELAY, mode: str = "digits"
) -> DataFrame:
    """Short route codes, delays inside ``[lo, hi]``; NULLs and empty routes leave."""
    return df.withColumn("route_id", route_code(F.col("route_id"), mode)).where(
        F.col("delay_seconds").between(lo, hi) & (F.col("route_id") != "")
    )


def reject_reason(
    lo: int = LOWEST_DELAY,
    hi: int = HIGHEST_DELAY,
    mode: str = "digits",
    ingested: Column | None = None,
    ahead: str = AHEAD,
) -> Column:
    """Why a parsed row takes no part in the averages; NULL for a good row.

    With ``ingested``, rows that ``not_ahead`` turns away have a reason as well.
    """
    late_clock = F.lit(False) if ingested is None else is_ahead(ingested, ahead)
    route, delay, ts = F.col("route_id"), F.col("delay_seconds"), F.col("ts")
    return (
        F.when(route.isNull() & delay.isNull() & ts.isNull(), "unparsed")
        .when(ts.isNull(), "no event time")
        .when(late_clock, "event time ahead")
        .when(route.isNull() | (route_code(route, mode) == ""), "no route code")
        .when(delay.isNull(), "no delay")
        .when(~delay.between(lo, hi), "delay out of range")
    )


def rejected_telemetry(
    df: DataFrame,
    lo: int = LOWEST_DELAY,
    hi: int = HIGHEST_DELAY,
    mode: str = "digits",
    ingested: Column | None = None,
    ahead: str = AHEAD,
) -> DataFrame:
    """Quarantine: the parsed rows cleaning or windowing drops, with the ``reason``."""
    return df.withColumn("reason", reject_reason(lo, hi, mode, ingested, ahead)).where(
        F.col("reason").isNotNull()
    )
