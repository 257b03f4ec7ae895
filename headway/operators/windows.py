"""Sliding event-time averages and the ranking over them.

A row lies in ``size / slide`` windows. ``via="expand"`` copies each row into
all of them before the partial aggregate, which is the only form a stream in
complete or update mode allows. ``via="panes"`` first adds rows up per pane (a
tumbling window as long as the slide) and rolls panes up into windows, so each
row is aggregated and shuffled once instead of five times; the second shuffle
moves only pane sums, whose number depends on routes and minutes but not on
rows. Sums and counts decompose, so both give the same averages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import mean_of, round2
from .clean import not_ahead

# Window length, slide and rows of the ranking.
SIZE = "5 minutes"
SLIDE = "1 minute"
TOP = 10

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(duration: str) -> int:
    """Seconds of a duration such as ``5 minutes``."""
    number, unit = duration.split()
    return int(number) * _SECONDS[unit.rstrip("s")]


def flatten_window(df: DataFrame, as_text: bool = False) -> DataFrame:
    """``window`` struct to ``window_start`` and ``window_end``, typed or as text."""
    start, end = F.col("window.start"), F.col("window.end")
    if as_text:
        start, end = start.cast("string"), end.cast("string")
    others = [c for c in df.columns if c not in ("window", "route_id")]
    return df.select(
        "route_id", start.alias("window_start"), end.alias("window_end"), *others
    )


def _watermarked(df: DataFrame, late: str | None, ingested: Column | None) -> DataFrame:
    """Rows whose clock runs ahead of ``ingested`` leave before the watermark sees them."""
    if ingested is not None:
        df = not_ahead(df, ingested)
    return df.withWatermark("ts", late) if late else df


def pane_sums(
    df: DataFrame, slide: str = SLIDE, late: str | None = None, ingested: Column | None = None
) -> DataFrame:
    """Sum and count of delays per route and tumbling pane.

    ``ingested``, the time a row came in, keeps one wrong clock from closing the panes of all others.
    """
    df = _watermarked(df, late, ingested)
    panes = df.groupBy(F.window("ts", slide), "route_id").agg(
        F.sum("delay_seconds").alias("delay_sum"),
        F.count("delay_seconds").alias("delay_count"),
    )
    return panes.select("route_id", F.col("window.start").alias("pane"), "delay_sum", "delay_count")


def pane_end(slide: str = SLIDE, ts: str = "ts") -> Column:
    """When the pane of a row ends; NULL without a time (``window`` would drop the row)."""
    length = seconds(slide)
    return F.timestamp_seconds((F.floor(F.unix_seconds(ts) / length) + 1) * length)


def roll_panes(panes: DataFrame, size: str = SIZE, slide: str = SLIDE) -> DataFrame:
    """Panes to sliding windows; a pane lies whole in each window it touches."""
    if seconds(size) % seconds(slide):
        raise ValueError("the window length must be a multiple of the slide")
    rolled = panes.groupBy(F.window("pane", size, slide), "route_id").agg(
        mean_of(F.sum("delay_sum"), F.sum("delay_count")).alias("average_delay_seconds")
    )
    return flatten_window(rolled)


def sliding_avg(
    df: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    late: str | None = None,
    via: str = "panes",
    ingested: Column | None = None,
) -> DataFrame:
    """Average delay per route and sliding window of cleaned telemetry.

    ``late`` sets a watermark on streams, which bounds the state and drops
    rows that come later; without it nothing is ever late. ``ingested`` as in ``pane_sums``.
    """
    if via == "panes" and not df.isStreaming:
        return roll_panes(pane_sums(df, slide, ingested=ingested), size, slide)
    df = _watermarked(df, late, ingested)
    averages = df.groupBy(F.window("ts", size, slide), "route_id").agg(
        F.avg("delay_seconds").alias("average_delay_seconds")
    )
    return flatten_window(averages)


def sliding_avg_raw(df: DataFrame, size: str = SIZE, slide: str = SLIDE, **options) -> DataFrame:
    """The same over uncleaned telemetry: real delays, NULL routes form a group,
    a group without any delay has a NULL average."""
    typed = df.withColumn("delay_seconds", F.col("delay_seconds").cast("double"))
    return sliding_avg(typed, size, slide, **options)


def top_delays(df: DataFrame, n: int = TOP) -> DataFrame:
    """The ``n`` largest averages, NULLs last, ties by route and window."""
    return (
        df.orderBy(F.col("average_delay_seconds").desc_nulls_last(), "route_id", "window_start")
        .limit(n)
        .select(
            "route_id",
            round2(F.col("average_delay_seconds")).alias("avg_delay_sec"),
            "window_start",
            "window_end",
        )
    )
