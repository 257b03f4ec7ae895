"""Retention of a topic by age and by size, in whole segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Segment length, age limit and size limit.
SEGMENT = "2 minutes"
MAX_AGE = "10 minutes"
MAX_BYTES = 52_428_800


def segments(df: DataFrame, segment: str = SEGMENT) -> DataFrame:
    """Bytes and newest row of each segment."""
    return (
        df.groupBy(F.window("ts", segment))
        .agg(F.sum("bytes").alias("bytes"), F.max("ts").alias("newest"))
        .select(F.col("window.start").alias("segment_start"), "bytes", "newest")
    )


def newer_bytes(segs: DataFrame) -> DataFrame:
    """Adds the bytes of all newer segments.

    Two levels: a running sum inside each day, plus the sum of later days. The
    one ordered pass over everything sees a row per day, never a raw row. The
    null-safe join keeps both sides' segments the same plan, computed once.
    """
    dated = segs.withColumn("day", F.to_date("segment_start"))
    before = (Window.unboundedPreceding, -1)
    days = dated.groupBy("day").agg(F.sum("bytes").alias("day_bytes"))
    later = days.select(
        F.col("day").alias("of_day"),
        F.sum("day_bytes").over(Window.orderBy(F.desc("day")).rowsBetween(*before)).alias("later"),
    )
    same_day = Window.partitionBy("day").orderBy(F.desc("segment_start")).rowsBetween(*before)
    return (
        dated.withColumn("same_day", F.sum("bytes").over(same_day))
        .join(later, F.col("day").eqNullSafe(F.col("of_day")))
        .select(
            "segment_start",
            "bytes",
            "newest",
            (F.coalesce("same_day", F.lit(0)) + F.coalesce("later", F.lit(0))).alias("newer"),
        )
    )


def retain_recent(
    df: DataFrame,
    as_of: Column,
    segment: str = SEGMENT,
    max_age: str | None = MAX_AGE,
    max_bytes: int | None = MAX_BYTES,
) -> DataFrame:
    """Rows (``ts``, ``bytes``, ..) of the segments that stay.

    A segment leaves when its newest row is older than ``max_age``, or when the
    segments after it hold ``max_bytes`` already. Both rules cut from the
    oldest end, so what stays is everything from one segment start on: the
    rows are filtered by that one time, without a join.
    """
    segs = segments(df, segment)
    if max_age is not None:
        segs = segs.where(F.col("newest") >= as_of - F.expr(f"INTERVAL {max_age}"))
    if max_bytes is not None:
        segs = newer_bytes(segs).where(F.col("newer") < max_bytes)
    first = segs.agg(F.min("segment_start")).scalar()
    return df.where(F.col("ts") >= first)
