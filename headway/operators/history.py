"""Batch layer: averages over the lake."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import round2, to_double
from ..functions.text import route_code, split_pair, strip


def union_lake(*families: DataFrame) -> DataFrame:
    """Row families of the lake under one set of columns; absent ones are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), families)


def normalise_routes(lake: DataFrame, mode: str = "digits") -> DataFrame:
    """``Route_46A`` and ``46A`` as one route."""
    return lake.withColumn("route_id", route_code(F.col("route_id"), mode))


def route_history(lake: DataFrame) -> DataFrame:
    """Average (two decimals) and row count per route.

    The average skips NULLs, the count does not, and the NULL route is a group.
    """
    return lake.groupBy("route_id").agg(
        round2(F.avg("average_delay_seconds")).alias("historical_avg_delay"),
        F.count(F.lit(1)).alias("total_window_batches_analyzed"),
    )


def historical_avg(lake: DataFrame) -> DataFrame:
    """The route history in route order, NULL first."""
    return route_history(lake).orderBy(F.col("route_id").asc_nulls_first())


def historical_first(lake: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows of the historical averages."""
    return historical_avg(lake).limit(n)


def route_pairs(df: DataFrame) -> DataFrame:
    """Rows with both a route and a delay."""
    return df.dropna(subset=["route_id", "average_delay_seconds"])


def split_pairs(lines: DataFrame, value: str = "value") -> DataFrame:
    """``route<TAB>delay`` lines to typed pairs; blank lines, lines without a tab
    and texts that are no number leave."""
    line = strip(F.col(value))
    route, delay = split_pair(line)
    return (
        lines.where(line != "")
        .select(route.alias("route_id"), to_double(delay).alias("average_delay_seconds"))
        .where(F.col("average_delay_seconds").isNotNull())
    )


def pair_avg(pairs: DataFrame) -> DataFrame:
    """Average (two decimals) per non-empty route, over the numeric delays."""
    delay = F.col("average_delay_seconds")
    if dict(pairs.dtypes)["average_delay_seconds"] == "string":
        delay = to_double(delay)
    # Texts that are no number are NULL to the average; a filter for them would
    # run the conversion once more per row. Routes without any leave afterwards.
    return (
        pairs.where(F.col("route_id") != "")
        .groupBy("route_id")
        .agg(round2(F.avg(delay)).alias("average_delay"))
        .where(F.col("average_delay").isNotNull())
    )


def route_avg_strict(reports: DataFrame) -> DataFrame:
    """Average per route over rows with both a route and a numeric delay."""
    return pair_avg(route_pairs(reports))


def snapshot_order():
    """Later runs, then later batches, as one number (a fixed-width sort key)."""
    return F.shiftleft(F.col("run_id").cast("bigint"), 40) + F.col("batch_id")


def latest(lake: DataFrame, keys: Sequence[str], values: Sequence[str], order=None) -> DataFrame:
    """Last written values of each key, by ``order`` or ``batch_id``.

    Values and order are fixed-width, so Spark keeps them in a hash aggregate
    with map-side combine; a struct in ``max_by`` would force a sort of the
    lake. Each batch holds a key once, so all ``max_by`` agree.
    """
    order = F.col("batch_id") if order is None else order
    last = [F.max_by(v, "_order").alias(v) for v in values]
    return lake.withColumn("_order", order).groupBy(*keys).agg(*last)


def latest_snapshot(lake: DataFrame, order=None) -> DataFrame:
    """Last written average per route and window."""
    keys = ("route_id", "window_start")
    return latest(lake, keys, ("window_end", "average_delay_seconds"), order)
