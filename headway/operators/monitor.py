"""Numbers about the pipeline itself: counts, rates, latencies, lake size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Reported shares of the latency distribution.
SHARES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def records_per_batch(df: DataFrame, poll: str = "poll_ts") -> DataFrame:
    """Rows of each poll."""
    return df.groupBy(poll).agg(F.count(F.lit(1)).alias("records"))


def ingest_rate(df: DataFrame, per: str = "1 minute", seconds: int = 60) -> DataFrame:
    """Messages and messages per second of each window."""
    return (
        df.groupBy(F.window("ts", per))
        .agg(F.count(F.lit(1)).alias("messages"))
        .select(
            F.col("window.start").alias("window_start"),
            "messages",
            (F.col("messages") / float(seconds)).alias("per_second"),
        )
    )


def ingest_peak(rates: DataFrame) -> DataFrame:
    """Largest rate, when it was first reached, and the totals behind it."""
    busiest = F.min(F.struct((-F.col("messages")).alias("rank"), "window_start"))
    return rates.agg(
        F.max("per_second").alias("peak_per_second"),
        busiest["window_start"].alias("peak_window"),
        F.sum("messages").alias("messages"),
        F.count(F.lit(1)).alias("windows"),
    )


def seconds_between(event: Column, output: Column) -> Column:
    """Whole seconds from an event to the output that shows it."""
    return F.timestamp_diff("SECOND", event, output)


def latency_report(df: DataFrame, by: str = "layer", accuracy: int = 10000) -> DataFrame:
    """Approximate percentiles of ``latency_seconds`` per layer, in one pass.

    Sketches merge map-side, so a layer with most of the rows is no hot spot.
    """
    shares = [F.lit(s) for s in SHARES.values()]
    report = df.groupBy(by).agg(
        F.percentile_approx("latency_seconds", F.array(*shares), accuracy).alias("p"),
        F.max("latency_seconds").alias("worst"),
        F.count("latency_seconds").alias("events"),
    )
    named = [F.col("p")[i].alias(name) for i, name in enumerate(SHARES)]
    return report.select(by, *named, "worst", "events")


def latency_exact(df: DataFrame, by: str = "layer", bucket: int = 3600) -> DataFrame:
    """Exact percentiles of whole-second latencies.

    Rows are first counted per (layer, second). The running count then goes in
    two levels: over the sums of buckets of ``bucket`` seconds, and inside each
    bucket, so a window orders at most ``bucket`` rows, or one row per bucket.
    """
    counts = df.groupBy(by, "latency_seconds").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("bucket", F.floor(F.col("latency_seconds") / bucket))
    layer = Window.partitionBy(by)
    sums = (
        counts.groupBy(by, "bucket")
        .agg(F.sum("n").alias("n"))
        .select(
            by,
            "bucket",
            (F.sum("n").over(layer.orderBy("bucket")) - F.col("n")).alias("below"),
            F.sum("n").over(layer).alias("total"),
        )
    )
    inside = Window.partitionBy(by, "bucket").orderBy("latency_seconds")
    running = counts.withColumn("inside", F.sum("n").over(inside)).join(sums, [by, "bucket"])
    up_to = F.col("below") + F.col("inside")
    named = [
        F.min(F.when(up_to >= F.lit(share) * F.col("total"), F.col("latency_seconds"))).alias(name)
        for name, share in SHARES.items()
    ]
    return running.groupBy(by).agg(
        *named, F.max("latency_seconds").alias("worst"), F.sum("n").alias("events")
    )


def within_rank(report: DataFrame, df: DataFrame, slack: Column, by: str = "layer") -> DataFrame:
    """Whether each percentile of a report is at most ``slack`` ranks off, against the exact counts."""
    shares = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(s).alias("share"), F.col(n).alias("value")) for n, s in SHARES.items()])
    marks = report.select(by, "worst", "events", F.explode(shares).alias("s")).select(by, "worst", "events", "s.*")
    counts = df.groupBy(by, "latency_seconds").agg(F.count(F.lit(1)).alias("n"))
    met = (
        counts.join(marks, by)
        .groupBy(by, "name", "share", "worst", "events")
        .agg(
            F.sum(F.when(F.col("latency_seconds") < F.col("value"), F.col("n")).otherwise(0)).alias("below"),
            F.sum(F.when(F.col("latency_seconds") <= F.col("value"), F.col("n")).otherwise(0)).alias("up_to"),
        )
    )
    rank = F.col("share") * F.col("events")
    return met.select(
        by,
        F.col("name").alias("share"),
        "worst",
        "events",
        ((F.col("below") <= rank + slack) & (F.col("up_to") >= rank - slack)).alias("within"),
    )


def report_within(df: DataFrame, by: str = "layer", accuracy: int = 10000) -> DataFrame:
    """Whether each approximate percentile of the report keeps its promise: a rank
    error of at most ``events / accuracy``, against the exact counts."""
    return within_rank(latency_report(df, by, accuracy), df, F.col("events") / accuracy + 1, by)


# Size of the stored quantile sketches, and the share of ranks by which they may be off:
# twice the error that 99 % of the sketches of this size keep.
SKETCH_K = 1024
SKETCH_SLACK = 0.0075


def latency_sketches(df: DataFrame, by: Sequence[str] = ("layer", "hour"), k: int = SKETCH_K) -> DataFrame:
    """One quantile sketch (some KB), the worst latency and the number of events per layer and hour.

    The rows of several deliveries may lie side by side in a table: ``latency_from_sketches`` merges them.
    """
    return df.groupBy(*by).agg(
        F.kll_sketch_agg_bigint("latency_seconds", k).alias("sketch"),
        F.max("latency_seconds").alias("worst"),
        F.count("latency_seconds").alias("events"),
    )


def latency_from_sketches(store: DataFrame, by: str = "layer") -> DataFrame:
    """The percentiles of ``latency_report`` from stored sketches; no event is read again.

    Sketches merge map-side, and a filter on the hour gives the figures of any span of hours.
    """
    merged = store.groupBy(by).agg(
        F.kll_merge_agg_bigint("sketch").alias("sketch"), F.max("worst").alias("worst"), F.sum("events").alias("events")
    )
    named = [F.kll_sketch_get_quantile_bigint("sketch", F.lit(share)).alias(name) for name, share in SHARES.items()]
    return merged.select(by, *named, "worst", "events")


def lake_footprint(lake: DataFrame, by: Sequence[str] = ("event_date",)) -> DataFrame:
    """Files, rows and bytes of a file-backed table per partition value.

    Reads file metadata and partition values only; no column is decoded.
    """
    files = (
        lake.select(*by, "_metadata.file_path", "_metadata.file_size")
        .groupBy(*by, "file_path")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("file_size").alias("bytes"))
    )
    return files.groupBy(*by).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("rows").alias("rows"),
        F.sum("bytes").alias("bytes"),
    )
