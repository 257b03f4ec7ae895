"""Queries over whole tables, one per operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import catalog, numbers, text, times
from ..operators import (
    board,
    clean,
    documents,
    feed,
    history,
    monitor,
    parse,
    retention,
    serving,
    topics,
    windows,
    wire,
)
from ..session import shared_folder
from ..sources import dims, files
from ..streaming import sinks
from . import views

TOPIC_PATTERN = "click|view|err.*"

# Fixed parameters of the retention query, so that either rule acts at some size.
KEEP_AGE = "10 days"
KEEP_BYTES = 100_000


def as_of() -> F.Column:
    return F.lit(views.AS_OF).cast("timestamp_ntz")


def zoneless(df: DataFrame) -> DataFrame:
    """Zoned timestamps as zone-less UTC ones."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz") if f.dataType.typeName() == "timestamp" else f.name
            for f in df.schema.fields
        ]
    )


# ---- parse and clean ----------------------------------------------------


def _parsed(spark: SparkSession, sf_dir: str, dialect: str = "tolerant") -> DataFrame:
    rows = parse.parse_telemetry(views.payloads(spark, sf_dir), dialect, keep=("event_id",))
    return zoneless(rows.select("event_id", "route_id", "delay_seconds", "ts"))


def telemetry_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir)


def telemetry_parse_s1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "s1")


def telemetry_parse_s2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "s2")


def telemetry_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.cleaned(spark, sf_dir).select("event_id", "route_id", "delay_seconds", "ts")


def telemetry_clean_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean.clean_telemetry(views.telemetry(spark, sf_dir), mode="full")
    return rows.select("event_id", "route_id", "delay_seconds", "ts")


def telemetry_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.rejected_telemetry(_parsed(spark, sf_dir)).select("event_id", "reason")


# ---- windows ------------------------------------------------------------


def sliding_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.windowed(spark, sf_dir)


def sliding_delay_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sliding_avg(views.cleaned(spark, sf_dir), via="expand")


def sliding_delay_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sliding_avg_raw(_parsed(spark, sf_dir, "s2"))


def lake_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = [F.col(c).cast("string").alias(c) for c in ("window_start", "window_end")]
    return views.windowed(spark, sf_dir).select("route_id", *text, "average_delay_seconds")


def top_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.top_delays(views.windowed(spark, sf_dir))


# ---- lake and history ---------------------------------------------------


def lake_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.lake(spark, sf_dir)


def historical_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.historical_avg(views.lake(spark, sf_dir))


def historical_avg_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.historical_avg(history.normalise_routes(views.lake(spark, sf_dir)))


def historical_first20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.historical_first(views.lake(spark, sf_dir))


def route_avg_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.route_avg_strict(parse.parse_lake_lines(views.lake_lines(spark, sf_dir)))


def _folder(spark: SparkSession, purpose: str, write) -> str:
    folder = shared_folder(spark, purpose)
    write(folder)
    return folder


def historical_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of lake files: broken lines are rows of the NULL route, blank ones are none."""
    lines = views.lake_json(spark, sf_dir)
    return history.historical_avg(files.read_lake(spark, _folder(spark, "json", lines.write.text)))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "mixed")
    for name, lines in zip(("rows", "feed"), views.mixed_lake(spark, sf_dir)):
        lines.write.text(f"{folder}/{name}")
    return files.read_documents(spark, f"{folder}/*")


def historical_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of a folder that lake rows share with feed messages."""
    rows = documents.typed_rows(_documents(spark, sf_dir))
    return history.historical_avg(rows.where("family <> 'feed'"))


def document_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each family, and how many of them hold fields that no column takes."""
    rows = documents.typed_rows(_documents(spark, sf_dir))
    more = F.coalesce(F.size("others") > 0, F.lit(False))
    vehicle = F.try_variant_get(F.get(F.map_values("others"), F.lit(0)), "$.id", "bigint")
    return rows.groupBy("family").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(more).alias("with_others"), F.sum(vehicle).alias("vehicles")
    )


def feed_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.flatten_feed(documents.feed_rows(_documents(spark, sf_dir)))


def strict_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.lake_lines(spark, sf_dir)
    return history.route_avg_strict(files.read_lines(spark, _folder(spark, "lines", lines.write.text)))


def feed_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = views.feed(spark, sf_dir).select("poll_ts", "entity")
    return feed.flatten_feed(files.read_feed(spark, _folder(spark, "feed", messages.write.json)))


def pairs_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.pair_avg(history.split_pairs(views.pair_lines(spark, sf_dir)))


def pairs_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.pair_lines(views.telemetry(spark, sf_dir))


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.latest_snapshot(views.snapshots(spark, sf_dir))


# ---- feed ---------------------------------------------------------------


def feed_from_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wire.flatten_messages(wire.decode_stops(views.feed_bytes(spark, sf_dir)))


def feed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that could not be read, by order."""
    keep = ("order",)
    return wire.broken_messages(wire.decode_stops(views.feed_bytes(spark, sf_dir), keep=keep), keep)


def feed_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.flatten_feed(views.feed(spark, sf_dir))


def polls_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.records_per_batch(views.polls(spark, sf_dir))


# ---- serving ------------------------------------------------------------


def serving_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_per_route(views.windowed(spark, sf_dir))


def serving_from_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.current(spark, sf_dir)


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.merge_layers(
        dims.dim_routes(spark),
        views.live_store(spark, sf_dir),
        dims.dim_baselines(spark),
        dims.DEFAULT_BASELINE,
    )


def merge_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir).select(
        "route",
        "baseline_minutes",
        numbers.clamp_minutes(F.col("delay_minutes")).alias("delay_minutes"),
    )


def serving_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.serving_coverage(dims.dim_routes(spark), views.live_store(spark, sf_dir))


def lambda_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = history.normalise_routes(views.lake(spark, sf_dir))
    return serving.lambda_view(history.route_history(lake), views.current(spark, sf_dir))


def arrival_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board.arrival_board(_merged(spark, sf_dir), as_of())


# The route whose line of the board is looked up.
ONE_ROUTE = "39A"


def route_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board.one_route(arrival_board(spark, sf_dir), ONE_ROUTE)


def sql_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board in SQL, by the functions of the session."""
    catalog.register(spark)
    return spark.sql(
        """
        WITH live AS (
            SELECT r.route, coalesce(nullif(live_value, ''), nullif(fallback_value, '')) AS text,
                   coalesce(baseline_minutes, :default) AS baseline
            FROM {routes} r LEFT JOIN {store} s ON s.route = r.route LEFT JOIN {baselines} b ON b.route = r.route),
        timed AS (
            SELECT route, whole_minutes(clamp_minutes(live_minutes(text, baseline))) AS delay_mins,
                   convert_timezone('UTC', :zone, CAST(:as_of AS TIMESTAMP_NTZ)) AS now FROM live),
        due AS (
            SELECT *, next_slot(now, :every) AS scheduled,
                   next_slot(now, :every) + make_dt_interval(0, 0, delay_mins) AS expected FROM timed)
        SELECT route, delay_mins, status_text(delay_mins) AS status, delay_level(delay_mins) AS level,
               date_format(scheduled, 'HH:mm') AS scheduled_time, date_format(expected, 'HH:mm') AS expected_time,
               minutes_until(now, expected) AS next_arrival_mins
        FROM due""",
        args={"default": dims.DEFAULT_BASELINE, "zone": board.ZONE, "as_of": views.AS_OF, "every": board.FREQUENCY},
        routes=dims.dim_routes(spark),
        store=views.live_store(spark, sf_dir),
        baselines=dims.dim_baselines(spark),
    )


def sql_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry cleaned in SQL: events per route code."""
    catalog.register(spark)
    return spark.sql(
        """SELECT route_code(route_id) AS route, count(*) AS reports FROM {t}
           WHERE delay_seconds BETWEEN :lo AND :hi AND route_code(route_id) <> '' GROUP BY ALL""",
        args={"lo": clean.LOWEST_DELAY, "hi": clean.HIGHEST_DELAY},
        t=views.telemetry(spark, sf_dir),
    )


def route_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of each route beside its usual delay, from a map."""
    pairs = [F.lit(x) for pair in dims.BASELINES.items() for x in pair]
    reports = views.cleaned(spark, sf_dir).groupBy(F.col("route_id").alias("route")).agg(F.count(F.lit(1)).alias("reports"))
    usual = text.lookup(F.create_map(*pairs), F.col("route"), dims.DEFAULT_BASELINE)
    return reports.withColumn("baseline_minutes", usual)


def events_so_far(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by type whose time has come, by the clock of the run."""
    rows = views.table(spark, sf_dir, "events")
    come = F.unix_seconds(F.col("ts").cast("timestamp")) <= times.now_epoch()
    return rows.groupBy("event_type").agg(F.count_if(come).alias("so_far"), F.count_if(~come).alias("to_come"))


def hourly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board.known_profile(
        views.cleaned(spark, sf_dir), _merged(spark, sf_dir), dims.dim_routes(spark)
    )


def vehicle_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicles on the paths of the routes that report."""
    seen = serving.known_routes(views.cleaned(spark, sf_dir), dims.dim_routes(spark))
    routes = (
        seen.groupBy("route_id")
        .agg(F.count(F.lit(1)).alias("reports"))
        .withColumnRenamed("route_id", "route")
    )
    paths = board.route_path(routes, dims.dim_paths(spark), dims.DEFAULT_PATH)
    return board.place_vehicles(paths, dims.dim_vehicles(spark))


# ---- monitoring, retention, topics --------------------------------------


def ingest_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.ingest_rate(views.telemetry(spark, sf_dir))


def ingest_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.ingest_peak(ingest_rate(spark, sf_dir))


def latency_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The approximate percentiles against the exact counts: each within its rank error."""
    return monitor.report_within(views.latencies(spark, sf_dir))


def latency_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.latency_exact(views.latencies(spark, sf_dir))


def latency_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of two deliveries, stored by layer and hour and merged on read, against the exact counts."""
    folder, rows = shared_folder(spark, "sketches"), views.latencies(spark, sf_dir)
    odd = F.col("latency_seconds") % 2 == 1
    for part in (rows.where(odd), rows.where(~odd)):
        monitor.latency_sketches(part).write.mode("append").parquet(folder)
    report = monitor.latency_from_sketches(spark.read.parquet(folder))
    return monitor.within_rank(report, rows, F.col("events") * monitor.SKETCH_SLACK + 1)


def lake_footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and bytes depend on the writer: only that there are some is compared."""
    folder = shared_folder(spark, "footprint")
    sinks.write_table(views.telemetry(spark, sf_dir), folder, "ts")
    return monitor.lake_footprint(spark.read.parquet(folder)).select(
        "event_date", "rows", (F.col("files") >= 1).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes")
    )


def retain_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention.retain_recent(
        views.sized(spark, sf_dir), as_of(), max_age=KEEP_AGE, max_bytes=KEEP_BYTES
    )


def route_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = topics.route_topics(views.topic_rows(spark, sf_dir), TOPIC_PATTERN)
    inner = routed.withColumn("payload", parse.unwrap_envelope(F.col("value")))
    rows = parse.parse_telemetry(inner, keep=("event_id", "topic"))
    return zoneless(rows.select("event_id", "topic", "route_id", "delay_seconds", "ts"))


def payload_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    delay = F.when(F.col("event_id") % 13 != 0, F.col("delay_seconds"))
    rows = views.telemetry(spark, sf_dir).withColumn("delay_seconds", delay)
    return topics.to_topic_rows(rows, "event_id", "route_id", "delay_seconds").select(
        "value",
        F.get_json_object("value", "$.route_id").alias("route_id"),
        F.get_json_object("value", "$.delay_seconds").try_cast("int").alias("delay_seconds"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        telemetry_parse,
        telemetry_parse_s1,
        telemetry_parse_s2,
        telemetry_clean,
        telemetry_clean_full,
        telemetry_rejects,
        sliding_delay,
        sliding_delay_expand,
        sliding_delay_raw,
        lake_rows,
        top_delays,
        lake_union,
        historical_avg,
        historical_avg_merged,
        historical_first20,
        route_avg_strict,
        historical_from_json,
        historical_from_documents,
        document_families,
        feed_from_documents,
        strict_from_lines,
        pairs_avg,
        pairs_text,
        latest_snapshot,
        feed_flatten,
        feed_from_json,
        feed_from_bytes,
        feed_rejects,
        polls_count,
        serving_current,
        serving_from_panes,
        merge_layers,
        serving_coverage,
        lambda_view,
        arrival_board,
        route_board,
        sql_board,
        sql_clean,
        route_baselines,
        events_so_far,
        hourly_profile,
        vehicle_positions,
        ingest_rate,
        ingest_peak,
        latency_report,
        latency_exact,
        latency_sketched,
        lake_footprint,
        retain_recent,
        route_topics,
        payload_json,
    )
}
