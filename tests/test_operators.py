"""Operators on small hand-made inputs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from headway import schemas
from headway.operators import (
    board,
    clean,
    feed,
    history,
    monitor,
    parse,
    retention,
    serving,
    topics,
    windows,
)
from headway.sources import dims, files, topics as topic_source
from headway.streaming import sinks


def at(clock, day=1):
    return dt.datetime.fromisoformat(f"2024-01-{day:02d} {clock}")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def texts(spark, *lines, name="payload"):
    return spark.createDataFrame([(x,) for x in lines], f"{name} string")


def telemetry(spark, *data):
    return spark.createDataFrame(list(data), "route_id string, delay_seconds int, ts timestamp_ntz")


# ---- parse --------------------------------------------------------------


def test_topic_bytes_to_rows(spark):
    line = b'{"route_id":"Route_7","bus_id":"b","delay_seconds":60,"timestamp":1704067200.5}'
    records = spark.createDataFrame([(bytearray(line),)], "value binary")
    row = parse.parse_telemetry(parse.payload_text(records)).first()
    assert (row.route_id, row.bus_id, row.delay_seconds) == ("Route_7", "b", 60)
    assert row.ts == dt.datetime(2024, 1, 1, 0, 0, 0, 500000)


def test_strict_dialects_null_what_they_cannot_read(spark):
    dated = '{"route_id":"r","delay_seconds":123.0,"timestamp":"2024-01-01 00:00:05"}'
    whole = '{"route_id":"r","delay_seconds":123,"timestamp":1704067200}'
    parts = '{"route_id":"r","delay_seconds":123,"timestamp":1704067200.5}'
    df = texts(spark, dated, whole, parts)
    pick = ("route_id", "delay_seconds", "ts")
    s1 = [tuple(r) for r in parse.parse_telemetry(df, "s1").select(*pick).collect()]
    s2 = [tuple(r) for r in parse.parse_telemetry(df, "s2").select(*pick).collect()]
    start = dt.datetime(2024, 1, 1)
    half = dt.datetime(2024, 1, 1, 0, 0, 0, 500000)
    assert s1 == [("r", None, None), ("r", 123, start), ("r", 123, half)]
    assert s2 == [("r", 123.0, at("00:00:05")), ("r", 123.0, start), ("r", 123.0, None)]


def test_null_and_partial_texts_keep_their_row(spark):
    df = texts(spark, None, "", '{"route_id":"7","delay_seconds":5', "{'route_id':'8'}")
    got = parse.parse_telemetry(df).select("route_id", "delay_seconds", "ts").collect()
    assert [tuple(r) for r in got][:2] == [(None, None, None)] * 2
    assert len(got) == 4 and got[3].route_id == "8"


def test_filters_do_not_repeat_the_parse(spark):
    df = clean.rejected_telemetry(parse.parse_telemetry(texts(spark, "{}")))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_unknown_dialect(spark):
    with pytest.raises(ValueError):
        parse.parse_telemetry(texts(spark, "{}"), "s9")


def test_envelope(spark):
    df = texts(
        spark, '{"schema":{},"payload":{"a":1}}', '{"a":2}', "junk", '{"schema":{},"payload":null}', '{"payload":3}', name="v"
    )
    got = [r[0] for r in df.select(parse.unwrap_envelope(F.col("v"))).collect()]
    assert got == ['{"a":1}', '{"a":2}', "junk", None, '{"payload":3}']


def test_far_epochs_stop_no_window(spark):
    far = [f'{{"route_id":"7","delay_seconds":5,"timestamp":{t}}}' for t in (10**14, 17 * 10**14, -(10**14), 17 * 10**17)]
    for dialect in ("tolerant", "s1", "s2"):
        rows_ = parse.parse_telemetry(texts(spark, *far), dialect)
        assert [r.ts for r in rows_.collect()] == [None] * 4
        assert windows.sliding_avg(clean.clean_telemetry(rows_)).count() == 0
        assert windows.sliding_avg(clean.clean_telemetry(rows_), via="expand").count() == 0


def test_rows_ahead_of_their_arrival_have_a_reason(spark):
    df = spark.sql("""SELECT '7' AS route_id, 5 AS delay_seconds, t AS ts, timestamp'2024-01-01 12:00:00' AS came
        FROM VALUES (timestamp'2024-01-01 13:00:00'), (timestamp'2024-01-01 13:00:01'), (NULL) AS v(t)""")
    assert clean.not_ahead(df, F.col("came")).count() == 2
    reasons = [r.reason for r in clean.rejected_telemetry(df, ingested=F.col("came")).collect()]
    assert sorted(reasons) == ["event time ahead", "no event time"]


def test_a_decoded_feed_fits_the_flattener(spark):
    decoded = spark.sql("""SELECT named_struct('header', named_struct('timestamp', 5L), 'entity', array(named_struct(
        'trip_update', named_struct('trip', named_struct('route_id', 'r', 'trip_id', 't'), 'stop_time_update',
        array(named_struct('stop_id', 's', 'departure', named_struct('delay', 3), 'arrival', named_struct('delay', 4))))))) AS feed""")
    got = feed.flatten_feed(feed.unpack_feed(decoded)).collect()
    assert [tuple(r) for r in got] == [(5, "r", "t", "s", 3)]


def test_null_fields_are_written(spark):
    df = spark.sql("SELECT '1' AS route_id, CAST(NULL AS INT) AS delay_seconds")
    assert topics.to_topic_rows(df).first().value == '{"route_id":"1","delay_seconds":null}'


def test_latencies_over_many_buckets(spark):
    df = spark.range(0, 200_000).select(F.lit("x").alias("layer"), (F.col("id") * 7 % 199_999).alias("latency_seconds"))
    got = monitor.latency_exact(df, bucket=1000).first()
    values = sorted(k * 7 % 199_999 for k in range(200_000))
    want = [values[-(-len(values) * p // 100) - 1] for p in (50, 95, 99)]
    assert [got.p50, got.p95, got.p99] == want and got.events == 200_000


def test_rejects_and_clean_rows_split_the_input(spark):
    df = texts(
        spark,
        "not json",
        "[1]",
        '{"route_id":"7","delay_seconds":5}',
        '{"route_id":"x","delay_seconds":5,"timestamp":1704067200}',
        '{"delay_seconds":5,"timestamp":1704067200}',
        '{"route_id":"7","timestamp":1704067200}',
        '{"route_id":"7","delay_seconds":-301,"timestamp":1704067200}',
        '{"route_id":"7","delay_seconds":-300,"timestamp":1704067200}',
        '{"route_id":"7","delay_seconds":3600,"timestamp":1704067200}',
        '{"route_id":"7","delay_seconds":3601,"timestamp":1704067200}',
    )
    parsed = parse.parse_telemetry(df)
    reasons = [r.reason for r in clean.rejected_telemetry(parsed).collect()]
    assert sorted(reasons) == sorted(
        ["unparsed"] * 2
        + ["no event time", "no delay"]
        + ["no route code"] * 2
        + ["delay out of range"] * 2
    )
    good = clean.clean_telemetry(parsed).where("ts is not null")
    assert sorted(r.delay_seconds for r in good.collect()) == [-300, 3600]


# ---- windows ------------------------------------------------------------


@pytest.mark.parametrize("via", ["panes", "expand"])
def test_a_row_is_in_five_windows(spark, via):
    df = telemetry(spark, ("7", 60, at("10:04:30")), ("8", 60, at("10:05:00")), ("9", 1, None))
    got = windows.sliding_avg(df, via=via)
    starts = {r: sorted(x.window_start.minute for x in got.where(F.col("route_id") == r).collect()) for r in "789"}
    assert starts == {"7": [0, 1, 2, 3, 4], "8": [1, 2, 3, 4, 5], "9": []}
    assert all(r.window_end - r.window_start == dt.timedelta(minutes=5) for r in got.collect())


@pytest.mark.parametrize("via", ["panes", "expand"])
def test_raw_average_keeps_null_routes_and_null_averages(spark, via):
    df = telemetry(spark, (None, 10, at("10:00:30")), (None, 20, at("10:00:40")), ("x", None, at("10:00:30")))
    got = windows.sliding_avg_raw(df, via=via)
    assert {(r.route_id, r.average_delay_seconds) for r in got.collect()} == {(None, 15.0), ("x", None)}
    assert [r.avg_delay_sec for r in windows.top_delays(got).collect()] == [15.0] * 5 + [None] * 5


def test_other_window_sizes(spark):
    df = telemetry(spark, ("7", 60, at("10:04:30")))
    assert windows.sliding_avg(df, "1 hour", "15 minutes").count() == 4
    with pytest.raises(ValueError):
        windows.sliding_avg(df, "5 minutes", "2 minutes")
    assert windows.sliding_avg(df, "5 minutes", "2 minutes", via="expand").count() == 3


def test_top_breaks_ties_by_route_and_window(spark):
    df = telemetry(spark, ("9", 60, at("10:04:30")), ("10", 60, at("10:04:30")), ("8", 70, at("10:00:00")))
    top = windows.top_delays(windows.sliding_avg(df), 7).collect()
    assert [r.route_id for r in top] == ["8"] * 5 + ["10"] * 2
    assert [r.window_start.minute for r in top[5:]] == [0, 1]


def test_window_text(spark):
    df = telemetry(spark, ("7", 60, at("10:04:30")))
    struct = df.groupBy(F.window("ts", "5 minutes"), "route_id").agg(F.avg("delay_seconds").alias("a"))
    row = windows.flatten_window(struct, as_text=True).first()
    assert tuple(row) == ("7", "2024-01-01 10:00:00", "2024-01-01 10:05:00", 60.0)


# ---- lake and history ---------------------------------------------------


def test_lake_of_three_families(spark, folder):
    families = {
        "batch_1.json": ['{"route_id":"7","average_delay_seconds":10.5}', '{"route_id":"7","average_delay_seconds":20.0}'],
        "raw_batch_1.json": ['{"route_id":"7","delay_seconds":5,"timestamp":1704067200}', "{broken"],
        "batch_historical_100.json": ['{"route_id":"Route_7","average_delay_seconds":2.675}'],
    }
    for name, lines in families.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")
    lake = files.read_lake(spark, f"{folder}/*.json")
    got = [tuple(r) for r in history.historical_avg(lake).collect()]
    assert got == [(None, None, 1), ("7", 15.25, 3), ("Route_7", 2.68, 1)]
    merged = history.historical_avg(history.normalise_routes(lake))
    assert [tuple(r)[::2] for r in merged.collect()] == [(None, 1), ("7", 4)]
    strict = history.route_avg_strict(files.read_lines(spark, f"{folder}/*.json"))
    assert rows(strict) == [("7", 15.25), ("Route_7", 2.68)]


def test_historical_order_is_text_order_and_limited(spark):
    lake = spark.createDataFrame([(r, 1.0) for r in ("140", "14", "1", "13", "11", None)], "route_id string, average_delay_seconds double")
    got = [r.route_id for r in history.historical_first(lake, 5).collect()]
    assert got == [None, "1", "11", "13", "14"]


def test_lines_drop_blank_broken_lists_and_text_delays(spark):
    lines = texts(
        spark,
        "",
        "   ",
        "\t",
        '{"route_id":"9","average_delay_seconds":1} junk',
        '{"route_id":"9","average_delay_seconds":1}{"route_id":"9","average_delay_seconds":1}',
        '{"route_id":"9","average_delay_seconds":1},{}',
        '{"route_id":"9","average_delay_seconds":1}] {}',
        '{"route_id":"7","average_delay_seconds":5',
        "[1]",
        '{"route_id":"7"}',
        '{"average_delay_seconds":1}',
        '{"route_id":"7","average_delay_seconds":"abc"}',
        '{"route_id":"7","average_delay_seconds":"4"}',
        '{"route_id":"7","average_delay_seconds":6.0}',
        '{"route_id":"","average_delay_seconds":6.0}',
        name="value",
    )
    assert rows(history.route_avg_strict(parse.parse_lake_lines(lines))) == [("7", 5.0)]


def test_strict_and_plain_average_agree_on_clean_rows(spark):
    lake = spark.createDataFrame([(str(i % 7), i * 0.25) for i in range(100)], "route_id string, average_delay_seconds double")
    plain = rows(history.historical_avg(lake).drop("total_window_batches_analyzed"))
    assert plain == rows(history.route_avg_strict(lake))


def test_pairs_from_text(spark, folder):
    with open(f"{folder}/p.txt", "w") as f:
        f.write("7\t10\n\n  \n7\t20.5 \n8\tx\nno tab\n\t5\n9\t1\t2\n")
    pairs = files.read_pairs(spark, f"{folder}/p.txt")
    assert rows(history.pair_avg(pairs)) == [("7", 15.25)]


def test_pairs_written_and_read_back(spark, folder):
    df = spark.createDataFrame([("7", 5), ("8", 6)], "route_id string, delay_seconds int")
    sinks.write_pairs(df, f"{folder}/out")
    assert rows(files.read_pairs(spark, f"{folder}/out")) == [("7", 5.0), ("8", 6.0)]


def test_latest_snapshot_takes_the_last_batch_and_is_idempotent(spark):
    data = [
        ("7", at("10:00:00"), at("10:05:00"), 1.0, 0, 0),
        ("7", at("10:00:00"), at("10:05:00"), 2.0, 0, 5),
        ("7", at("10:00:00"), at("10:05:00"), 3.0, 1, 0),
        ("8", at("10:00:00"), at("10:05:00"), 9.0, 0, 2),
    ]
    lake = spark.createDataFrame(
        data,
        "route_id string, window_start timestamp_ntz, window_end timestamp_ntz, "
        "average_delay_seconds double, run_id int, batch_id int",
    )
    once = history.latest_snapshot(lake, history.snapshot_order())
    assert [r[3] for r in rows(once)] == [3.0, 9.0]
    again = history.latest_snapshot(once.withColumn("batch_id", F.lit(0)))
    assert rows(again) == rows(once)


# ---- feed ---------------------------------------------------------------


def test_feed_from_json(spark, folder):
    def stop(i, **events):
        return {"stop_id": i, **{k: {"delay": v} if v is not None else {} for k, v in events.items()}}

    message = {
        "poll_ts": 1704067200,
        "entity": [
            {"vehicle": {"id": 1}},
            {
                "trip_update": {
                    "trip": {"route_id": "60-123", "trip_id": "t1"},
                    "stop_time_update": [
                        stop("a", departure=30, arrival=60),
                        stop("b", arrival=60),
                        stop("c", departure=None, arrival=60),
                        stop("d"),
                    ],
                }
            },
            {"trip_update": {"trip": {"route_id": "7", "trip_id": "t2"}, "stop_time_update": []}},
        ],
    }
    with open(f"{folder}/feed.json", "w") as f:
        f.write(json.dumps(message) + "\n")
    got = feed.flatten_feed(files.read_feed(spark, folder))
    assert [f.simpleString() for f in got.schema] == [
        "timestamp:bigint", "route_id:string", "trip_id:string", "stop_id:string", "delay_seconds:int",
    ]
    assert [(r.stop_id, r.delay_seconds) for r in got.collect()] == [("a", 30), ("b", 60), ("c", 0), ("d", 0)]
    assert {r.timestamp for r in got.collect()} == {1704067200}


# ---- serving and board --------------------------------------------------


def store(spark, *data):
    return spark.createDataFrame(list(data), schemas.LIVE_STORE)


def test_layers_merge_live_then_baseline_then_default(spark):
    live = store(spark, ("46A", '{"average_delay_seconds":600}', None), ("G1", "junk", None), ("C1", "", "5"), ("zz", "9", None))
    merged = serving.merge_layers(dims.dim_routes(spark), live, dims.dim_baselines(spark))
    got = {r.route: r.delay_minutes for r in merged.collect()}
    assert len(got) == 104
    assert (got["46A"], got["G1"], got["C1"], got["44"], got["9"]) == (10.0, 2.0, 5.0, 5.0, 3.0)


def test_coverage(spark):
    live = store(spark, ("46A", "5", None), ("G1", "", None), ("zz", "9", None))
    row = serving.serving_coverage(dims.dim_routes(spark), live).first()
    assert (row.routes, row.covered, row.hit_ratio) == (104, 1, 1 / 104)


def test_latest_per_route_prefers_the_newer_row_of_a_window(spark):
    df = spark.createDataFrame(
        [("7", at("10:00:00"), at("10:05:00"), 1.0, 0), ("7", at("10:00:00"), at("10:05:00"), 2.0, 1), ("7", at("09:00:00"), at("09:05:00"), 3.0, 1)],
        "route_id string, window_start timestamp_ntz, window_end timestamp_ntz, average_delay_seconds double, fresh int",
    )
    assert rows(serving.latest_per_route(df, "fresh")) == [("7", at("10:00:00"), at("10:05:00"), 2.0)]


def test_lambda_view_keeps_both_sides(spark):
    lake = spark.createDataFrame([("7", 10.0), (None, 1.0)], "route_id string, average_delay_seconds double")
    live = spark.createDataFrame([("7", 25.0, at("10:05:00")), ("8", 5.0, at("10:05:00"))], "route_id string, average_delay_seconds double, window_end timestamp_ntz")
    got = serving.lambda_view(history.route_history(lake), live)
    found = {r.route_id: (r.historical_avg_delay, r.live_delay, r.live_minus_historical) for r in got.collect()}
    assert found == {"7": (10.0, 25.0, 15.0), "8": (None, 5.0, None), None: (1.0, None, None)}


def test_board_row(spark):
    live = store(spark, ("46A", '{"average_delay_seconds":210}', None))
    merged = serving.merge_layers(dims.dim_routes(spark), live, dims.dim_baselines(spark))
    now = F.lit("2024-01-30 22:54:10").cast("timestamp_ntz")
    got = board.arrival_board(merged, now)
    row = board.one_route(got, "46A").first()
    assert tuple(row) == ("46A", 4, "HEAVY DELAY (+4 MINS)", "red", "00:00", "00:04", 9)
    assert got.count() == 104
    assert got.where("delay_mins < 0 or delay_mins > 15 or next_arrival_mins < 1").count() == 0


def test_profile_has_every_hour(spark):
    df = telemetry(spark, ("46A", 600, at("08:10:00")), ("46A", 661, at("08:20:00")), ("46A", -100, at("09:20:00")), ("zz", 60, at("08:00:00")))
    merged = serving.merge_layers(dims.dim_routes(spark), store(spark), dims.dim_baselines(spark))
    got = board.known_profile(df, merged, dims.dim_routes(spark))
    assert got.count() == 104 * 24
    mine = {r.hour_label: (r.delay_mins, r.peak) for r in got.where("route = '46A'").collect()}
    assert (mine["08:00"], mine["09:00"], mine["10:00"]) == ((10, True), (1, True), (4, False))


def test_vehicles_on_paths(spark):
    routes = spark.createDataFrame([("G1",), ("9",)], "route string")
    paths = board.route_path(routes, dims.dim_paths(spark), dims.DEFAULT_PATH)
    assert {r.route: len(r.path) for r in paths.collect()} == {"G1": 5, "9": 4}
    placed = rows(board.place_vehicles(paths, dims.dim_vehicles(spark)))
    assert len(placed) == 6
    assert placed[0] == ("9", "Bus-9-101", -6.27, 53.348, "22 km/h", "On Schedule")
    assert placed[5] == ("G1", "Bus-G1-103", -6.26, 53.349, "0 km/h (At Stop)", "At Bus Stop")
    assert board.path_points(paths).count() == 9


# ---- monitoring, retention, topics --------------------------------------


def test_rates(spark):
    df = telemetry(spark, *[("7", 1, at(f"10:00:{s:02d}")) for s in range(30)], ("7", 1, at("10:01:00")))
    rates = monitor.ingest_rate(df)
    assert rows(rates) == [(at("10:00:00"), 30, 0.5), (at("10:01:00"), 1, 1 / 60)]
    assert tuple(monitor.ingest_peak(rates).first()) == (0.5, at("10:00:00"), 31, 2)


def test_exact_percentiles(spark):
    df = spark.range(1, 101).select(F.lit("x").alias("layer"), F.col("id").alias("latency_seconds"))
    assert tuple(monitor.latency_exact(df).first()) == ("x", 50, 95, 99, 100, 100)


def test_seconds_between(spark):
    df = spark.range(1).select(monitor.seconds_between(F.lit("2024-01-01 00:00:00").cast("timestamp"), F.lit("2024-01-01 00:01:30").cast("timestamp")))
    assert df.first()[0] == 90


def test_footprint_counts_what_lies_on_disk(spark, folder):
    from pathlib import Path

    df = telemetry(spark, *[(str(i), 1, at("10:00:00", day=1 + i % 3)) for i in range(30)])
    sinks.write_table(df, f"{folder}/t", "ts")
    got = monitor.lake_footprint(spark.read.parquet(f"{folder}/t")).collect()
    assert len(got) == 3
    for r in got:
        on_disk = list(Path(f"{folder}/t/event_date={r.event_date}").glob("*.parquet"))
        assert (r.files, r.bytes, r.rows) == (len(on_disk), sum(p.stat().st_size for p in on_disk), 10)


def sized(spark, *data):
    return spark.createDataFrame(list(data), "ts timestamp_ntz, bytes bigint")


def kept(df, **rules):
    now = F.lit("2024-01-02 00:10:00").cast("timestamp_ntz")
    return sorted(r.ts for r in retention.retain_recent(df, now, **rules).collect())


def test_retention_by_age_takes_whole_segments(spark):
    old, edge, young = at("23:59:59"), at("00:00:30", 2), at("00:01:00", 2)
    df = sized(spark, (old, 1), (edge, 1), (young, 1))
    assert kept(df, max_bytes=None) == [edge, young]
    assert kept(df, max_age="9 minutes", max_bytes=None) == [edge, young]
    assert kept(df, max_age="8 minutes", max_bytes=None) == []


def test_retention_by_size_may_exceed_by_less_than_a_segment(spark):
    times_ = [at("23:50:00"), at("23:58:00"), at("00:00:00", 2), at("00:04:00", 2)]
    df = sized(spark, *[(t, 40) for t in times_])
    assert kept(df, max_age=None, max_bytes=80) == times_[2:]
    assert kept(df, max_age=None, max_bytes=81) == times_[1:]
    assert kept(df, max_age=None, max_bytes=40) == times_[3:]
    assert kept(df, max_age=None, max_bytes=10_000) == times_


def test_topics_are_matched_whole(spark):
    df = spark.createDataFrame([("bus", "a"), ("bus-2", "b"), ("tram", "c")], "topic string, value string")
    assert rows(topics.route_topics(df, "bus")) == [("A.bus", "a")]
    assert rows(topics.route_topics(df, alias="B"))[2] == ("B.tram", "c")


def test_topic_options():
    assert topic_source.topic_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "startingOffsets": "latest", "subscribe": "t",
    }
    both = topic_source.topic_options("h:1", pattern="a.*", starting="earliest", min_partitions=64)
    assert both["subscribePattern"] == "a.*" and both["minPartitions"] == "64"
    with pytest.raises(ValueError):
        topic_source.topic_options("h:1")
    assert sinks.sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}
    assert sinks.sink_options("h:1") == {"kafka.bootstrap.servers": "h:1"}


def test_topic_rows(spark):
    df = spark.createDataFrame([("7", 5, None)], "route_id string, delay_seconds int, note string")
    assert topics.to_topic_rows(df).first().value == '{"route_id":"7","delay_seconds":5,"note":null}'
