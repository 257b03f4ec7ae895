"""Transit-shaped views of the given tables (see FIXTURES.md).

All but the dimensions read a whole table; rows are derived one by one, so a
view adds neither a shuffle nor a size limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import times
from ..operators.clean import clean_telemetry
from ..operators.history import union_lake
from ..operators.serving import latest_from_panes
from ..operators.windows import pane_sums, sliding_avg
from ..sources import dims

# Fixed "now" of the board and of retention: never the clock.
AS_OF = "2024-01-30 22:54:10"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_telemetry(events: DataFrame) -> DataFrame:
    """events as telemetry of routes ``Route_<code>``."""
    user = F.col("user_id")
    route = F.concat(
        F.lit("Route_"),
        F.when(user % 7 == 0, "G").when(user % 7 == 1, "X").otherwise(""),
        (user % 40).cast("string"),
        F.when(user % 3 == 0, "A").otherwise(""),
    )
    delay = F.floor(F.col("value") * 20).cast("int") - 400
    return events.select(
        "event_id", "ts", "event_type", route.alias("route_id"), delay.alias("delay_seconds")
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_telemetry(table(spark, sf_dir, "events"))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_telemetry(telemetry(spark, sf_dir))


def windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliding_avg(cleaned(spark, sf_dir))


def current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_from_panes(pane_sums(cleaned(spark, sf_dir)))


def _quoted(name: str, value) -> F.Column:
    return F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))


def _plain(name: str, value) -> F.Column:
    return F.concat(F.lit(f'"{name}":'), value.cast("string"))


def _object(*parts) -> F.Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def as_payloads(rows: DataFrame) -> DataFrame:
    """telemetry as payload text in all the forms a topic may carry.

    Three of a hundred carry an epoch no calendar has: micro- and milliseconds, and one far back.
    """
    form, far = F.col("event_id") % 10, F.col("event_id") % 100
    epoch = F.unix_seconds(F.col("ts").cast("timestamp"))
    stamp = (
        F.when(far == 10, epoch * 1_000_000)
        .when(far == 20, epoch * 1000)
        .when(far == 30, F.lit(-99_999_999_999_999))
        .otherwise(epoch)
    )
    at = _plain("timestamp", stamp)
    route = _quoted("route_id", F.col("route_id"))
    delay = _plain("delay_seconds", F.col("delay_seconds"))
    payload = (
        F.when(
            form == 1,
            _object(
                route,
                _quoted("timestamp", times.as_text(F.col("ts"))),
                F.concat(delay, F.lit(".0")),
            ),
        )
        .when(form == 2, _object(F.concat(at, F.lit(".5")), route, delay))
        .when(form == 3, "not json")
        .when(form == 4, _object(at, _quoted("route_id", F.lit("depot")), delay))
        .when(form == 5, "[1]")
        .when(form == 6, _object(at, route))
        .when(form == 7, _object(at, route, _quoted("delay_seconds", F.col("delay_seconds").cast("string"))))
        .otherwise(_object(at, route, delay))
    )
    return rows.withColumn("payload", payload)


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_payloads(telemetry(spark, sf_dir)).select("event_id", "event_type", "ts", "payload")


def lake_families(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """raw, windowed and historical lake rows with their own columns."""
    rows = telemetry(spark, sf_dir).withColumn(
        "route_id",
        F.when(F.col("event_id") % 50 == 1, F.lit(None).cast("string"))
        .when(F.col("event_id") % 50 == 2, "")
        .otherwise(F.col("route_id")),
    )
    kind = F.col("event_id") % 4
    raw = rows.where(kind == 0).select("event_id", "route_id", "delay_seconds", "ts")
    start = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    averaged = rows.select(
        "event_id",
        "route_id",
        start.alias("window_start"),
        times.plus_minutes(start, F.lit(5)).alias("window_end"),
        F.col("delay_seconds").cast("double").alias("average_delay_seconds"),
        kind.alias("kind"),
    )
    streamed = averaged.where("kind in (1, 2)").withColumn(
        "route_id", F.regexp_replace("route_id", "^Route_", "")
    )
    return raw, streamed.drop("kind"), averaged.where("kind = 3").drop("kind")


def lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_lake(*lake_families(spark, sf_dir))


def lake_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 as JSON lines: some cut short, blank, of a tab alone, or followed by more text."""
    i = F.col("event_id")
    body = F.to_json(F.struct("route_id", "average_delay_seconds"))
    return lake(spark, sf_dir).select(
        F.when(i % 17 == 0, F.expr("'{\"route_id\":\"1\",\"average_delay_seconds\":5'"))
        .when(i % 38 == 0, "\t")
        .when(i % 19 == 0, "  ")
        .when(i % 23 == 0, F.concat(body, F.lit(" junk")))
        .when(i % 29 == 0, F.concat(body, body))
        .otherwise(body)
        .alias("value")
    )


def lake_json(spark: SparkSession, sf_dir: str, *more: F.Column) -> DataFrame:
    """F3 with all columns (and ``more``) as the lines of lake files; every 17th cut short, every 19th blank."""
    i = F.col("event_id")
    body = F.to_json(
        F.struct(
            *more,
            "route_id",
            F.col("window_start").cast("string").alias("window_start"),
            F.col("window_end").cast("string").alias("window_end"),
            "average_delay_seconds",
            F.col("delay_seconds").cast("double").alias("delay_seconds"),
            F.col("ts").cast("string").alias("timestamp"),
        )
    )
    cut = F.concat(F.lit("{"), F.substr(body, F.lit(2), F.length(body) - 2))
    return lake(spark, sf_dir).select(
        F.when(i % 17 == 0, cut).when(i % 19 == 0, "").otherwise(body).alias("value")
    )


def mixed_lake(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """lines of lake rows, every fifth with a field more, and lines of feed messages."""
    vehicle = F.when(F.col("event_id") % 5 == 0, F.struct(F.col("event_id").alias("id"), F.lit(True).alias("low_floor")))
    messages = feed(spark, sf_dir).select(F.to_json(F.struct("poll_ts", "entity")).alias("value"))
    return lake_json(spark, sf_dir, vehicle.alias("vehicle")), messages


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 for snapshots: batch ``b`` holds the averages over the first ``b + 1`` thirds."""
    rows = cleaned(spark, sf_dir).withColumn(
        "batch_id", F.explode(F.sequence(F.col("event_id") % 3, F.lit(2).cast("bigint")))
    )
    minute = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    return (
        rows.groupBy("batch_id", "route_id", minute.alias("window_start"))
        .agg(F.avg("delay_seconds").alias("average_delay_seconds"))
        .withColumn("window_end", times.plus_minutes(F.col("window_start"), F.lit(1)))
    )


def pair_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``route<TAB>delay`` lines with bad delays, empty keys and missing tabs."""
    i = F.col("event_id")
    key = F.when(i % 21 == 0, "").otherwise(F.col("route_id"))
    delay = F.when(i % 20 == 0, "x").otherwise(F.col("delay_seconds").cast("string"))
    tab = F.when(i % 23 == 0, " ").otherwise("\t")
    return telemetry(spark, sf_dir).select(F.concat(key, tab, delay).alias("value"))


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """telemetry with the poll it came in."""
    return telemetry(spark, sf_dir).withColumn("poll_ts", times.floor_to(F.col("ts"), "30 seconds"))


def live_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the current averages as stored texts, in a form that depends on the route."""
    form = F.col("pos") % 8
    seconds = F.col("average_delay_seconds")
    rows = current(spark, sf_dir).withColumnRenamed("route_id", "route")
    live = (
        # every second object behind a line break
        F.when(F.col("pos") % 16 == 1, F.concat(F.lit("\n"), F.to_json(F.struct("average_delay_seconds"))))
        .when(form == 1, F.to_json(F.struct("average_delay_seconds")))
        .when(form == 2, seconds.cast("string"))
        .when(form == 3, (seconds / 60).cast("string"))
        .when(form == 4, "30")
        .when(form == 5, "abc")
        .when(form == 6, "nan")
        .when(form == 7, "")
    )
    return rows.join(dims.dim_routes(spark), "route").select(
        "route",
        live.alias("live_value"),
        F.when(form == 7, seconds.cast("string")).alias("fallback_value"),
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a feed message per line item, polled on its ship date.

    Two entities, the first without a trip update; the second holds two stop
    updates. Arrays of fixed length per row, so no trip is gathered in one task.
    """
    delay = F.col("l_quantity").cast("int")

    def event(present, value):
        return F.when(present, F.struct(value.cast("int").alias("delay")))

    no_first = F.when(F.col("l_linenumber") > 1, delay)
    leaves, arrives = F.col("l_linestatus") == "O", F.col("l_returnflag") != "N"
    by_part = F.struct(
        F.col("l_partkey").cast("string").alias("stop_id"),
        event(leaves, no_first * 60).alias("departure"),
        event(arrives, delay * 30).alias("arrival"),
    )
    by_supplier = F.struct(
        F.col("l_suppkey").cast("string").alias("stop_id"),
        event(arrives, delay * 20).alias("departure"),
        event(leaves, no_first * 10).alias("arrival"),
    )
    trip = F.struct(
        F.concat_ws("_", F.col("l_suppkey") % 500, "l_partkey").alias("route_id"),
        F.col("l_orderkey").cast("string").alias("trip_id"),
    )
    update = F.struct(trip.alias("trip"), F.array(by_part, by_supplier).alias("stop_time_update"))
    other = F.lit(None).cast(
        "struct<trip:struct<route_id:string,trip_id:string>,stop_time_update:array<struct<"
        "stop_id:string,departure:struct<delay:int>,arrival:struct<delay:int>>>>"
    )
    return table(spark, sf_dir, "lineitem").select(
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("poll_ts"),
        F.array(
            F.struct(other.alias("trip_update")), F.struct(update.alias("trip_update"))
        ).alias("entity"),
        "l_linenumber",
    )


def _varint(n: F.Column) -> F.Column:
    """A number from 0 to 2 ** 35 - 1 in variable length: seven bits a byte, the top bit on all but the last.

    ``n`` is referred to for every byte, so it should be a column of the rows or little more.
    """

    def byte(k: int) -> F.Column:
        left = F.shiftright(n, 7 * k)
        more = F.when(F.shiftright(n, 7 * (k + 1)) > 0, 129).otherwise(1)
        there = F.lit(1) if k == 0 else F.when(left > 0, 1).otherwise(0)
        return F.substring(F.lit(bytes(range(256))), (left.bitwiseAND(F.lit(127)) + more).cast("int"), there)

    short = F.substring(F.lit(bytes(range(128))), n.cast("int") + 1, F.lit(1))
    return F.when(n.between(0, 127), short).otherwise(F.concat(*[byte(k) for k in range(5)]))


def _numbered(field: int, value: F.Column) -> F.Column:
    return F.concat(F.lit(bytes([8 * field])), _varint(value))


def _body(*parts: F.Column) -> F.Column:
    return F.concat(*[F.coalesce(p.cast("binary"), F.lit(b"")) for p in parts])


def _part(field: int, body: str) -> F.Column:
    """A part whose body is a column of its own, as it is used for its length, too."""
    return F.concat(F.lit(bytes([8 * field + 2])), _varint(F.octet_length(body).cast("bigint")), F.col(body))


def _fixed(field: int, body: bytes) -> F.Column:
    return F.lit(bytes([8 * field + 2, len(body)]) + body)


def feed_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the messages of F7 in protobuf wire format, with fields no reader knows.

    The first line item of each order also comes as a copy that lacks its last byte.
    Made from the inside outwards, one step for each level of parts, so that each is worked out once.
    """
    update = F.col("entity")[1]["trip_update"]
    events = {f"{name}{k}": update["stop_time_update"][k][name] for k in range(2) for name in ("arrival", "departure")}
    texts = {f"stop_id{k}": update["stop_time_update"][k]["stop_id"] for k in range(2)}
    texts |= {name: update["trip"][name] for name in ("trip_id", "route_id")}
    rows = feed(spark, sf_dir).select(
        "l_linenumber",
        F.col("poll_ts").cast("bigint").alias("poll_ts"),
        *[e.isNotNull().alias(f"has_{name}") for name, e in events.items()],
        *[e["delay"].cast("bigint").alias(name) for name, e in events.items()],
        *[_body(t).alias(name) for name, t in texts.items()],
        texts["trip_id"].alias("order"),
    )

    def step(rows: DataFrame, **bodies: F.Column) -> DataFrame:
        return rows.withColumns(bodies)

    rows = step(
        rows,
        header=_body(_fixed(1, b"2.0"), _numbered(3, F.col("poll_ts"))),
        **{name: _body(_numbered(1, F.col(name))) for name in events},
    )
    rows = step(
        rows,
        trip=_body(_part(1, "trip_id"), _numbered(9, F.lit(300).cast("bigint")), _part(5, "route_id")),
        **{
            f"stop{k}": _body(
                F.when(F.col(f"has_arrival{k}"), _part(2, f"arrival{k}")),
                F.when(F.col(f"has_departure{k}"), _part(3, f"departure{k}")),
                _part(4, f"stop_id{k}"),
            )
            for k in range(2)
        },
    )
    more = F.lit(b"\x79\x01\x02\x03\x04\x05\x06\x07\x08")
    rows = step(rows, update=_body(_part(1, "trip"), more, _part(2, "stop0"), _part(2, "stop1")))
    rows = step(rows, entity=_body(_fixed(1, b"trip"), _part(3, "update")))
    message = F.concat(
        _part(1, "header"),
        F.lit(b"\x7d\x01\x02\x03\x04"),  # field 15, four bytes
        F.lit(b"\x12\x14\x0a\x07vehicle\x22\x09somewhere"),
        _part(2, "entity"),
    )
    rows = rows.select("order", "l_linenumber", message.alias("value"))
    cut = F.substring("value", F.lit(1), F.octet_length("value") - 1)
    copies = F.when(F.col("l_linenumber") == 1, F.array("value", cut)).otherwise(F.array("value"))
    return rows.select("order", F.explode(copies).alias("value"))


def topic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: payloads by topic, every second one in a schema envelope, every 26th in an empty one."""
    empty = F.lit('{"schema":{"type":"string"},"payload":null}')
    body = F.concat(F.lit('{"schema":{"type":"string"},"payload":'), F.col("payload"), F.lit("}"))
    wrapped = (F.col("event_id") % 2 == 0) & F.col("payload").startswith("{")
    return payloads(spark, sf_dir).select(
        "event_id",
        F.col("event_type").alias("topic"),
        F.when(F.col("event_id") % 26 == 0, empty).when(wrapped, body).otherwise(F.col("payload")).alias("value"),
    )


def latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds from an event to the first output that shows it: the next slide of
    the speed layer, and the nightly run of the batch layer."""
    ts = F.col("ts")
    minute, day = F.date_trunc("minute", ts), F.date_trunc("day", ts)
    outputs = F.array(
        F.struct(F.lit("speed").alias("layer"), (minute + F.expr("INTERVAL 1 MINUTE")).alias("out")),
        F.struct(F.lit("batch").alias("layer"), (day + F.expr("INTERVAL 1 DAY")).alias("out")),
    )
    return (
        table(spark, sf_dir, "events")
        .select(ts, F.explode(outputs).alias("o"))
        .select(
            "o.layer",
            F.date_trunc("hour", ts).alias("hour"),
            F.timestamp_diff("SECOND", ts.cast("timestamp"), F.col("o.out").cast("timestamp")).alias(
                "latency_seconds"
            ),
        )
    )


def sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads with their size, for retention."""
    return payloads(spark, sf_dir).select(
        "event_id", "ts", F.octet_length("payload").cast("bigint").alias("bytes")
    )
