"""Feed bytes, functions of the session, and the live board, on edge cases."""

import datetime
import random

from pyspark.sql import functions as F

from headway import session
from headway.functions import catalog, delays, text, times
from headway.operators import board, serving, windows, wire
from headway.plans import views
from headway.sources import dims, files
from headway.streaming import runner, sinks
from headway.streaming.runner import ONCE


def varint(n):
    n &= (1 << 64) - 1
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def number(field, n):
    return varint(field << 3) + varint(n)


def part(field, body):
    body = body.encode() if isinstance(body, str) else body
    return varint(field << 3 | 2) + varint(len(body)) + body


def event(field, e):
    """``None``: no event; ``()``: one without a delay."""
    return b"" if e is None else part(field, number(1, e[0]) if e else b"")


def message(stamp, trips):
    out = part(1, part(1, "2.0") + (number(3, stamp) if stamp is not None else b""))
    for route, trip, stops in trips:
        named = b"" if route is None else part(5, route)
        body = part(1, part(1, trip) + named) + b"".join(
            part(2, number(1, 7) + event(2, arrival) + event(3, departure) + part(4, stop)) for stop, departure, arrival in stops
        )
        out += part(2, part(1, "e") + part(3, body)) + part(2, part(1, "v") + part(4, "x")) + varint(90 << 3 | 5) + b"1234"
    return out


def delay(departure, arrival):
    first = arrival if departure is None else departure
    return first[0] if first else 0


def expected(key, stamp, trips):
    return [(key, stamp, route, trip, s, delay(d, a)) for route, trip, stops in trips for s, d, a in stops]


def read(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "key int, value binary").repartition(parts)
    decoded = wire.decode_stops(df, keep=("key",))
    flat = sorted(map(tuple, wire.flatten_messages(decoded, ("key",)).collect()), key=repr)
    return flat, sorted(map(tuple, wire.broken_messages(decoded, ("key",)).collect()))


def random_feed(pick):
    def some_event():
        return pick.choice([None, (), (0,), (-60,), (pick.randrange(-(1 << 31), 1 << 31),)])

    return pick.choice([None, 0, 1 << 33]), [
        (pick.choice([None, "", "5398_1", "é" * 200]), f"t{k}", [(str(j), some_event(), some_event()) for j in range(pick.randrange(5))])
        for k in range(pick.randrange(4))
    ]


def test_messages_of_any_shape(spark, monkeypatch):
    pick, rows, want = random.Random(5), [(0, b"")], []
    for key in range(1, 120):
        stamp, trips = random_feed(pick)
        rows.append((key, message(stamp, trips)))
        want += expected(key, stamp, trips)
    flat, broken = read(spark, rows)
    assert broken == [] and flat == sorted(want, key=repr)
    monkeypatch.setattr(wire, "PART_BYTES", 300)  # many parts, of one message where it is longer
    assert list(map(len, read(spark, rows, 1))) == [len(want), 0]


def test_broken_messages_leave_the_others_alone(spark):
    good = message(9, [("1", "t", [("s", (5,), None)])])
    cuts = {len(part(1, part(1, "2.0") + number(3, 9)))}  # a message may end behind a whole field
    cuts.add(len(good) - 4 - len(varint(90 << 3 | 5)))
    cuts.add(max(cuts) - len(part(2, part(1, "v") + part(4, "x"))))
    rows = [(k, good[:k]) for k in range(1, len(good))]
    rows += [(1000, good), (1001, None), (1002, varint(3) + b"x"), (1003, b"\xff" * 11), (1004, varint(1 << 3 | 2) + varint(1 << 63))]
    rows += [(1005, varint(0) + varint(1)), (1006, good + part(2, part(3, part(1, b"\x08"))))]
    flat, broken = read(spark, rows)
    assert {r[0] for r in flat} <= cuts | {1000}
    assert {r[0] for r in flat} >= {1000, max(cuts)}
    want = {k: "broken message" for k in [*range(1, len(good)), *range(1002, 1007)] if k not in cuts} | {1001: "no message"}
    assert dict(broken) == want and len(broken) == len(want)


def test_ids_that_are_no_text(spark):
    flat, broken = read(spark, [(1, message(9, [("1", b"\xff\xfe", [("s", (5,), None)])]))])
    assert broken == [] and flat == [(1, 9, "1", "��", "s", 5)]


def test_no_messages(spark):
    assert read(spark, []) == ([], [])


LINE = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


def plain_bytes(order, stop_part, stop_supplier, line, quantity, flag, status, stamp):
    """F10 for one line item, as a plain loop."""
    n = None if quantity is None else int(quantity)
    first = n if n is not None and line is not None and line > 1 else None

    def told(present, factor, of):
        return (() if of is None else (of * factor,)) if present else None

    leaves, arrives = status == "O", flag is not None and flag != "N"

    def stop(name, departure, arrival):
        return part(2, event(2, arrival) + event(3, departure) + part(4, "" if name is None else str(name)))

    route = "_".join(str(x) for x in (None if stop_supplier is None else stop_supplier % 500, stop_part) if x is not None)
    trip = part(1, part(1, "" if order is None else str(order)) + number(9, 300) + part(5, route))
    stops = stop(stop_part, told(leaves, 60, first), told(arrives, 30, n))
    stops += stop(stop_supplier, told(arrives, 20, n), told(leaves, 10, first))
    out = part(1, part(1, "2.0") + (b"" if stamp is None else number(3, stamp))) + b"\x7d\x01\x02\x03\x04"
    out += part(2, part(1, "vehicle") + part(4, "somewhere"))
    return out + part(2, part(1, "trip") + part(3, trip + b"\x79\x01\x02\x03\x04\x05\x06\x07\x08" + stops))


def test_feed_bytes_of_any_size_are_worked_out_in_compiled_steps(spark, folder):
    rng = random.Random(4)
    rows, want = [], []
    for _ in range(300):
        order = rng.choice([None, 0, 7, 127, 10**12, 2**62])
        place, supplier = rng.choice([None, 3, 200, 2**62]), rng.choice([None, 3, 777, 2**61])
        line, quantity = rng.choice([None, 1, 2]), rng.choice([None, 0.0, 1.0, 12.0, 300.0, 5000.0, 1e6, 3.5e7])
        flag, status = rng.choice([None, "N", "R"]), rng.choice([None, "O", "F"])
        stamp = rng.choice([None, 0, 127, 128, 16383, 16384, 2**21, 2**28, 1_700_000_000, 2**34])
        at = None if stamp is None else datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=stamp)
        rows.append((order, place, supplier, line, quantity, flag, status, at))
        whole = plain_bytes(order, place, supplier, line, quantity, flag, status, stamp)
        name = None if order is None else str(order)
        want += [(name, whole)] + ([(name, whole[:-1])] if line == 1 else [])
    session.prepare(spark)
    spark.createDataFrame(rows, LINE).write.parquet(f"{folder}/lineitem.parquet")
    made = views.feed_bytes(spark, folder)
    found = [(name, bytes(value)) for name, value in made.collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    # Functions over arrays are interpreted, and so are methods too long for Java's compiler.
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_messages_as_a_stream(spark, folder):
    rows = [(k, message(k, [("1", "t", [("s", (k,), None)])])) for k in range(9)] + [(99, b"\x0a")]
    df = spark.createDataFrame(rows, "key int, value binary")
    df.repartition(2).write.parquet(f"{folder}/in")
    source = files.read_table_stream(spark, f"{folder}/in", df.schema, per_trigger=1)
    out = wire.decode_stops(source, keep=("key",))
    query = out.writeStream.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).format("parquet")
    runner.finish(query.start(f"{folder}/out"))
    landed = spark.read.parquet(f"{folder}/out")
    assert sorted(r.delay_seconds for r in wire.flatten_messages(landed).collect()) == list(range(9))
    assert [r.key for r in wire.broken_messages(landed, ("key",)).collect()] == [99]


ROUTES = [None, "", "x", "Route_46A", "5398_96210", "Route_G1", "X25", "60-123-b12-1", "Route_1"]
LIVE = [None, "", '{"average_delay_seconds":120.0}', "45", "30", "31", '"45"', "abc", "nan", '{"x":1}', "-5", "1e3", "[1]",
        '\n{"average_delay_seconds": NaN}', "Infinity", " 7 ", "1d", "null"]


def same(df, *pairs):
    out = df.select(*[F.expr(a).alias(f"a{k}") for k, (a, _) in enumerate(pairs)], *[b.alias(f"b{k}") for k, (_, b) in enumerate(pairs)])
    for row in out.collect():
        n = len(pairs)
        assert repr(row[:n]) == repr(row[n:])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_functions_of_the_session_are_those_of_the_library(spark):
    names = catalog.register(spark)
    assert names == catalog.register(spark)  # again: replaced
    assert {"route_code", "live_minutes", "next_slot", "status_text"} <= set(names)
    same(
        spark.createDataFrame([(x,) for x in ROUTES], "r string"),
        ("route_code(r)", text.route_code(F.col("r"))),
        ("full_route_code(r)", text.route_code(F.col("r"), "full")),
        ("route_label(r)", text.route_label(F.col("r"))),
    )
    same(
        spark.createDataFrame([(x, b) for x in LIVE for b in (3.0, None)], "t string, b double"),
        ("live_minutes(t, b)", delays.live_minutes(F.col("t"), F.col("b"))),
    )
    same(
        spark.createDataFrame([(n,) for n in (None, -2, 0, 1, 2, 3, 4, 15)], "n int"),
        ("status_text(n)", delays.status_text(F.col("n"))),
        ("delay_level(n)", delays.delay_level(F.col("n"))),
    )
    slots = spark.createDataFrame([(x,) for x in ("2024-01-30 10:20:00", "2024-01-30 10:51:09", "2024-12-31 23:59:59")], "t string")
    slots = slots.select(F.col("t").cast("timestamp_ntz").alias("t"))
    same(slots, *[(f"next_slot(t, {n})", times.next_slot(F.col("t"), n)) for n in (5, 10, 30)])


def test_board_goes_on_after_a_restart_and_shows_routes_without_reports(spark, small, folder):
    rows = views.cleaned(spark, small).withColumn("ts", F.col("ts").cast("timestamp"))
    routes, baselines = dims.dim_routes(spark), dims.dim_baselines(spark)
    now = F.lit(views.AS_OF).cast("timestamp_ntz")
    for k in range(2):
        part = rows.where(F.col("event_id") % 2 == k)
        part.write.parquet(f"{folder}/in/part={k}")
        source = files.read_table_stream(spark, f"{folder}/in/*", part.schema)
        query = sinks.keep_board(windows.sliding_avg(source), routes, baselines, f"{folder}/board", f"{folder}/cp", ONCE)
        runner.finish(query)
        so_far = rows.where(F.col("event_id") % 2 <= k)
        current = serving.latest_per_route(windows.sliding_avg(so_far))
        lines = board.live_lines(current, routes, baselines)
        want = board.arrival_board(board.lines_to_merge(lines, routes, baselines), now)
        got = sinks.read_board(spark, f"{folder}/board", routes, baselines, now)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert got.count() == len(dims.ROUTES)
