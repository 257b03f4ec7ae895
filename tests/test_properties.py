"""Random inputs against brute force in plain Python."""

import datetime as dt
import math
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.functions import delays, numbers, text
from headway.operators import history, monitor, retention, serving, windows

START = dt.datetime(2024, 1, 1)
FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

telemetry_rows = st.lists(
    st.tuples(st.sampled_from("ABC"), st.integers(-300, 3600), st.integers(0, 3000)), min_size=1, max_size=60
)


def frame(spark, data):
    made = [(r, d, START + dt.timedelta(seconds=s)) for r, d, s in data]
    return spark.createDataFrame(made, "route_id string, delay_seconds int, ts timestamp_ntz")


@FEW
@given(telemetry_rows)
def test_sliding_average_by_brute_force(spark, data):
    groups = defaultdict(list)
    for route, delay, second in data:
        for back in range(5):
            groups[route, START + dt.timedelta(minutes=second // 60 - back)].append(delay)
    want = {k: sum(v) / len(v) for k, v in groups.items()}
    for via in ("panes", "expand"):
        got = windows.sliding_avg(frame(spark, data), via=via).collect()
        assert {(r.route_id, r.window_start): r.average_delay_seconds for r in got} == want
    assert sum(len(v) for v in groups.values()) == 5 * len(data)


@FEW
@given(telemetry_rows)
def test_newest_pane_is_the_newest_window(spark, data):
    df = frame(spark, data)
    slow = serving.latest_per_route(windows.sliding_avg(df))
    fast = serving.latest_from_panes(windows.pane_sums(df)).select(*slow.columns)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))


def test_a_third_of_all_rows_in_one_group(spark):
    """One route and minute with a third of the rows: same results, a row per key and task."""
    hot = F.col("id") % 3 == 0
    minute = F.when(hot, 0).otherwise(F.col("id") % 500)
    df = spark.range(0, 300_000, 1, 16).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 50)).alias("route_id"),
        (F.col("id") % 1000).cast("int").alias("delay_seconds"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), minute.cast("int"))).alias("ts"),
    )
    got = windows.sliding_avg(df).where("route_id = 'hot'").collect()
    delays_ = [i % 1000 for i in range(0, 300_000, 3)]
    assert len(got) == 5 and {r.average_delay_seconds for r in got} == {sum(delays_) / len(delays_)}
    assert serving.latest_from_panes(windows.pane_sums(df)).count() == df.select("route_id").distinct().count()


@FEW
@given(telemetry_rows)
def test_panes_lose_no_row(spark, data):
    panes = windows.pane_sums(frame(spark, data)).agg(F.sum("delay_count"), F.sum("delay_sum")).first()
    assert tuple(panes) == (len(data), sum(d for _, d, _ in data))


@FEW
@given(
    st.lists(st.tuples(st.integers(0, 4000), st.integers(1, 50)), min_size=1, max_size=40),
    st.integers(1, 600),
    st.integers(1, 60),
)
def test_retention_by_brute_force(spark, data, limit, age):
    df = spark.createDataFrame([(START + dt.timedelta(minutes=m), b) for m, b in data], "ts timestamp_ntz, bytes bigint")
    now = START + dt.timedelta(minutes=max(m for m, _ in data))
    segs = defaultdict(list)
    for m, b in data:
        segs[m // 2].append((m, b))
    left = dict(sorted(segs.items()))
    for s in list(left):  # from the oldest end
        if START + dt.timedelta(minutes=max(m for m, _ in left[s])) < now - dt.timedelta(minutes=age):
            del left[s]
        else:
            break
    for s in list(left):
        if sum(b for k, rows in left.items() if k != s for _, b in rows) >= limit:
            del left[s]
        else:
            break
    want = sorted(m for rows in left.values() for m, _ in rows)
    got = retention.retain_recent(df, F.lit(now), max_age=f"{age} minutes", max_bytes=limit)
    assert sorted(int((r.ts - START).total_seconds() // 60) for r in got.collect()) == want


@FEW
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 300)), min_size=1, max_size=80))
def test_exact_percentiles_by_brute_force(spark, data):
    df = spark.createDataFrame(data, "layer string, latency_seconds bigint")
    for r in monitor.latency_exact(df).collect():
        values = sorted(v for layer, v in data if layer == r.layer)
        for name, share in monitor.SHARES.items():
            assert r[name] == values[math.ceil(share * len(values)) - 1]


def python_live(raw, baseline):
    """The stated rule for a stored value, in plain Python."""
    import json

    def scalar(x):
        return x / 60.0 if x > 30 else x

    try:
        found = json.loads(raw)
        if isinstance(found, dict):
            return float(found.get("average_delay_seconds", baseline * 60)) / 60.0
        return scalar(float(found))
    except (ValueError, TypeError):
        try:
            return scalar(float(raw))
        except ValueError:
            return baseline


stored = st.one_of(
    st.integers(-100, 2000).map(str),
    st.floats(-100, 2000, allow_nan=False).map(repr),
    st.integers(-100, 2000).map(lambda n: f'{{"average_delay_seconds": {n}}}'),
    st.floats(0, 900).map(lambda x: f'{{"route": "7", "average_delay_seconds": "{x!r}"}}'),
    st.sampled_from(['"45"', "[45]", "{}", '{"a":1}', "null", "abc", "nan", "-inf", " 40 ", "{45", "true"]),
)


@FEW
@given(st.lists(stored, min_size=1, max_size=40))
def test_live_values_follow_the_rule(spark, data):
    df = spark.createDataFrame(list(enumerate(data)), "i int, raw string")
    minutes = numbers.clamp_minutes(delays.live_minutes(F.col("raw"), F.lit(3.0)))
    for r in df.select("i", "raw", minutes.alias("m")).collect():
        want = max(0.0, min(python_live(r.raw, 3.0), 15.0))
        assert math.isclose(r.m, want, rel_tol=1e-12), r.raw


@FEW
@given(st.lists(st.floats(-1e6, 1e6).map(lambda x: round(x, 3)), min_size=1, max_size=50))
def test_route_average_by_brute_force(spark, data):
    from decimal import ROUND_HALF_UP, Decimal

    df = spark.createDataFrame([("7", x) for x in data], "route_id string, average_delay_seconds double")
    mean = df.coalesce(1).agg(F.avg("average_delay_seconds")).first()[0]
    got = history.route_history(df.coalesce(1)).first().historical_avg_delay
    assert got == float(Decimal(repr(mean)).quantize(Decimal("0.01"), ROUND_HALF_UP))


@FEW
@given(st.lists(st.text(st.sampled_from("AGXaz019_- "), max_size=8), min_size=1, max_size=50))
def test_route_codes_by_brute_force(spark, data):
    import re

    df = spark.createDataFrame([(x,) for x in data], "raw string")
    for r in df.select("raw", text.route_code(F.col("raw")).alias("code")).collect():
        found = re.search(r"\d+[a-zA-Z]?", r.raw)
        assert r.code == (found.group(0) if found else "")
