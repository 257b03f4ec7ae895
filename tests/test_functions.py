"""Golden values of the column expressions (edge rows of FIXTURES.md)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from headway.functions import delays, numbers, text, times


def value(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def lit(x, kind="string"):
    return F.lit(x).cast(kind)


def ntz(text_):
    return F.lit(text_).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "route, digits, full",
    [
        ("Route_46A", "46A", "46A"),
        ("5398_96210", "5398", "5398"),
        ("60-123-b12-1", "60", "60"),
        ("Route_G1", "1", "G1"),
        ("Route_X25", "25", "X25"),
        ("x", "", ""),
        (None, None, None),
    ],
)
def test_route_code(spark, route, digits, full):
    assert value(spark, text.route_code(lit(route))) == digits
    assert value(spark, text.route_code(lit(route), "full")) == full


def test_codes_of_the_network_collide_as_known(spark):
    from headway.sources.dims import dim_routes

    codes = dim_routes(spark).select("route", text.route_code(F.col("route")).alias("code"))
    assert codes.count() == 104
    assert codes.where("route <> code").count() == 21
    assert codes.select("code").distinct().count() == 92


def test_strip_takes_any_white_space(spark):
    assert value(spark, text.strip(lit(" \t 1\t5 \r\n"))) == "1\t5"


def test_split_pair_at_the_first_tab(spark):
    key, val = text.split_pair(lit("a\tb\tc"))
    assert (value(spark, key), value(spark, val)) == ("a", "b\tc")
    key, val = text.split_pair(lit("a"))
    assert (value(spark, key), value(spark, val)) == ("a", None)


def test_labels(spark):
    assert value(spark, text.route_label(lit("46A"))) == "Route_46A"
    assert value(spark, text.vehicle_label(lit("G1"), lit("101"))) == "Bus-G1-101"
    assert value(spark, text.live_key(lit("G1"))) == "live:Route_G1"
    assert value(spark, text.fallback_key(lit("G1"))) == "route:G1:delay"


def test_first_present_element_and_lookup(spark):
    assert value(spark, text.first_present(lit(""), lit("b"))) == "b"
    assert value(spark, text.first_present(lit(None), lit(""))) is None
    points = F.array(F.lit(1.5), F.lit(2.5))
    assert value(spark, text.element(points, 1)) == 2.5
    assert value(spark, text.element(points, 2)) is None
    table = F.create_map(F.lit("46A"), F.lit(4.0))
    assert value(spark, text.lookup(table, lit("46A"), 3.0)) == 4.0
    assert value(spark, text.lookup(table, lit("9"), 3.0)) == 3.0


@pytest.mark.parametrize(
    "raw, want",
    [
        ("5", 5.0),
        (" -1.5e2 ", -150.0),
        (".5", 0.5),
        ("5.", 5.0),
        ("inf", math.inf),
        ("5d", None),
        ("0x10", None),
        ("x", None),
        ("", None),
        (None, None),
    ],
)
def test_to_double(spark, raw, want):
    assert value(spark, numbers.to_double(lit(raw))) == want


def test_to_whole(spark):
    assert value(spark, numbers.to_whole(lit("-7.9"))) == -7
    assert value(spark, numbers.to_whole(lit("1e30"))) is None
    assert value(spark, numbers.to_whole(lit("nan"))) is None


@pytest.mark.parametrize("x, want", [(2.675, 2.68), (-2.675, -2.68), (2.5, 2.5)])
def test_round2(spark, x, want):
    assert value(spark, numbers.round2(F.lit(x))) == want


@pytest.mark.parametrize("x, want", [(2.5, 2), (3.5, 4), (0.5, 0), (14.51, 15)])
def test_whole_minutes(spark, x, want):
    assert value(spark, numbers.whole_minutes(F.lit(x))) == want


@pytest.mark.parametrize("x, want", [(-5.0, 0.0), (16.7, 15.0), (math.nan, 0.0), (3.2, 3.2)])
def test_clamp_minutes(spark, x, want):
    assert value(spark, numbers.clamp_minutes(F.lit(x))) == want


def test_clamp_delay_and_mean(spark):
    assert value(spark, numbers.clamp_delay(F.lit(2500.0))) == 1800
    assert value(spark, numbers.clamp_delay(F.lit(-900.0), lo=-120)) == -120
    assert value(spark, numbers.mean_of(lit(None, "bigint"), F.lit(0))) is None
    assert value(spark, numbers.mean_of(F.lit(7), F.lit(2))) == 3.5


@pytest.mark.parametrize(
    "raw, want",
    [
        ('{"average_delay_seconds":120.0}', 2.0),
        ('{"average_delay_seconds":"90"}', 1.5),
        ('{"average_delay_seconds":true}', 1 / 60),
        ('{"average_delay_seconds":null}', 3.0),
        ('{"average_delay_seconds":"abc"}', 3.0),
        ('{"x":1}', 3.0),
        ("45", 0.75),
        ("30", 30.0),
        ("31", 31 / 60),
        ('"45"', 0.75),
        ("true", 1.0),
        ("null", 3.0),
        ("[1]", 3.0),
        ("abc", 3.0),
        ("-5", -5.0),
        ("1e3", 1000 / 60),
        ("inf", math.inf),
        ("", 3.0),
        (None, 3.0),
        ('\n {"average_delay_seconds":120.0}', 2.0),
        ('{"average_delay_seconds": Infinity}', math.inf),
    ],
)
def test_live_minutes(spark, raw, want):
    got = value(spark, delays.live_minutes(lit(raw), F.lit(3.0)))
    assert got == pytest.approx(want, rel=1e-12)


def test_live_nan_becomes_zero_and_second_key_counts(spark):
    minutes = delays.live_minutes(lit("nan"), F.lit(3.0))
    assert value(spark, numbers.clamp_minutes(minutes)) == 0.0
    inside = delays.live_minutes(lit('{"average_delay_seconds": NaN}'), F.lit(3.0))
    assert value(spark, numbers.clamp_minutes(inside)) == 0.0
    assert value(spark, delays.live_minutes(text.first_present(lit(""), lit("120")), F.lit(3.0))) == 2.0


@pytest.mark.parametrize(
    "minutes, status, level",
    [
        (0, "ON TIME", "green"),
        (1, "ON TIME", "green"),
        (2, "MINOR DELAY (+2 MINS)", "yellow"),
        (3, "MINOR DELAY (+3 MINS)", "yellow"),
        (4, "HEAVY DELAY (+4 MINS)", "red"),
    ],
)
def test_status(spark, minutes, status, level):
    assert value(spark, delays.status_text(F.lit(minutes))) == status
    assert value(spark, delays.delay_level(F.lit(minutes))) == level


@pytest.mark.parametrize(
    "departure, arrival, want",
    [(None, None, 0), (None, 60, 60), (30, 60, 30), ("unset", 60, 0), (None, "unset", 0)],
)
def test_stop_delay_goes_by_presence(spark, departure, arrival, want):
    def event(x):
        if x is None:
            return F.lit(None).cast("struct<delay:int>")
        return F.struct(F.lit(None if x == "unset" else x).cast("int").alias("delay"))

    assert value(spark, delays.stop_delay(event(departure), event(arrival))) == want


@pytest.mark.parametrize(
    "now, slot",
    [
        ("2024-01-30 10:20:00", dt.datetime(2024, 1, 30, 10, 30)),
        ("2024-01-30 10:51:09", dt.datetime(2024, 1, 30, 11, 0)),
        ("2024-01-30 23:59:59", dt.datetime(2024, 1, 31, 0, 0)),
    ],
)
def test_next_slot(spark, now, slot):
    assert value(spark, times.next_slot(ntz(now))) == slot


def test_next_slot_follows_the_wall_clock_of_odd_zones(spark):
    local = times.local_time(ntz("2024-01-30 10:20:00"), "+05:45")
    assert value(spark, times.next_slot(local)) == dt.datetime(2024, 1, 30, 16, 10)


def test_local_time_and_labels(spark):
    local = times.local_time(ntz("2024-01-30 23:30:00"))
    assert value(spark, local) == dt.datetime(2024, 1, 31, 0, 30)
    assert value(spark, times.clock(local)) == "00:30"
    assert value(spark, times.hour_label(F.lit(7))) == "07:00"
    assert value(spark, times.as_text(local)) == "2024-01-31 00:30:00"
    assert [value(spark, times.is_peak(F.lit(h))) for h in (6, 7, 9, 10, 16, 17, 19, 20)] == [
        False, True, True, False, False, True, True, False,
    ]


def test_minutes_until(spark):
    start = ntz("2024-01-30 10:20:30")
    assert value(spark, times.minutes_until(start, ntz("2024-01-30 10:32:00"))) == 11
    assert value(spark, times.minutes_until(start, ntz("2024-01-30 10:20:40"))) == 1


@pytest.mark.parametrize(
    "raw, want",
    [
        ("1704067200", dt.datetime(2024, 1, 1)),
        ("1704067200.25", dt.datetime(2024, 1, 1, 0, 0, 0, 250000)),
        ("2024-01-01 00:00:05", dt.datetime(2024, 1, 1, 0, 0, 5)),
        ("yesterday", None),
        (None, None),
    ],
)
def test_event_time(spark, raw, want):
    assert value(spark, times.event_time(lit(raw)).cast("timestamp_ntz")) == want


def test_now_is_an_epoch(spark):
    assert value(spark, times.now_epoch()) > 1_700_000_000


@pytest.mark.parametrize("seconds", ["1e14", "1704067200000", "1704067200000000", "-99999999999999", "nan", "inf", "1e300"])
def test_epochs_no_calendar_has_are_null(spark, seconds):
    assert value(spark, times.event_time(lit(seconds))) is None


def test_first_and_last_second_of_the_calendar(spark):
    for second in (times.FIRST_SECOND, times.LAST_SECOND):
        assert value(spark, F.year(times.event_time(lit(str(second))))) in (1, 9999)
