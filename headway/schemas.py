"""Record layouts of topics, lake, feed and serving store."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


# Strict stream dialects: epoch seconds with whole delays, and timestamps with real delays.
TELEMETRY_EPOCH = _struct(
    route_id=StringType(),
    bus_id=StringType(),
    delay_seconds=IntegerType(),
    timestamp=DoubleType(),
)
TELEMETRY_DATED = _struct(
    route_id=StringType(), timestamp=TimestampType(), delay_seconds=DoubleType()
)

# Tolerant dialect: every field as text, typed afterwards.
TELEMETRY_TEXT = _struct(
    route_id=StringType(),
    bus_id=StringType(),
    trip_id=StringType(),
    stop_id=StringType(),
    delay_seconds=StringType(),
    timestamp=StringType(),
)

WINDOWED = _struct(
    route_id=StringType(),
    window_start=StringType(),
    window_end=StringType(),
    average_delay_seconds=DoubleType(),
)

# Every column any lake row family may carry.
LAKE = _struct(
    route_id=StringType(),
    window_start=StringType(),
    window_end=StringType(),
    average_delay_seconds=DoubleType(),
    delay_seconds=DoubleType(),
    timestamp=StringType(),
)

LAKE_LINE = _struct(route_id=StringType(), average_delay_seconds=StringType())

_DELAY = _struct(delay=IntegerType())
_STOP = _struct(stop_id=StringType(), departure=_DELAY, arrival=_DELAY)
_TRIP = _struct(route_id=StringType(), trip_id=StringType())
_ENTITY = _struct(trip_update=_struct(trip=_TRIP, stop_time_update=ArrayType(_STOP)))
FEED = _struct(poll_ts=LongType(), entity=ArrayType(_ENTITY))

LIVE_STORE = _struct(route=StringType(), live_value=StringType(), fallback_value=StringType())

PATH = _struct(route=StringType(), path=ArrayType(ArrayType(DoubleType())))
ROUTE = _struct(pos=IntegerType(), route=StringType())
BASELINE = _struct(route=StringType(), baseline_minutes=DoubleType())
VEHICLE = _struct(pos=IntegerType(), suffix=StringType(), speed=StringType(), status=StringType())
