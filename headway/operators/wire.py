"""Feed messages in protobuf wire format to stop updates, without Spark's protobuf module.

``mapInArrow`` hands over batches of messages; all messages of a part are read in
lockstep, one field of each per step, with numpy. Only the fields the stop updates
need are looked into; unknown ones are passed over. Of a field that should be there
once, the last one counts. A message that ends inside a field, or holds a field of a
kind the format does not have (or the groups it has given up), is broken: none of its
stop updates is taken, and it comes out once with its ``problem``. Ids that are no
UTF-8 get replacement characters. An empty message has no stop updates.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .feed import feed_payload

# Field numbers of the public feed format, by message.
HEADER, ENTITY = 1, 2
HEADER_TIMESTAMP = 3
TRIP_UPDATE = 3
TRIP, STOP_TIME_UPDATE = 1, 2
TRIP_ID, ROUTE_ID = 1, 5
ARRIVAL, DEPARTURE, STOP_ID = 2, 3, 4
DELAY = 1

# Wire types.
VARINT, EIGHT, BYTES, FOUR = 0, 1, 2, 5

#: Bytes of messages read in one step.
PART_BYTES = 8 << 20

STOPS = (
    "poll_ts bigint, trip struct<route_id: string, trip_id: string>, "
    "stop struct<stop_id: string, departure: struct<delay: int>, arrival: struct<delay: int>>"
)


class Fields(NamedTuple):
    """Fields of many messages, by owner and then in the order of the message."""

    owner: np.ndarray
    number: np.ndarray
    kind: np.ndarray
    value: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    def of(self, number: int, kind: int) -> Fields:
        some = (self.number == number) & (self.kind == kind)
        return Fields(*(column[some] for column in self))

    def last(self, n: int) -> np.ndarray:
        """Place of each owner's last field; -1 for an owner without any."""
        place = np.full(n, -1)
        place[self.owner] = np.arange(len(self.owner))
        return place


def varints(raw: np.ndarray, at: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The variable-length numbers at many places, the places behind them, and whether each is whole."""
    value, end, whole = np.zeros(len(at), np.uint64), at.copy(), np.zeros(len(at), bool)
    live = np.arange(len(at))
    for k in range(10):
        live = live[end[live] < stop[live]]
        if not len(live):
            break
        byte = raw[end[live]]
        value[live] |= (byte & 127).astype(np.uint64) << np.uint64(7 * k)
        end[live] += 1
        whole[live[byte < 128]] = True
        live = live[byte >= 128]
    return value, end, whole


def fields(raw: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[Fields, np.ndarray]:
    """All fields of the messages ``raw[start:stop]``, and which of the messages are broken."""
    at, broken = start.copy(), np.zeros(len(start), bool)
    steps = [[np.zeros(0, np.int64)] * 6]
    live = np.flatnonzero(at < stop)
    while len(live):
        limit = stop[live]
        tag, begin, good = varints(raw, at[live], limit)
        number, kind = (tag >> np.uint64(3)).astype(np.int64), (tag & np.uint64(7)).astype(np.int64)
        value, behind, whole = varints(raw, begin, limit)
        long = kind == BYTES
        good &= (number > 0) & np.isin(kind, (VARINT, EIGHT, BYTES, FOUR)) & (whole | ~np.isin(kind, (VARINT, BYTES)))
        begin = np.where(long, behind, begin)
        size = np.where(long, np.minimum(value, np.uint64(len(raw) + 1)).astype(np.int64), 0)
        size = np.where(kind == EIGHT, 8, np.where(kind == FOUR, 4, size))
        end = np.where(kind == VARINT, behind, begin + size)
        good &= end <= limit
        broken[live[~good]] = True
        steps.append([c[good] for c in (live, number, kind, value.view(np.int64), begin, end)])
        live, end = live[good], end[good]
        at[live] = end
        live = live[end < stop[live]]
    columns = [np.concatenate(c) for c in zip(*steps)]
    order = np.argsort(columns[0], kind="stable")
    return Fields(*(c[order] for c in columns)), broken


def _text(raw: np.ndarray, found: Fields, at: np.ndarray) -> pa.Array:
    """The bytes of fields as text; ``at`` -1: NULL."""
    there = at >= 0
    begin, end = np.where(there, found.begin[at], 0) if len(found.begin) else 0 * at, np.zeros_like(at)
    end[there] = found.end[at[there]]
    size = end - begin
    offsets = np.concatenate([[0], np.cumsum(size)])
    picked = raw[np.repeat(begin - offsets[:-1], size) + np.arange(offsets[-1])]
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(picked)]
    made = pa.Array.from_buffers(pa.binary(), len(at), buffers)
    made = pa.compute.if_else(pa.array(there), made, pa.scalar(None, pa.binary()))
    try:
        return made.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([None if x is None else x.decode(errors="replace") for x in made.to_pylist()], pa.string())


def _number(found: Fields, at: np.ndarray, kind: pa.DataType) -> pa.Array:
    value = found.value[at] if len(found.value) else 0 * at
    return pa.array(value.astype(kind.to_pandas_dtype()), kind, mask=at < 0)


def _inner(raw: np.ndarray, outer: Fields) -> tuple[Fields, np.ndarray]:
    return fields(raw, outer.begin, outer.end)


def stop_updates(raw: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, list[pa.Array], np.ndarray]:
    """Message number, and the columns of ``STOPS``, of each stop update; and the broken messages."""
    n = len(start)
    top, broken = fields(raw, start, stop)

    def blame(bad: np.ndarray, messages: np.ndarray) -> None:
        broken[messages[bad]] = True

    header = top.of(HEADER, BYTES)
    head, bad = _inner(raw, header)
    blame(bad, header.owner)
    stamp = head.of(HEADER_TIMESTAMP, VARINT)
    stamp = stamp._replace(owner=header.owner[stamp.owner])

    entity = top.of(ENTITY, BYTES)
    inside, bad = _inner(raw, entity)
    blame(bad, entity.owner)
    update = inside.of(TRIP_UPDATE, BYTES)
    last = update.last(len(entity.owner))  # one for each entity
    update = Fields(*(c[last[last >= 0]] for c in update))
    message = entity.owner[update.owner]
    parts, bad = _inner(raw, update)
    blame(bad, message)

    trip = parts.of(TRIP, BYTES)
    named, bad = _inner(raw, trip)
    blame(bad, message[trip.owner])
    named = named._replace(owner=trip.owner[named.owner])  # by update
    stops = parts.of(STOP_TIME_UPDATE, BYTES)
    told, bad = _inner(raw, stops)
    blame(bad, message[stops.owner])
    rows = len(stops.owner)

    def event(number: int) -> pa.Array:
        outer = told.of(number, BYTES)
        inner, bad = _inner(raw, outer)
        blame(bad, message[stops.owner[outer.owner]])
        delay = inner.of(DELAY, VARINT)
        delay = delay._replace(owner=outer.owner[delay.owner])
        present = outer.last(rows) >= 0
        values = _number(delay, delay.last(rows), pa.int32())
        return pa.StructArray.from_arrays([values], ["delay"], mask=pa.array(~present))

    def trip_text(number: int) -> pa.Array:
        found = named.of(number, BYTES)
        return _text(raw, found, found.last(len(message))[stops.owner])

    departure, arrival = event(DEPARTURE), event(ARRIVAL)
    ids = told.of(STOP_ID, BYTES)
    owner = message[stops.owner]
    columns = [
        _number(stamp, stamp.last(n)[owner], pa.int64()),
        pa.StructArray.from_arrays([trip_text(ROUTE_ID), trip_text(TRIP_ID)], ["route_id", "trip_id"]),
        pa.StructArray.from_arrays([_text(raw, ids, ids.last(rows)), departure, arrival], ["stop_id", "departure", "arrival"]),
    ]
    return owner, columns, broken


def _parts(size: np.ndarray) -> Iterator[slice]:
    """Runs of messages of at most ``PART_BYTES``, or of one message."""
    total, at = np.concatenate([[0], np.cumsum(size)]), 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(total, total[at] + PART_BYTES, side="right")) - 1)
        yield slice(at, to)
        at = to


def _read(batch: pa.RecordBatch, keep: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    values = batch["_message"].cast(pa.large_binary())
    sizes = pa.compute.fill_null(pa.compute.binary_length(values), 0).to_numpy(zero_copy_only=False)
    for part in _parts(sizes):
        rows = batch.slice(part.start, part.stop - part.start)
        here = values.slice(part.start, part.stop - part.start)
        missing = here.is_null().to_numpy(zero_copy_only=False)
        raw = np.frombuffer(b"".join(x or b"" for x in here.to_pylist()), np.uint8)
        stop = np.cumsum(sizes[part])
        owner, columns, broken = stop_updates(raw, stop - sizes[part], stop)
        good = ~broken[owner]
        owner, mask = owner[good], pa.array(good)
        bad = np.flatnonzero(broken | missing)
        problem = pa.array(np.where(missing[bad], "no message", "broken message"), pa.string())
        taken = [rows[c].take(pa.array(np.concatenate([owner, bad]))) for c in keep]
        columns = [pa.concat_arrays([c.filter(mask), pa.nulls(len(bad), c.type)]) for c in columns]
        problem = pa.concat_arrays([pa.nulls(len(owner), pa.string()), problem])
        yield pa.RecordBatch.from_arrays([*taken, *columns, problem], [*keep, "poll_ts", "trip", "stop", "problem"])


def decode_stops(messages: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """A row per stop update of each whole message, and a row with its ``problem`` per other one.

    ``keep`` names columns to carry along. No shuffle, in batch and stream.
    """
    named = messages.select(*keep, F.col(value).alias("_message"))
    schema = StructType(named.schema.fields[:-1] + StructType.fromDDL(STOPS).fields)
    schema = schema.add(StructField("problem", StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _read(batch, keep)

    return named.mapInArrow(run, schema)


def flatten_messages(decoded: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The flat payload of each stop update, as ``feed.flatten_feed`` gives it."""
    return feed_payload(decoded.where(F.col("problem").isNull()), keep)


def broken_messages(decoded: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Quarantine: the kept columns of each message that could not be read, and why."""
    return decoded.where(F.col("problem").isNotNull()).select(*keep, "problem")
