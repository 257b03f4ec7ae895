"""Document fingerprints from improbable features, kept in chained Bloom filters.

Every window of ``WINDOW`` bytes has an entropy (of its byte counts). In prose the
entropies of windows lie close together, so the further one is from the usual value, the
rarer the window; that is its rank. Of each ``SPAN`` neighbouring windows the rarest (the
leftmost of equals) gets a point, and windows with ``POINTS`` points or more are the
document's features. A text with fewer than ``SPAN`` windows has all windows of ``SHORT`` bytes as
features, a text below that itself, and one whose windows all tie its first window.

A feature's SHA-1 sets five bits of a filter of 2,048; after ``FILL`` different features the
next filter of the chain begins. The fingerprint is the chain in base64. Two filters are
compared by the bits they share, less those expected by chance, as a share of the most
they could have beyond that; each filter of the shorter chain takes its best partner, and
the likeness is the mean by bits set (0 to 1; of chains of one length both directions count).

Choosing features is local: a window's rank depends on its own bytes, its points on the
windows up to ``SPAN`` away. So a long text is worked off in pieces that overlap, and an
edited text shares the features of what was left alone.

The edit: the last quarter of the code points (rounded down) is replaced by the first as
many of the next document, by ascending id (null first), text hash among equal ids; the
next of the last is the first. Rows are range-partitioned in that order along bounds found
from ids and hashes alone; each partition also gets the first row of the next one, so every
text moves once.

Nulls count as the empty text, whose fingerprint is empty; two empty fingerprints are alike
(1), an empty one and another are not (0). Texts of any length are read whole; equal rows
give equal results; an empty table gives an empty result; only the two named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW, SPAN, POINTS, SHORT = 32, 32, 8, 8
BITS, HASHES, FILL = 2048, 5, 160
#: Usual entropy of a window of prose, as a share of the largest one, and the share below which a window says nothing.
USUAL, LEAST = 0.7, 0.1
PIECE = 1 << 22  # bytes of a long text in one go
_SLAB = 1 << 15
_SCALE = 1 << 16
_MOST = 1 << 30


def _weights() -> np.ndarray:
    """c * log2(c) for each count of a byte in a window, as whole numbers, so that running sums are exact."""
    c = np.arange(WINDOW + 1)
    return np.round(c * np.log2(np.maximum(c, 1)) * _SCALE).astype(np.int64)


_GAIN = np.diff(_weights(), prepend=0)  # by the count reached


def ranks(data: np.ndarray) -> np.ndarray:
    """The rank of each window of a byte array, the rarest lowest; windows that say nothing come last."""
    n = len(data) - WINDOW + 1
    ahead = np.ones(len(data), np.uint8)  # equal bytes from here on in a window's reach
    back = np.ones(len(data), np.uint8)
    same = np.empty(_SLAB, bool)
    for low in range(0, len(data), _SLAB):  # so much at a time stays near the processor
        for d in range(1, WINDOW):
            high = min(low + _SLAB, len(data) - d)
            if high > low:
                hit = np.equal(data[low + d : high + d], data[low:high], out=same[: high - low]).view(np.uint8)
                ahead[low:high] += hit
                back[low + d : high + d] += hit
    change = np.zeros(n, np.int64)
    change[0] = _weights()[np.bincount(data[:WINDOW])].sum()
    change[1:] = _GAIN[back[WINDOW:]] - _GAIN[ahead[: n - 1]]
    total = np.cumsum(change)
    full = _weights()[WINDOW]
    share = full - total  # the entropy, times WINDOW and the scale: at most ``full``
    rank = _MOST - np.abs(share - round(USUAL * full))
    rank[share < LEAST * full] = _MOST + 1
    return rank


def _chosen(rank: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The windows with points enough; ``begins`` marks where a span of windows of one text begins."""
    best = (rank << 32) | np.arange(len(rank))
    size = 1
    while size < SPAN:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    winners = best[begins[: len(best)]]
    winners = winners[winners >> 32 <= _MOST] & 0xFFFFFFFF
    return np.flatnonzero(np.bincount(winners, minlength=len(rank)) >= POINTS)


def select(texts: list[bytes], begin: list[int] | None = None) -> list[list[int]]:
    """The places of the features of each text, those before ``begin`` (one of each text) left out.

    Texts are put behind one another; pieces of a long one overlap by what a choice depends on.
    """
    out: list[list[int]] = [[] for _ in texts]
    work, held = [], 0  # (text, first byte, end, first place that counts, end of places)

    def flush() -> None:
        nonlocal held
        data = np.frombuffer(b"".join([texts[k][i:j] for k, i, j, _, _ in work]), np.uint8)
        begins = np.zeros(len(data), bool)
        starts = np.cumsum([0] + [j - i for _, i, j, _, _ in work]).tolist()
        for (_, i, j, _, _), at in zip(work, starts):
            begins[at : at + j - i - WINDOW - SPAN + 2] = True
        places = _chosen(ranks(data), begins)
        cuts = np.searchsorted(places, starts).tolist()
        for (k, i, _, low, high), at, a, b in zip(work, starts, cuts, cuts[1:]):
            found = places[a:b] - at + i
            out[k] += found[(found >= low) & (found < high)].tolist()
        work.clear()
        held = 0

    for k, text in enumerate(texts):
        windows, low = len(text) - WINDOW + 1, begin[k] if begin else 0
        if windows < SPAN:
            out[k] = [*range(max(len(text) - SHORT + 1, min(1, len(text))))]
            continue
        while low < windows:
            high = min(windows, low + PIECE)
            i, j = max(0, low - SPAN + 1), min(len(text), high + SPAN + WINDOW - 2)
            if j - i < SPAN + WINDOW - 1:
                i = j - SPAN - WINDOW + 1
            work.append((k, i, j, low, high))
            held += j - i
            low = high
            if held >= PIECE:
                flush()
    if work:
        flush()
    return out


def _digests(text: bytes, places: list[int]) -> list[bytes]:
    width = WINDOW if len(text) >= WINDOW + SPAN - 1 else SHORT
    return [hashlib.sha1(text[p : p + width]).digest() for p in places]


def _different(features: list[bytes], text: bytes) -> list[bytes]:
    """Each feature once; a text without any (all its windows tie) has its first window."""
    return [*dict.fromkeys(features)] or (_digests(text, [0]) if text else [])


def chains(features: list[list[bytes]]) -> list[np.ndarray]:
    """The filters (rows of bytes) of each text."""
    sizes = [len(f) for f in features]
    words = np.frombuffer(b"".join([x for f in features for x in f]), ">u4").reshape(-1, 5)[:, :HASHES] % BITS
    filters = [-(-n // FILL) for n in sizes]
    ends = np.cumsum(filters)
    within = np.concatenate([np.arange(n) // FILL for n in sizes] or [np.zeros(0, np.int64)])
    row = np.repeat(ends - filters, sizes) + within
    bits = np.zeros((int(sum(filters)), BITS), np.uint8)
    bits[row[:, None], words] = 1
    packed = np.packbits(bits, axis=1)
    return [packed[e - n : e] for e, n in zip(ends.tolist(), filters)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """How much two chains have in common, 0 to 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if a.shape == b.shape and np.array_equal(a, b):
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    other = np.unpackbits(b, axis=1).astype(np.float32)
    set_b = other.sum(axis=1)
    best_a, set_a, best_b = [], [], np.zeros(len(b))
    step = max(1, (1 << 22) // len(b))
    for at in range(0, len(a), step):
        own = np.unpackbits(a[at : at + step], axis=1).astype(np.float32)
        ones = own.sum(axis=1)
        chance = ones[:, None] * set_b / BITS
        most = np.minimum(ones[:, None], set_b)
        score = np.clip((own @ other.T - chance) / np.maximum(most - chance, 1e-9), 0, 1)
        best_a.append(score.max(axis=1))
        set_a.append(ones)
        best_b = np.maximum(best_b, score.max(axis=0))
    out = float(np.average(np.concatenate(best_a), weights=np.concatenate(set_a)))
    return (out + float(np.average(best_b, weights=set_b))) / 2 if len(a) == len(b) else out


@dataclass
class Print:
    """A document with its features and filters."""

    doc_id: int | None
    text: str
    raw: bytes
    places: list[int]
    digests: list[bytes]
    chain: np.ndarray


def _prints(ids: list, texts: list[str]) -> list[Print]:
    raw = [t.encode() for t in texts]
    places = select(raw)
    digests = [_digests(r, p) for r, p in zip(raw, places)]
    made = chains([_different(d, r) for d, r in zip(digests, raw)])
    return [Print(*x) for x in zip(ids, texts, raw, places, digests, made)]


def edited(text: str, other: str) -> tuple[str, int]:
    """The text with its last quarter replaced by the other's beginning, and where that begins."""
    part = len(text) // 4
    kept = text[: len(text) - part]
    return kept + other[:part], len(kept)


def _compare(rows: list[Print], after: list[Print]) -> Iterator[tuple]:
    """The result of each row, given the row after it."""
    pairs = [edited(x.text, y.text) for x, y in zip(rows, after)]
    raw = [t.encode() for t, _ in pairs]
    begin, shared = [], []
    for x, r, (_, kept) in zip(rows, raw, pairs):
        # Choices further than this before the edit are those of the text itself.
        safe = len(x.text[:kept].encode()) - SPAN - WINDOW
        if safe <= 0 or min(len(x.raw), len(r)) < 2 * SPAN + 2 * WINDOW:
            safe = 0
        begin.append(safe)
        shared.append(x.digests[: bisect_left(x.places, safe)])
    places = select(raw, begin)
    made = chains([_different(s + _digests(r, p), r) for s, r, p in zip(shared, raw, places)])
    for x, y, (t, _), chain in zip(rows, after, pairs, made):
        yield x.doc_id, len(x.text), t, _text(x.chain), _text(chain), likeness(x.chain, chain), likeness(x.chain, y.chain)


def _text(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


FIELDS = "doc_id n_chars edited fingerprint edited_fingerprint near_edited near_next".split()
SCHEMA = "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _ordered(rows: DataFrame, parts: int) -> DataFrame:
    """(part, tail, id, hash, doc_id, text): rows in order by part, each part with the first row of the next as its tail."""
    keyed = rows.select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), F.xxhash64("text").alias("hash"), "doc_id", "text"
    )
    # Bounds from ids and hashes alone: the first key of each part, a few numbers per partition.
    keys = keyed.select("id", "hash").repartitionByRange(parts, "id", "hash")
    first = keys.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct("id", "hash")).alias("low"))
    bounds = sorted((x["low"]["id"], x["low"]["hash"]) for x in first.collect())
    if not bounds:
        return keyed.select(F.lit(0).alias("part"), F.lit(False).alias("tail"), "*")
    low_id = np.array([i for i, _ in bounds], np.int64)
    low_hash = np.array([h for _, h in bounds], np.int64)

    @F.pandas_udf("long")
    def place(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        """Twice the part, and one more for a row that is the first of its part."""
        own, h = ids.to_numpy(np.int64), hashes.to_numpy(np.int64)
        before, upto = np.searchsorted(low_id, own, "left"), np.searchsorted(low_id, own, "right")
        part, first = before.copy(), np.zeros(len(own), bool)
        for k in np.unique(before[upto > before]).tolist():  # ids at which a part begins
            here = (before == k) & (upto > before)
            same = low_hash[k : upto[here][0]]
            more = np.searchsorted(same, h[here], "right")
            part[here] += more
            first[here] = (more > 0) & (same[np.maximum(more - 1, 0)] == h[here])
        return pd.Series((part - 1) * 2 + first)

    n = len(bounds)
    at = F.col("at")
    own = F.struct(F.shiftright(at, 1).cast("int").alias("part"), F.lit(False).alias("tail"))
    tail = F.struct(F.pmod(F.shiftright(at, 1) - 1, F.lit(n)).cast("int").alias("part"), F.lit(True).alias("tail"))
    placed = keyed.withColumn("at", place("id", "hash"))
    placed = placed.withColumn("to", F.explode(F.when(at % 2 == 1, F.array(own, tail)).otherwise(F.array(own))))
    placed = placed.select("to.part", "to.tail", "id", "hash", "doc_id", "text")
    return placed.repartitionById(n, "part").sortWithinPartitions("part", "tail", "id", "hash")


def fingerprints(docs: DataFrame, parts: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, ``edited`` text, fingerprint, edited_fingerprint, near_edited, near_next.

    ``parts`` is the number of range partitions, by default four times that of shuffles.
    """
    spark = docs.sparkSession
    common.ready(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[Print] = []  # the row whose next one has not come yet
        for batch in batches:
            if not batch.num_rows:
                continue
            made = waiting + _prints(batch["doc_id"].to_pylist(), batch["text"].to_pylist())
            tails = [False] * len(waiting) + batch["tail"].to_pylist()
            # A tail ends its part (the key of several equal rows may send some of them): it only follows.
            rows = [x for x, tail in zip(made[:-1], tails) if not tail]
            after = [y for y, tail in zip(made[1:], tails) if not tail]
            waiting = [] if tails[-1] else made[-1:]
            if rows:
                columns = zip(*_compare(rows, after))
                kinds = [f.type for f in RESULT]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], FIELDS)

    if parts is None:
        parts = 4 * common.partitions(spark)
    return _ordered(common.texts(docs, key, text), parts).select("tail", "doc_id", "text").mapInArrow(run, SCHEMA)


RESULT = [
    pa.field("doc_id", pa.int64()),
    pa.field("n_chars", pa.int64()),
    *(pa.field(c, pa.string()) for c in FIELDS[2:5]),
    *(pa.field(c, pa.float64()) for c in FIELDS[5:]),
]
