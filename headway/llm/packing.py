"""Packing along a space-filling curve.

Each document becomes a hashed bag-of-tokens vector, is projected to three
dimensions and gets a Hilbert key. Rows are range-partitioned by (key, doc_id)
- copies share a key, the id splits them - and each range is packed on its own:
neighbours on the curve follow each other, a sequence is full before the next
one begins, and the rest of a range is cut into powers of two, which need no
padding.

Nulls count as the empty text (its end id alone). Rows with a null or repeated
doc_id are packed like others. Texts of any length are cut over as many
sequences as they need. An empty table gives an empty result; only the two
named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, common

BUCKETS, DIMS, BITS = 1024, 3, 10


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The Hilbert index of integer cells (rows, dims), each coordinate below 2**bits."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    top = 1 << (bits - 1)
    step = top
    while step > 1:  # undo the rotations and reflections of the sub-cubes
        low = step - 1
        for d in range(dims):
            on = (x[d] & step) > 0
            swap = np.where(on, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
        step >>= 1
    for d in range(1, dims):  # Gray code
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    step = top
    while step > 1:
        flip = np.where((x[dims - 1] & step) > 0, flip ^ (step - 1), flip)
        step >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> b) & 1)
    return key


def _vectors(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id, n (tokens with the end id), ids (little-endian unsigned), y0..y2."""
    data = common.vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.kept_bytes(data.value)
        kind = encoder.kind
        random = np.random.default_rng(20)
        bucket = random.integers(0, BUCKETS, max(encoder.model.size, end_id + 1))
        axes = random.standard_normal((BUCKETS, DIMS))
        end = np.array([end_id], kind).tobytes()
        for batch in batches:
            packed = [ids + end for ids in encoder.encode(batch["text"].to_pylist())]
            y = np.empty((len(packed), DIMS))
            for k, raw in enumerate(packed):
                v = np.log1p(np.bincount(bucket[np.frombuffer(raw, kind)], minlength=BUCKETS))
                y[k] = v @ axes / np.linalg.norm(v)
            columns = [batch["doc_id"], pa.array([len(x) // kind.itemsize for x in packed], pa.int64())]
            columns += [pa.array([kind.itemsize] * len(packed), pa.int32()), pa.array(packed, pa.binary())]
            columns += [pa.array(y[:, d]) for d in range(DIMS)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "width", "ids", *(f"y{d}" for d in range(DIMS))])

    axes = ", ".join(f"y{d} double" for d in range(DIMS))
    return docs.mapInArrow(run, f"doc_id long, n long, width int, ids binary, {axes}")


def _key(rows: DataFrame) -> DataFrame:
    """Scale each axis by its mean and deviation over all documents, cut it into cells, add the Hilbert key."""
    axes = [f"y{d}" for d in range(DIMS)]
    # One row of figures; the mean vector has no place of its own on a curve, so it is moved to the middle.
    found = rows.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in axes for f in (F.avg, F.stddev_pop)]).first()

    def cell(c: str):
        mean, spread = found[f"avg_{c}"] or 0.0, found[f"stddev_pop_{c}"] or 1.0
        share = 1 / (1 + F.exp(-1.7 * (F.col(c) - mean) / spread))  # near the normal distribution function
        return F.least(F.lit((1 << BITS) - 1), F.floor(share * (1 << BITS)).cast("int"))

    @F.pandas_udf("long")
    def curve(a, b, c):
        import pandas as pd

        return pd.Series(hilbert(np.stack([a, b, c], 1)))

    return rows.select("doc_id", "n", "width", "ids", curve(*[cell(c) for c in axes]).alias("key"))


def _cut(length: int, schema: list[str]):
    """A function that packs the sorted rows of one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        waiting: list[tuple] = []  # (doc_id, start, ids, doc_tokens) of the open sequence
        held, out = 0, []

        def emit(pieces: list[tuple]) -> None:
            nonlocal number
            offset = 0
            for doc, start, ids, total in pieces:
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                out.append((doc, start, len(ids), crc, total, base + number, offset))
                offset += len(ids)
            number += 1

        def batch_of() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in zip(*out)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, schema)

        for batch in batches:
            for doc, n, width, raw in zip(*(batch[c].to_pylist() for c in ("doc_id", "n", "width", "ids"))):
                ids, start = np.frombuffer(raw, f"<u{width}"), 0
                while start < n:
                    take = min(n - start, length - held)
                    waiting.append((doc, start, ids[start : start + take], n))
                    start, held = start + take, held + take
                    if held == length:
                        emit(waiting)
                        waiting, held = [], 0
            if out:
                yield batch_of()
        while held:  # the rest of the range: the largest power of two first
            want = 1 << (held.bit_length() - 1)
            held -= want
            pieces = []
            while want:
                doc, start, ids, n = waiting.pop(0)
                pieces.append((doc, start, ids[:want], n))
                if len(ids) > want:
                    waiting.insert(0, (doc, start + want, ids[want:], n))
                want -= len(pieces[-1][2])
            emit(pieces)
        if out:
            yield batch_of()

    return run


def pack(
    docs: DataFrame, path: str, length: int = 2048, end_id: int = 1, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence.

    ``start`` counts ids of the document, ``offset`` ids of the sequence;
    ``doc_tokens`` includes the end id. Sequences are ``length`` long or a power of two.
    """
    common.ready(docs.sparkSession)
    # Stored once: the range bounds need a pass of their own, which would tokenize again.
    rows = common.stored(_vectors(common.texts(docs, key, text), path, end_id), "packing")
    names = "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()
    ordered = _key(rows).repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id")
    return ordered.mapInArrow(_cut(length, names), ", ".join(f"{c} long" for c in names))
