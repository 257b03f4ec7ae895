"""Approximate nearest neighbours by cosine, with randomly rotated one-bit codes.

A unit vector is rotated and each coordinate keeps its sign: a packed code of
one bit per dimension, and the scalar <code, vector>. For a query, lookups of
eight bits at a time give <code, query>; divided by the scalar this estimates
the cosine without bias, with an error of known spread. Rows whose estimate
plus that bound reaches the k-th best exact cosine found so far are reranked on
the original vectors in double precision.

Every row is indexed; nothing is sampled or fitted, the rotation depends on
the dimension alone. Vectors that are null, zero, or hold null or non-finite
components, and rows without id take no part; shorter vectors end in zeros. A
query's own id is none of its candidates; repeated ids are candidates each, and
as queries one. Equal cosines go to the smaller id. An empty table, or one
without queries, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks, common

#: Width of the error bound in its standard deviations: about 0.6 % of neighbours lie outside.
WIDTH = 2.5
FIRST = 32  # rows reranked first, by estimate, for a close bound


@lru_cache(4)
def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def encode(rows: DataFrame, dims: int) -> DataFrame:
    """Add the packed code and its scalar to each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            turned = _unit(blocks.matrix(batch["v"], dims)) @ rotation(dims)
            packed = np.packbits(turned > 0, axis=1, bitorder="little")
            scalar = np.abs(turned).sum(axis=1) / np.sqrt(dims)
            columns = [batch["vec_id"], batch["v"], pa.array([p.tobytes() for p in packed], pa.binary()), pa.array(scalar)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "code", "scalar"])

    return rows.mapInArrow(run, "vec_id long, v array<double>, code binary, scalar double")


def estimate(turned: np.ndarray, codes: np.ndarray, scalars: np.ndarray) -> np.ndarray:
    """Estimated cosines of one rotated unit query with all codes, by tables of a byte's 256 values."""
    dims = len(turned)
    padded = np.zeros(codes.shape[1] * 8)
    padded[:dims] = turned
    signs = 2.0 * np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little") - 1
    tables = padded.reshape(-1, 8) @ signs.T
    total = tables[0][codes[:, 0]]
    for byte in range(1, codes.shape[1]):
        total += tables[byte][codes[:, byte]]
    return total / (np.sqrt(dims) * scalars)


def _best(k: int, dims: int, width: float):
    def best(some: pa.Table, block: pa.Table):
        ids, rows = block["vec_id"].to_numpy(), blocks.matrix(block["v"], dims)
        codes = np.frombuffer(b"".join(block["code"].to_pylist()), np.uint8).reshape(len(ids), -1)
        scalars, norms = block["scalar"].to_numpy(), np.sqrt((rows * rows).sum(axis=1))
        spread = np.sqrt(np.maximum(0, 1 - scalars**2)) / scalars / np.sqrt(max(1, dims - 1))
        own, queries = some["vec_id"].to_numpy(), blocks.matrix(some["v"], dims)
        turned = _unit(queries) @ rotation(dims)
        out = []
        for j, query in enumerate(queries):
            length = np.sqrt((query * query).sum())

            def exact(at: np.ndarray, query=query, length=length) -> np.ndarray:
                return (rows[at] * query).sum(axis=1) / (norms[at] * length)

            guess = estimate(turned[j], codes, scalars)
            guess[ids == own[j]] = -np.inf
            first = np.argpartition(-guess, FIRST)[:FIRST] if len(guess) > FIRST else np.arange(len(guess))
            first = first[ids[first] != own[j]]
            sure = exact(first)
            floor = np.partition(sure, -k)[-k] if len(sure) >= k else -np.inf
            chosen = np.flatnonzero(guess + width * spread >= floor)
            chosen = np.union1d(chosen[ids[chosen] != own[j]], first)
            score = exact(chosen)
            order = np.lexsort((ids[chosen], -score))[:k]
            out.append((np.full(len(order), own[j]), ids[chosen][order], score[order]))
        return tuple(np.concatenate(c) for c in zip(*out))

    return best


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    width: float = WIDTH,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row, exact cosines."""
    common.ready(df.sparkSession)
    rows = blocks.vectors(df, key, vector).where(F.exists("v", lambda x: x != 0))
    dims, size = rows.agg(F.max(F.size("v")), F.count("*")).first()
    dims = dims or 1
    return blocks.search(encode(rows, dims), rows.where(is_query), _best(k, dims, width), k, "double", size)
