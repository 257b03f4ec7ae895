"""Exact top-k by exhaustive term-at-a-time accumulation.

A component is a term, the non-zero components of a block form its posting
lists, and a query is a sparse row of weighted terms. For each term, the
weighted postings are added into the dense score arrays of the queries that
have it; partition selection keeps the best k of the block, and the blocks'
results are merged.

Components become floor(scale * x) as long (saturated at the ends of long;
inner products beyond long wrap around). A missing component counts as zero.
Vectors that are null, or hold null or non-finite components, and rows without
id take no part. A query's own id is none of its candidates; repeated ids are
candidates each, and as queries one. Equal scores go to the smaller id. An
empty table, or one without queries, gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks, common

SLICE = 64  # queries scored at a time: their score arrays stay in cache


def _whole(column: pa.ChunkedArray, scale: int) -> np.ndarray:
    high = float(np.nextafter(2.0**63, 0))
    return np.clip(np.floor(scale * blocks.matrix(column)), -(2.0**63), high).astype(np.int64)


def _best(k: int, scale: int):
    def best(some: pa.Table, block: pa.Table):
        ids, rows = block["vec_id"].to_numpy(), _whole(block["v"], scale)
        order = np.argsort(ids, kind="stable")  # then a lower place is the smaller id
        ids, rows = ids[order], rows[order]
        own, queries = some["vec_id"].to_numpy(), _whole(some["v"], scale)
        terms = min(rows.shape[1], queries.shape[1])
        peak = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * terms
        kind = np.int32 if peak < 2**31 else np.int64
        postings = []
        for term in range(terms):
            places = np.flatnonzero(rows[:, term])
            # A list that holds most rows is read straight through: its zeros add nothing.
            full = 2 * len(places) > len(rows)
            postings.append((None if full else places, rows[:, term].astype(kind) if full else rows[places, term].astype(kind)))
        out = []
        for at in range(0, len(own), SLICE):
            part = queries[at : at + SLICE, :terms].astype(kind)
            scores = np.zeros((len(part), len(rows)), kind)
            for term, (places, values) in enumerate(postings):
                has = np.flatnonzero(part[:, term])
                add = np.multiply.outer(part[has, term], values)
                if places is not None:
                    scores[np.ix_(has, places)] += add
                elif len(has) == len(part):
                    scores += add
                else:
                    scores[has] += add
            out.append(_select(scores.astype(np.int64), own[at : at + SLICE], ids, k))
        return tuple(np.concatenate(c) for c in zip(*out))

    return best


def _select(scores: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int):
    """The k highest of each row, its own id left out; of equal scores the first places."""
    queries, n = scores.shape
    take = min(k + 1, n)  # one more: the query itself may be among them
    bits = max(1, (n - 1).bit_length())
    if np.abs(scores).max() < 1 << (62 - bits):
        keys = (scores << bits) + (n - 1 - np.arange(n))
        copies = int((np.diff(ids) == 0).any()) * n  # an id on several rows could fill the extra place
        if copies:
            keys[ids[None, :] == own[:, None]] = np.iinfo(np.int64).min
        picked = np.argpartition(keys, n - take, axis=1)[:, n - take :] if take < n else np.tile(np.arange(n), (queries, 1))
    else:
        picked = np.argsort(-scores.astype(object), axis=1, kind="stable")
    who = np.repeat(np.arange(queries), picked.shape[1])
    picked = picked.ravel()
    keep = ids[picked] != own[who]
    who, picked = who[keep], picked[keep]
    return own[who], ids[picked], scores[who, picked]


def top_k(
    df: DataFrame, is_query: Column, k: int = 5, scale: int = 256, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query row."""
    common.ready(df.sparkSession)
    rows = blocks.vectors(df, key, vector)
    return blocks.search(rows, rows.where(is_query), _best(k, scale), k, "long")
