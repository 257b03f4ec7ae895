"""Top-k and nearest neighbours against numpy over all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from headway.llm import ann, blocks, topk

VECTORS = [
    (0, [0.5, -0.25, 0.0]),
    (50, [0.1, 0.1, 0.1]),
    (100, None),
    (150, [None, 1.0, 1.0]),
    (200, [float("nan"), 1.0, 1.0]),
    (250, [float("inf"), 1.0, 1.0]),
    (300, [0.0, 0.0, 0.0]),
    (350, []),
    (400, [1.0]),
    (1, [0.5, -0.25, 0.0]),
    (2, [0.5, -0.25, 0.0]),
    (3, [0.5, -0.25, 0.0]),
    (3, [0.5, -0.25, 0.0]),
    (4, [-1.0, 2.0, 3.0]),
    (5, [2.0**20, 1.0, 0.0]),
    (6, [-0.001, -0.001, -0.001]),
    (None, [9.0, 9.0, 9.0]),
]


@pytest.fixture(scope="module")
def odd_vectors(spark):
    return spark.createDataFrame([(i, v, 7, 1.0) for i, v in VECTORS], "vec_id long, embedding array<float>, rank int, score double")


def taking_part(zero):
    kept = [(i, np.array(v, np.float32).astype(float)) for i, v in VECTORS if i is not None and v is not None and None not in v]
    kept = [(i, v) for i, v in kept if np.isfinite(v).all() and (zero or v.any())]
    return [(i, np.pad(v, (0, 3 - len(v)))) for i, v in kept]


def brute(part, score, k=5):
    out = []
    for q, v in {i: (i, v) for i, v in part if i % 50 == 0}.values():
        found = sorted(((-score(v, w), i) for i, w in part if i != q))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out, key=str)


def test_top_k_of_odd_vectors(odd_vectors):
    whole = lambda v: [math.floor(256 * x) for x in v]
    want = brute(taking_part(True), lambda a, b: sum(x * y for x, y in zip(whole(a), whole(b))))
    assert rows(topk.top_k(odd_vectors, F.col("vec_id") % 50 == 0)) == want


def test_nearest_of_odd_vectors(odd_vectors):
    cosine = lambda a, b: (a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))
    want = brute(taking_part(False), cosine)
    found = rows(ann.nearest(odd_vectors, F.col("vec_id") % 50 == 0))
    assert [r[:2] for r in found] == [r[:2] for r in want]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in want], abs=1e-12)


def test_empty_tables_and_no_queries(odd_vectors):
    for search in (topk.top_k, ann.nearest):
        assert search(odd_vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0
        assert search(odd_vectors, F.col("vec_id") < 0).count() == 0


def test_many_small_blocks_give_the_same(spark, small, monkeypatch):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    want = rows(topk.top_k(table, F.col("vec_id") % 10 == 0))
    monkeypatch.setattr(blocks, "QUERY_BLOCK", 7)
    monkeypatch.setattr(blocks, "ROW_BLOCK", 60)
    assert rows(topk.top_k(table, F.col("vec_id") % 10 == 0)) == want


def test_wide_scores_use_the_exact_way(spark):
    big = [(k * 50, [float(2**28 + k), 1.0]) for k in range(9)]
    table = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    found = topk.top_k(table, F.col("vec_id") == 0).collect()
    assert [r.vec_id for r in sorted(found, key=lambda r: r.rank)] == [400, 350, 300, 250, 200]


def test_recall_and_exact_scores(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    part = [(r.vec_id, np.array(r.embedding, float)) for r in table.collect()]
    units = np.array([v / np.linalg.norm(v) for _, v in part])
    ids = np.array([i for i, _ in part])
    found = ann.nearest(table, F.col("vec_id") % 5 == 0).collect()
    hits = n = 0
    for q in np.flatnonzero(ids % 5 == 0):
        cosines = units @ units[q]
        cosines[q] = -2
        want = set(ids[np.argsort(-cosines)[:5]].tolist())
        own = [r for r in found if r.query_id == ids[q]]
        hits, n = hits + len(want & {r.vec_id for r in own}), n + 5
        for r in own:
            assert r.score == pytest.approx(cosines[np.flatnonzero(ids == r.vec_id)[0]], abs=1e-12)
    assert hits / n >= 0.95


def test_estimates_are_close_and_bounds_hold():
    random = np.random.default_rng(5)
    x, q = random.standard_normal((2000, 64)), random.standard_normal(64)
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    q /= np.linalg.norm(q)
    turned = units @ ann.rotation(64)
    codes = np.packbits(turned > 0, axis=1, bitorder="little")
    scalars = np.abs(turned).sum(axis=1) / 8
    error = ann.estimate(q @ ann.rotation(64), codes, scalars) - units @ q
    spread = np.sqrt(1 - scalars**2) / scalars / np.sqrt(63)
    assert (np.abs(error) <= ann.WIDTH * spread).mean() > 0.97 and abs(error.mean()) < 0.01
