"""N-gram Jaccard join: MinHash bands, Bayesian pruning of candidates, exact verification.

Texts are sets of five-word shingles of lower-cased words (a shorter text is
one shingle of all its words). Equal texts are one node. Nodes that agree in a
band of their MinHash signatures are candidates; buckets with the same members
are taken once, and a pair that shares several buckets is looked at in the
first. A candidate pair's signatures are compared some values at a time: after n
values with m matches, under a uniform prior, the posterior probability that the
similarity reaches the threshold is P(Binomial(n + 1, threshold) <= m); below
the tolerance the pair is dropped. The rest is verified on the shingle sets.

Pairs are never written out. Large buckets are split into tiles of two blocks,
each a unit of work of its own, and a tile gives one row per member: its number
of links and its root in the tile's spanning forest. Members are dealt to blocks
by hash, as many blocks as keep both their members and their bytes of text
bounded on average (a text beyond the bound is read whole).

Texts without words (null, empty, blank) are linked to nothing. Rows that
agree in text are links of each other, also with equal ids. Null ids take part
and never name a class that has another id. Texts of any length are read
whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, components

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5  # a pair at the threshold shares a band with probability 0.99995
VALUES = 128
STEP = 8
TOLERANCE = 1e-4
TILE = 512  # members of one block of a large bucket
TILE_BYTES = 64 << 20  # of text of one block


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_hashes = _Hashes()


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    if len(_hashes) > common.CACHE_ENTRIES:
        _hashes.clear()
    words = text.lower().split()
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(h))
    if not size:
        return h
    out = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - size + 1 + k]
    return np.unique(out ^ (out >> np.uint64(32)))


_random = np.random.default_rng(3)
_FACTORS = _random.integers(0, 1 << 63, VALUES, np.uint64) * np.uint64(2) + np.uint64(1)
_ADDED = _random.integers(0, 1 << 63, VALUES, np.uint64)


def signature(items: np.ndarray) -> np.ndarray:
    """MinHash values of a set."""
    out = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), 2048):
        out = np.minimum(out, (items[at : at + 2048, None] * _FACTORS + _ADDED).min(axis=0))
    return (out >> np.uint64(32)).astype(np.uint32)


def _bands(values: np.ndarray) -> np.ndarray:
    """One 64-bit name for each band of each signature; its low five bits are the band's number."""
    part = values[:, : BANDS * ROWS].reshape(len(values), BANDS, ROWS).astype(np.uint64)
    out = np.zeros((len(values), BANDS), np.uint64)
    for k in range(ROWS):
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + part[:, :, k] + np.uint64(1)
    out = (out ^ (out >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return ((out & ~np.uint64(31)) | np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> np.ndarray:
    """For each n, the smallest m for which the posterior reaches the tolerance."""
    out = np.zeros(VALUES + 1, np.int64)
    for n in range(1, VALUES + 1):
        total = 0.0
        for m in range(n + 1):
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                out[n] = m
                break
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [signature(s) if len(s) else None for s in map(shingles, batch["text"].to_pylist())]
        some = [v for v in values if v is not None]
        bands = iter(_bands(np.array(some)).tolist()) if some else iter(())
        columns = [
            batch["doc_id"],
            batch["node"],
            pa.array([None if v is None else v.tobytes() for v in values], pa.binary()),
            pa.array([None if v is None else next(bands) for v in values], pa.list_(pa.int64())),
            pc.binary_length(batch["text"]).cast(pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "values", "bands", "size"])


def _candidates(values: np.ndarray, left: np.ndarray, right: np.ndarray, need: np.ndarray):
    """Pairs whose posterior stays above the tolerance, a few values at a time."""
    matches = np.zeros(len(left), np.int64)
    for at in range(0, VALUES, STEP):
        part = slice(at, at + STEP)
        matches += (values[left, part] == values[right, part]).sum(axis=1)
        live = matches >= need[min(VALUES, at + STEP)]
        left, right, matches = left[live], right[live], matches[live]
    return left, right


def _linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold, exactly. Pairs are sorted by their left member."""
    out = np.zeros(len(left), bool)
    begin = np.flatnonzero(np.diff(left, prepend=-1))
    for a, b in zip(begin, [*begin[1:], len(left)]):
        own = sets[left[a]]
        others = [sets[k] for k in right[a:b]]
        sizes = np.array([len(x) for x in others])
        every = np.concatenate(others)
        at = np.minimum(np.searchsorted(own, every), len(own) - 1)
        common_items = np.add.reduceat((own[at] == every).astype(np.int64), np.cumsum(sizes) - sizes)
        out[a:b] = common_items / (len(own) + sizes - common_items) >= threshold
    return out


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> list[int]:
    root = list(range(n))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for a, b in zip(left.tolist(), right.tolist()):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


def _tile(rows: list[dict], threshold: float, need: np.ndarray) -> list[tuple]:
    """(node, links, root) of the members of one tile that have links."""
    rows = sorted({r["node"]: r for r in rows}.values(), key=lambda r: r["node"])
    first, second = rows[0]["i"], rows[0]["j"]
    blocks = np.array([r["block"] for r in rows])
    values = np.frombuffer(b"".join(r["values"] for r in rows), np.uint32).reshape(len(rows), VALUES)
    mine = np.zeros((len(rows), 32), np.int64)
    for k, r in enumerate(rows):
        for band in r["kept"]:
            mine[k, band & 31] = band
    if first == second:
        left, right = np.triu_indices(len(rows), 1)
    else:
        one, two = np.flatnonzero(blocks == first), np.flatnonzero(blocks == second)
        left, right = np.repeat(one, len(two)), np.tile(two, len(one))
    left, right = _candidates(values, left, right, need)
    number = rows[0]["bucket"] & 31
    earlier = ((mine[left, :number] == mine[right, :number]) & (mine[left, :number] != 0)).any(axis=1)
    left, right = left[~earlier], right[~earlier]
    if not len(left):
        return []
    used = np.union1d(left, right)
    sets: list = [None] * len(rows)
    for k in used:
        sets[k] = shingles(rows[k]["text"])
    order = np.argsort(left, kind="stable")
    left, right = left[order], right[order]
    yes = _linked(sets, left, right, threshold)
    left, right = left[yes], right[yes]
    copies = np.array([r["copies"] for r in rows])
    links = np.bincount(left, copies[right], len(rows)) + np.bincount(right, copies[left], len(rows))
    root = _roots(len(rows), left, right)
    return [(rows[k]["node"], int(links[k]), rows[root[k]]["node"]) for k in np.flatnonzero(links)]


def _verify(threshold: float):
    need = least_matches(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in batch.to_pylist())
        out: list[tuple] = []
        for _, tile in groupby(rows, key=lambda r: (r["bucket"], r["i"], r["j"])):
            out += _tile(list(tile), threshold, need)
            if len(out) > 20_000:
                yield _links_batch(out)
                out = []
        if out:
            yield _links_batch(out)

    return run


def _links_batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["node", "links", "root"])


def _nodes(docs: DataFrame, key: str, text: str) -> DataFrame:
    return common.texts(docs, key, text).withColumn("node", F.unhex(F.md5("text")))


def _described(rows: DataFrame) -> DataFrame:
    """The nodes, written: their smallest id, copies, signature, bands and bytes of text."""
    described = rows.mapInArrow(_describe, "doc_id long, node binary, values binary, bands array<long>, size long")
    nodes = described.groupBy("node").agg(
        F.min("doc_id").alias("rep"),
        F.count("*").alias("copies"),
        F.first("values").alias("values"),
        F.first("bands").alias("bands"),
        F.first("size").alias("size"),
    )
    return common.stored(nodes, "signatures")


def _tiles(rows: DataFrame, nodes: DataFrame, tile: int, tile_bytes: int) -> DataFrame:
    """The members of each tile (bucket, i, j), with their texts, side by side."""
    bands = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    # Buckets of the same members are one: size, first member and a digest of all say so.
    buckets = bands.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("node").alias("low"), F.bit_xor(F.xxhash64("node")).alias("mix"), F.sum("size").alias("bytes")
    )
    number = F.struct((F.col("bucket").bitwiseAND(31)).alias("number"), "bucket")  # the first band of them
    buckets = buckets.where("n > 1").groupBy("n", "low", "mix", "bytes").agg(F.min(number).alias("b"))
    blocks = F.greatest(F.ceil(F.col("n") / tile), F.least("n", F.ceil(F.col("bytes") / tile_bytes)))
    buckets = buckets.select("b.bucket", blocks.cast("int").alias("blocks"))
    members = bands.join(buckets, "bucket").groupBy("node").agg(F.collect_list(F.struct("bucket", "blocks")).alias("kept"))
    members = members.join(nodes.select("node", "rep", "copies", "values"), "node")
    # The text of one row of each node.
    members = (
        members.alias("m")
        .join(rows.alias("r"), (F.col("m.node") == F.col("r.node")) & F.col("m.rep").eqNullSafe(F.col("r.doc_id")))
        .select("m.node", "m.copies", "m.values", "m.kept", "r.text")
    )
    return (
        members.withColumn("b", F.explode("kept"))
        .withColumn("block", F.pmod(F.xxhash64("node", "b.bucket"), F.col("b.blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("b.blocks") - 1)))
        .select(
            F.col("b.bucket").alias("bucket"),
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "block",
            "node",
            "copies",
            "values",
            F.transform("kept", lambda k: k["bucket"]).alias("kept"),
            "text",
        )
        .repartition("bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j")
    )


def _classified(
    docs: DataFrame, threshold: float, tile: int, tile_bytes: int, key: str, text: str
) -> tuple[DataFrame, DataFrame]:
    """All rows as (doc_id, text, node), and the nodes: copies, links, and the first row of their class."""
    common.ready(docs.sparkSession)
    rows = _nodes(docs, key, text)
    nodes = _described(rows)
    tiles = _tiles(rows, nodes, tile, tile_bytes)
    found = common.stored(tiles.mapInArrow(_verify(threshold), "node binary, links long, root binary"), "links")
    ties = components.stars(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = (
        nodes.select("node", "rep", "copies", F.col("values").isNotNull().alias("full"))
        .join(links, "node", "left")
        .join(ties.select(F.col("u").alias("node"), F.col("v").alias("top")), "node", "left")
        .withColumn("top", F.coalesce("top", "node"))
    )
    first = F.struct(F.col("rep").isNull().alias("no_id"), "rep", "node")
    best = joined.groupBy("top").agg(F.min(first).alias("best"))
    joined = joined.join(best, "top").select(
        "node",
        F.col("best.rep").alias("best_id"),
        F.col("best.node").alias("best_node"),
        F.when(F.col("full"), F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
    )
    return rows, joined


def classes(
    docs: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, key: str = "doc_id", text: str = "text", tile_bytes: int = TILE_BYTES
) -> DataFrame:
    """(doc_id, class_id, n_links) of every row: the smallest id of its class, and how many rows it is linked to."""
    rows, nodes = _classified(docs, threshold, tile, tile_bytes, key, text)
    class_id = F.when(F.col("n_links") > 0, F.col("best_id")).otherwise(F.col("doc_id")).alias("class_id")
    return rows.select("doc_id", "node").join(nodes, "node").select("doc_id", class_id, "n_links")


def keep_one(
    docs: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, key: str = "doc_id", text: str = "text", tile_bytes: int = TILE_BYTES
) -> DataFrame:
    """The rows of ``docs`` without links, and of each class one row: that of the smallest id.

    Rows of the same id and text are one another's links if the text holds enough words, and then
    one of them stays (the one whose columns hash lowest); rows without links all stay.
    """
    rows, nodes = _classified(docs, threshold, tile, tile_bytes, key, text)
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    marked = docs.select(F.struct("*").alias("row"), F.unhex(F.md5(body)).alias("node"))
    own = F.col(f"row.`{key}`").cast("long")
    stays = (F.col("n_links") == 0) | ((F.col("node") == F.col("best_node")) & own.eqNullSafe(F.col("best_id")))
    kept = marked.join(nodes, "node").where(stays)
    if not rows.groupBy("doc_id", "node").count().where("count > 1").isEmpty():
        # Several rows can be the first of their class. Dealt anew, so that the join above can split a hot text.
        firsts = kept.where("n_links > 0").repartition("node").groupBy("node")
        firsts = firsts.agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
        kept = kept.where("n_links = 0").select("row").unionByName(firsts.select("row"))
    return kept.select("row.*")
