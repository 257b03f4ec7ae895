"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages (runs of words). Each passage is described by
its shares of characters and of byte pairs, and by figures of its words, and
encoded by a small dense layer. Gated attention, learned from the documents'
labels alone, weighs the passages; the weighted representation gets the score.

The model is fitted on a bounded sample: of each label at most ``sample``
documents, those with the lowest hash of their id, each with all its passages.
A document of more than ``sample_passages`` passages makes way for the next one
(where all of a label are as long, the shortest stays); of the others those stay that
with all before them have at most as many. Of several texts of one id the one with
the lowest hash is learned from, whichever executor reads it. Every document is scored on its
whole text. Labels, language, source and id are not among the inputs.

Null and empty texts are one passage without words. Null labels are dropped;
of several labels of one id the mean, rounded, counts. Without labels of
both kinds the score is their mean (0.5 without any). Repeated rows get equal
scores; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

WORDS = 64  # of a passage
THRESHOLD = 0.3
SAMPLE = 2000
#: Passages of the sampled documents of one label: bounds how many documents, never the text of one.
SAMPLE_PASSAGES = 100_000
PAIRS = 32
_KIND = np.array(
    [
        0 if 97 <= b <= 122 else 1 if 65 <= b <= 90 else 2 if 48 <= b <= 57 else 3 if b == 32 else 4 if b >= 128
        else 5 if b < 32 or b == 127 else 6
        for b in range(256)
    ],
    np.int64,
)
_MARKS = [b for b in range(256) if _KIND[b] == 6]
_KIND[_MARKS] = 6 + np.arange(len(_MARKS))  # each ASCII mark is a kind of its own
KINDS = 6 + len(_MARKS)
FIGURES = 5
FEATURES = KINDS + PAIRS + FIGURES


def _size(words: list[str]) -> int:
    return max(1, -(-len(words) // WORDS))


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the number of passages of each text."""
    parts, figures, sizes = [], [], []
    for text in texts:
        words = text.split()
        sizes.append(_size(words))
        for at in range(0, max(1, len(words)), WORDS):
            some = words[at : at + WORDS]
            n = max(1, len(some))
            parts.append(" ".join(some).encode())
            figures.append(
                (
                    min(3.0, len(parts[-1]) / n / 10),
                    sum(map(eq, some, some[1:])) / n,
                    len(set(some)) / n,
                    sum(map(str.isupper, some)) / n,
                    len(some) / WORDS,
                )
            )
    lengths = np.array([len(p) for p in parts])
    raw = np.frombuffer(b"".join(parts), np.uint8)
    who = np.repeat(np.arange(len(parts)), lengths)
    share = 1 / np.maximum(lengths, 1)[:, None]
    kinds = np.bincount(who * KINDS + _KIND[raw], minlength=len(parts) * KINDS).reshape(-1, KINDS) * share
    low = raw.astype(np.int64) | 32
    inside = who[:-1] == who[1:]  # both bytes of a pair are of one passage
    pair = ((low[:-1] * 31 + low[1:]) % PAIRS)[inside]
    pairs = np.bincount(who[:-1][inside] * PAIRS + pair, minlength=len(parts) * PAIRS).reshape(-1, PAIRS) * share
    return np.hstack([np.sqrt(kinds), np.sqrt(pairs), np.array(figures)]), np.array(sizes)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


@dataclass
class Model:
    """Gated attention over encoded passages; ``weights`` by name."""

    weights: dict[str, np.ndarray]
    mean: np.ndarray
    spread: np.ndarray

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        w, begin = self.weights, np.cumsum(sizes) - sizes
        bag = np.repeat(np.arange(len(sizes)), sizes)
        x = np.clip((x - self.mean) / self.spread, -5, 5)
        h = np.tanh(x @ w["encode"] + w["shift"])
        t, g = np.tanh(h @ w["what"]), _sigmoid(h @ w["gate"])
        a = (t * g) @ w["weigh"]
        a = np.exp(a - np.maximum.reduceat(a, begin)[bag])
        a /= np.add.reduceat(a, begin)[bag]
        z = np.add.reduceat(a[:, None] * h, begin)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "bag": bag, "begin": begin, "p": _sigmoid(z @ w["out"] + w["bias"])}

    def gradients(self, s: dict[str, np.ndarray], wrong: np.ndarray) -> dict[str, np.ndarray]:
        """``wrong``: derivative of the loss by each document's logit."""
        w, bag = self.weights, s["bag"]
        dz = wrong[:, None] * w["out"]
        da = (dz[bag] * s["h"]).sum(axis=1)
        da = s["a"] * (da - np.add.reduceat(s["a"] * da, s["begin"])[bag])
        both = da[:, None] * w["weigh"]
        dt, dg = both * s["g"] * (1 - s["t"] ** 2), both * s["t"] * s["g"] * (1 - s["g"])
        dh = s["a"][:, None] * dz[bag] + dt @ w["what"].T + dg @ w["gate"].T
        dh *= 1 - s["h"] ** 2
        return {
            "encode": s["x"].T @ dh, "shift": dh.sum(axis=0), "what": s["h"].T @ dt, "gate": s["h"].T @ dg,
            "weigh": (s["t"] * s["g"]).T @ da, "out": s["z"].T @ wrong, "bias": wrong.sum(keepdims=True),
        }


def fit(x: np.ndarray, sizes: np.ndarray, labels: np.ndarray, hidden: int = 16, rounds: int = 200) -> Model:
    """Full-batch Adam; both labels weigh the same in all, weights decay a little."""
    random = np.random.default_rng(8)
    shapes = {
        "encode": (x.shape[1], hidden), "shift": (hidden,), "what": (hidden, 8), "gate": (hidden, 8),
        "weigh": (8,), "out": (hidden,), "bias": (1,),
    }
    weights = {k: random.standard_normal(n) / np.sqrt(n[0]) for k, n in shapes.items()}
    weights["bias"][:] = weights["shift"][:] = 0
    model = Model(weights, x.mean(axis=0), np.maximum(x.std(axis=0), 0.02))
    share = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (1 - labels).sum())
    first, second = ({k: np.zeros(n) for k, n in shapes.items()} for _ in range(2))
    for step in range(1, rounds + 1):
        state = model.forward(x, sizes)
        for k, d in model.gradients(state, share * (state["p"] - labels)).items():
            d = d + (0 if k in ("bias", "shift") else 1e-3 * weights[k])
            first[k] += 0.1 * (d - first[k])
            second[k] += 0.001 * (d * d - second[k])
            weights[k] -= 0.02 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def training_bags(docs: DataFrame, labels: DataFrame, sample: int, sample_passages: int = SAMPLE_PASSAGES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, passages per document and labels of the sample, in the order of the ids."""
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("q"))
        .where(F.col("q").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
        .groupBy("doc_id")
        .agg((F.avg("q") >= 0.5).cast("int").alias("label"))
    )
    order = F.xxhash64("doc_id")
    sides = [marks.where(F.col("label") == y).orderBy(order, "doc_id").limit(sample) for y in (0, 1)]
    chosen = F.broadcast(sides[0].union(sides[1]))  # at most 2 * sample ids
    one = F.min_by("text", F.xxhash64("text")).alias("text")
    rows = docs.join(chosen, "doc_id").groupBy("doc_id", "label").agg(one).select("doc_id", "text", "label")
    rows = common.stored(rows, "quality-sample")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = pa.array([_size(t.split()) for t in batch["text"].to_pylist()], pa.int64())
        return pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], n], ["doc_id", "label", "n"])

    def describe(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, sizes = passages(batch["text"].to_pylist())
        raw = [part.astype(np.float32).tobytes() for part in np.split(x, np.cumsum(sizes)[:-1])]
        return pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], pa.array(raw, pa.binary())], ["doc_id", "label", "x"])

    sizes = common.map_batches(rows, count, "doc_id long, label int, n long")
    side = Window.partitionBy("label")
    fits = F.col("n") <= sample_passages
    sizes = sizes.withColumns(
        {
            "total": F.sum(F.when(fits, F.col("n"))).over(side.orderBy(order, "doc_id")),
            "shortest": F.row_number().over(side.orderBy("n", order, "doc_id")),
        }
    )
    whole = sizes.where((fits & (F.col("total") <= sample_passages)) | (~fits & (F.col("shortest") == 1)))
    rows = rows.join(F.broadcast(whole.select("doc_id")), "doc_id")
    bags = common.map_batches(rows.select("doc_id", "text", "label"), describe, "doc_id long, label int, x binary").toArrow()
    bags = bags.sort_by("doc_id")
    parts = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in bags["x"].to_pylist()]
    x = np.concatenate(parts) if parts else np.zeros((0, FEATURES), np.float32)
    return x.astype(np.float64), np.array([len(p) for p in parts], np.int64), bags["label"].to_numpy()


def scorer(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_passages: int = SAMPLE_PASSAGES):
    """A function from texts to scores, fitted on the labelled rows of ``docs`` (doc_id, text)."""
    x, sizes, marks = training_bags(docs, labels, sample, sample_passages)
    model = fit(x, sizes, marks.astype(float)) if 0 < marks.sum() < len(marks) else None
    even = float(marks.mean()) if len(marks) else 0.5

    def scores(texts: list[str]) -> np.ndarray:
        return np.clip(model.forward(*passages(texts))["p"], 0, 1) if model else np.full(len(texts), even)

    return scores


def score(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
    key: str = "doc_id",
    text: str = "text",
    sample_passages: int = SAMPLE_PASSAGES,
) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted."""
    common.ready(docs.sparkSession)
    rows = common.texts(docs, key, text)
    scores = scorer(rows, labels, sample, sample_passages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                p = pa.array(scores(batch["text"].to_pylist()))
                yield pa.RecordBatch.from_arrays([batch["doc_id"], p], ["doc_id", "score"])

    part = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return rows.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        (part % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
    key: str = "doc_id",
    text: str = "text",
    sample_passages: int = SAMPLE_PASSAGES,
) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold."""
    common.ready(docs.sparkSession)
    scores = scorer(common.texts(docs, key, text), labels, sample, sample_passages)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(scores([t or "" for t in batch.column(place).to_pylist()]) >= threshold))

    return docs.mapInArrow(run, docs.schema)
