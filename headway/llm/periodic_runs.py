"""Runs of words that repeat with a period, found by an online sparse diagonal DP.

A run with smallest period ``q`` is a stretch of matches on diagonal ``q``: word ``i``
equals word ``i - q`` for all but its first ``q`` words. The DP reads the words in
order and holds the match length of the active lags only. Each word makes every active
lag longer or ends it, and a lag that ends (or meets the end of the text) after matches
enough emits its run at once.

A lag becomes active where an earlier occurrence of the word shows it. A frequent word
has too many of those, so an occurrence counts together with the words before it: a
run needs ``max(least - q, (power - 1) * q)`` matches, hence at least ``gram`` of them
for any ``q``. With ``m = gram, 2 * gram, ..`` the nearest earlier occurrence of the
``m`` words up to ``i`` activates its lag, if that is at most ``m`` (and, above the first
``m``, more than ``m / 2``). No run is missed:

* ``2 * q <= gram``: a nearer occurrence at ``d < q`` would give the ``m`` words the
  periods ``d`` and ``q`` with ``d + q <= m``, hence the run a smaller period.
* ``m / 2 < q <= m``: the matched part of the run has ``2 * q > m`` words or more. If each
  of its stretches of ``m`` words had a period up to ``m / 2``, all would share it, and
  the run's smallest period would be below ``q``. Occurrences of a stretch without such a
  period are more than ``m / 2`` apart, so the nearest one is ``q`` back.

There is one nearest occurrence for each word and ``m``, so a text of ``n`` words costs
about ``n * log(n)`` steps, whatever it repeats. Words and stretches are compared by exact
names, never by hashes alone (a hash only tells which texts have a stretch twice).

Nulls count as the empty text, which has no words and no runs. White space is
``[\\x20\\x09-\\x0D]``. Texts of any length are read whole; equal rows give equal results; an
empty table gives an empty result; only the two named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])


def gram_size(least: int, power: int) -> int:
    """The largest power of two that the matches of any run reach."""
    if power < 3 or least < 1:
        raise ValueError("runs must hold their period three times or more")
    fewest = min(max(least - q, (power - 1) * q) for q in range(1, least + 2))
    return 1 << (fewest.bit_length() - 1)


def _names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The same number for the same pair of names."""
    return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1]


def _seeds(words: np.ndarray, gram: int, power: int) -> tuple[list[int], list[int]]:
    """Places and lags that become active there, by place; of neighbours on a diagonal the first."""
    names, m = words, 1
    places, lags = [], []
    while True:
        if m >= gram:
            order = np.argsort(names, kind="stable")
            same = names[order[1:]] == names[order[:-1]]
            if not same.any():
                break  # nor does any longer stretch occur twice
            at, lag = order[1:][same], np.diff(order)[same]
            near = (lag <= m) & (lag > (m // 2 if m > gram else 0))
            places.append(at[near] + m - 1)
            lags.append(lag[near])
            if m * power > len(words):
                break  # a longer period does not fit
        if 2 * m > len(words):
            break
        names, m = _names(names[:-m], names[m:]), 2 * m
    if not places:
        return [], []
    place, lag = np.concatenate(places), np.concatenate(lags)
    order = np.lexsort((place, lag))
    place, lag = place[order], lag[order]
    first = np.ones(len(place), bool)
    first[1:] = (lag[1:] != lag[:-1]) | (place[1:] > place[:-1] + 1)
    place, lag = place[first], lag[first]
    order = np.argsort(place, kind="stable")
    return place[order].tolist(), lag[order].tolist()


def _matched(words: np.ndarray, at: int, lag: int) -> int:
    """Matches on a diagonal that end with word ``at``."""
    total, size = 0, 64
    while at >= lag:
        low = max(lag, at - size + 1)
        differ = np.flatnonzero(words[low : at + 1] != words[low - lag : at + 1 - lag])
        if len(differ):
            return total + at - low - int(differ[-1])
        total, at, size = total + at + 1 - low, low - 1, 2 * size
    return total


def _is_smallest(block: np.ndarray) -> bool:
    """Whether a period is no multiple of a smaller one."""
    n = rest = len(block)
    factor = 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            p = n // factor
            if np.array_equal(block[p:], block[:-p]):
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


def find_runs(words: np.ndarray, least: int = 24, power: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a text given as numbers of its words, by start and period."""
    if len(words) < least:
        return []
    places, lags = _seeds(words, gram_size(least, power), power)
    places.append(len(words))
    plain = words.tolist()
    active: dict[int, int] = {}  # lag: words matched so far
    runs: list[tuple[int, int, int]] = []

    def end(lag: int, at: int) -> None:
        length = active.pop(lag) + lag
        start = at - length
        if length >= max(least, power * lag) and _is_smallest(words[start : start + lag]):
            runs.append((start, length, lag))

    seed = at = 0
    while at < len(plain):
        if not active:
            at = places[seed]
            if at == len(plain):
                break
        word = plain[at]
        for lag in [*active]:
            if word == plain[at - lag]:
                active[lag] += 1
            else:
                end(lag, at)
        while places[seed] == at:
            if lags[seed] not in active:
                active[lags[seed]] = _matched(words, at, lags[seed])
            seed += 1
        at += 1
    for lag in [*active]:
        end(lag, len(plain))
    return sorted(runs)


def _repetitive(numbers: np.ndarray, sizes: np.ndarray, gram: int) -> np.ndarray:
    """Which texts of a batch hold some stretch of ``gram`` words twice (a few others by a chance of hashes)."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    if len(numbers) < gram:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        h = (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        m = 1
        while m < gram:
            h = h[:-m] * np.uint64(0xD6E8FEB86659FD93 + 2 * m) + h[m:]
            h ^= h >> np.uint64(31)
            m *= 2
        inside = owner[: len(h)] == owner[gram - 1 :]
        h = (h + owner[: len(h)].astype(np.uint64) * np.uint64(0xA0761D6478BD642F))[inside]
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    return np.unique(owner[: len(inside)][inside][order[1:][same]])


def periodic_runs(
    docs: DataFrame, least: int = 24, power: int = 3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_words, ``runs`` and the ``collapsed`` text.

    A run holds at least ``least`` words and its smallest period ``power`` times or more.
    The collapsed text has the words, joined by one space, that lie in the first period
    of each run they are part of.
    """
    common.ready(docs.sparkSession)
    gram = gram_size(least, power)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [t.split() for t in batch["text"].to_pylist()]  # bytes: ASCII white space only
        numbers: dict[bytes, int] = {}
        codes = np.fromiter((numbers.setdefault(w, len(numbers)) for r in rows for w in r), np.int64)
        sizes = np.array([len(r) for r in rows], np.int64)
        ends = np.cumsum(sizes)
        found: list[list[tuple[int, int, int]]] = [[] for _ in rows]
        for k in _repetitive(codes, sizes, gram).tolist():
            words = np.unique(codes[ends[k] - sizes[k] : ends[k]], return_inverse=True)[1]
            found[k] = find_runs(words, least, power)
            kept = np.ones(len(words), bool)
            for start, length, period in found[k]:
                kept[start + period : start + length] = False
            rows[k] = [rows[k][i] for i in np.flatnonzero(kept).tolist()]
        runs = [[{"start": s, "length": n, "period": q} for s, n, q in some] for some in found]
        columns = [batch["doc_id"], pa.array(sizes), pa.array(runs, pa.list_(RUN))]
        columns.append(pa.array([b" ".join(r) for r in rows], pa.binary()).cast(pa.string()))
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    run = "struct<start: long, length: long, period: long>"
    plain = common.texts(docs, key, text).withColumn("text", F.col("text").cast("binary"))
    return common.map_batches(plain, step, f"doc_id long, n_words long, runs array<{run}>, collapsed string")


def repeat_some(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text), in a tenth of the rows with words that repeat up to the end, as the id's checksum says.

    With ``h`` the crc32 of the decimal id and ``g = h // 10``: if ``h % 10 = 0``, of ``n`` words those from
    ``a = g % n`` on repeat with period ``1 + (n - a) // (3 + g % 8)``. Rows without an id stay as they are.
    """
    rows = common.texts(docs, key, text)
    planted = F.expr(r"""
        transform(array(filter(split(text, '[ \\t-\\r]+'), w -> w <> '')), words ->
            transform(array(named_struct('n', size(words), 'g', crc32(cast(doc_id AS string)) DIV 10)), x ->
                transform(array(cast(x.g % x.n AS int)), a ->
                    transform(array(cast(1 + (x.n - a) DIV (3 + x.g % 8) AS int)), p ->
                        array_join(transform(words, (w, i) -> if(i < a, w, words[a + (i - a) % p])), ' ')
                    )[0]
                )[0]
            )[0]
        )[0]
    """)
    chosen = (F.crc32(F.col("doc_id").cast("string")) % 10 == 0) & F.col("text").rlike(r"[^ \t-\r]")
    return rows.select("doc_id", F.when(chosen, planted).otherwise(F.col("text")).alias("text"))
