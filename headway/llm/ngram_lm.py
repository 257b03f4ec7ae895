"""N-gram language model in Elias-Fano tries over ranges of the corpus's n-grams, applied to the whole corpus.

Documents are dealt into blocks by a hash of their id. Each block is encoded
once, as numbers of its words, and the words of all blocks get ids, the frequent
ones small numbers. A block sends each distinct n-gram (of one word up to
``order``) once, with its training count, to a shard, so a frequent one costs
each block one entry. The shard follows from the n-gram's shortest ending that
begins with a rare word, else from the whole n-gram: so what ends alike mostly
lies together and is sent as a trie of word ids, and no shard gets more by one
ending than a rare word's occurrences. A shard adds up what all blocks sent and
builds its trie of the n-grams seen in training, three memory-mapped levels:
contexts (hashes, increasing), for each context a monotone pointer to its
successors, and the successors (relative to their context, made monotone by the
end of the context before) with their quantised frequencies. Then it looks the
n-grams of every block up there, those of held-out texts as well: the context's
range by its pointers, the word in it by successor search.

Model: p(w | h) = (c(h, w) + prior * p(w | shorter h)) / (c(h) + prior), from the
add-0.1 probability of a word upwards, so the probabilities of every context add
up to one (but for quantising: counts above 16,384 are kept to 0.04 %). A text
follows ``order - 1`` start marks; its last token is its end.

Null texts are empty: one token, the end. Null ids count as the empty string in
the held-out rule. Repeated rows count each. Texts of any length are read whole;
an empty table gives an empty result; only the two named columns are read.
Words and contexts are known by 63-bit hashes.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .elias_fano import EliasFano, mapped
from .words import Words, mix, whole

BLOCK_CHARS = 8_000_000
ORDER = 3
PRIOR = 30.0  # tokens that the shorter context's probabilities are worth; held-out texts of sf 0.1 scored best of 1, 4, 10, 30
END = b"\n"  # not possible as a word, like the start marks
ROOT = np.zeros(1, np.uint64)  # the empty context
RARE = 32  # a word is rare in the corpus up to the RARE-th part of ``block_chars`` occurrences
EXACT, FINE = 1 << 14, 3_500  # counts up to EXACT are levels of their own, FINE levels to each power of ten above
EDGE = np.log10(EXACT)


def _starts(order: int) -> list[bytes]:
    """Marks before a text, each at one place only, so that the last is followed by first words alone."""
    return [b"\r" * n for n in range(order - 1, 0, -1)]


def quantised(counts: np.ndarray) -> np.ndarray:
    """Counts in 16 bits: as they are up to EXACT, by their logarithm above."""
    above = EXACT + np.rint((np.log10(np.maximum(counts, EXACT)) - EDGE) * FINE)
    return np.where(counts <= EXACT, counts, np.minimum(above, 65_535)).astype(np.uint16)


def counted(levels: np.ndarray) -> np.ndarray:
    levels = levels.astype(np.float64)
    return np.where(levels <= EXACT, levels, 10 ** (np.maximum(levels - EXACT, 0) / FINE + EDGE))


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """One of so many shards, that does not fall as hashes rise."""
    return ((hashes >> np.uint64(31)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


class Level:
    """The distinct n-grams of one length in a block, by their ending (all but the first word), then the first word."""

    def __init__(self, ending: np.ndarray, first: np.ndarray, words: int) -> None:
        """``ending``, ``first``: of each place, as numbers of n-grams one shorter and of words."""
        code, self.which = np.unique(ending * words + first, return_inverse=True)
        self.ending = code // words
        self.first = code - self.ending * words

    @classmethod
    def of_words(cls, words: int) -> Level:
        level = cls.__new__(cls)
        level.ending, level.first = np.zeros(words, np.int64), np.arange(words)
        return level


def _encode(order: int):
    """A block as one row: its texts' ids, sizes and tokens, and the hashes of its words with how often they occur."""

    marks = whole([*_starts(order), END])

    def run(table: pa.Table) -> pa.Table:
        found = Words([common.unsqueezed(text.as_py()) for text in table["text"]], lower=True)  # of bytes: A-Z only
        (words,), sizes = found.hashes(), found.per_text
        hashes, which = np.unique(np.concatenate([words, marks]), return_inverse=True)
        sizes += order
        last = np.cumsum(sizes) - 1
        tokens = np.empty(sizes.sum(), np.int64)
        for k in range(order):  # the marks before, and the end
            tokens[last - sizes + 1 + k if k + 1 < order else last] = which[len(words) + k]
        text = np.repeat(np.arange(len(sizes)), sizes - order)
        tokens[np.arange(len(words)) + order * text + order - 1] = which[: len(words)]
        times = np.bincount(tokens, minlength=len(hashes))
        rank = np.empty(len(hashes), np.uint32)  # frequent words have small numbers, which take less
        rank[_by_times(times)] = np.arange(len(hashes))
        columns = {
            "block": table["block"][:1],
            "docs": pa.array([table["doc_id"].to_pylist()], pa.list_(pa.int64())),
            "train": pa.array([table["train"].to_pylist()], pa.list_(pa.bool_())),
            "sizes": pa.array([sizes], pa.list_(pa.int64())),
            "words": pa.array([_cell([*_planes(np.diff(hashes, prepend=np.uint64(0))), _packed(times)])], pa.list_(pa.binary())),
            "tokens": pa.array([_cell(_planes(rank[tokens]))], pa.list_(pa.binary())),
        }
        return pa.table(columns)

    return run


ENCODED = "block int, docs array<long>, train array<boolean>, sizes array<long>, words array<binary>, tokens array<binary>"


def _by_times(times: np.ndarray) -> np.ndarray:
    return np.argsort(-times, kind="stable")


def _words(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Increasing hashes, and how often each word occurs."""
    *planes, times = parts
    hashes = np.cumsum(_whole(planes, np.uint64), dtype=np.uint64)
    return hashes, _unpacked(times, len(hashes))


class Block:
    """The n-grams of a block, in an order that all passes reproduce."""

    def __init__(self, table: pa.Table, order: int) -> None:
        self.words, times = _words(next(_parts(table["words"])))  # by hash: the same order whatever the order of the rows
        tokens = _by_times(times).astype(np.int32)[_whole(next(_parts(table["tokens"])), np.uint32)]
        self.docs = table["docs"].combine_chunks().flatten()
        self.train = table["train"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        sizes = table["sizes"].combine_chunks().flatten().to_numpy()
        self.sizes = sizes - (order - 1)
        depth = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        trained = np.repeat(self.train, sizes)
        self.places = np.flatnonzero(depth >= order - 1)  # of tokens that are scored
        self.doc = np.repeat(np.arange(len(sizes)), self.sizes)
        self.levels, self.counts, self.grams = [], [], []
        for n in range(order):
            if n:
                full = np.flatnonzero(depth >= n)  # with n tokens before in the same text
                level = Level(which[full].astype(np.int64), tokens[full - n], len(self.words))
                which = np.zeros(len(tokens), np.int32)
                which[full] = level.which
                self.counts.append(np.bincount(level.which[trained[full]], minlength=len(level.first)))
                level.which = None
            else:
                level, which = Level.of_words(len(self.words)), tokens
                self.counts.append(np.bincount(tokens[trained], minlength=len(self.words)))
            self.levels.append(level)
            # Of each scored token: its n-gram, and the n-gram that is the context of the next longer one.
            self.grams.append((which[self.places], which[self.places - 1] if n + 1 < order else None))

    def deal(self, shards: int, often: np.ndarray) -> None:
        """Shards of the n-grams, and all lengths by shard; ``often``: the words that are frequent in the corpus."""
        key = self.words
        ended = np.zeros(1, bool)  # by a word that is not frequent: what goes on from there stays in its shard
        self.shards = []
        for n, level in enumerate(self.levels):
            if n:
                stays = ended[level.ending]
                key = np.where(stays, key[level.ending], mix(key[level.ending], self.words[level.first]))
                ended = stays | ~often[level.first]
            else:
                ended = ~often
            self.shards.append(_shard(key, shards))
        shard = np.concatenate(self.shards)
        self.order = np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")
        self.begin = np.searchsorted(shard[self.order], np.arange(shards + 1))

    def cells(self, ids: np.ndarray, shards: int) -> Iterator[list[bytes]]:
        """For each shard the trie, from the last word backwards, of its n-grams.

        Parts: of each length the ids of first words, and but for the longest how many nodes follow each one and
        which are n-grams of this shard (others only lead there); last the training counts of these.
        """
        levels, child = [], None  # child: of the nodes one longer, their endings here, by shard
        for n in range(len(self.levels) - 1, -1, -1):
            level, shard = self.levels[n], self.shards[n]
            size = len(level.first)
            own = shard * size + np.arange(size)
            if child is None:
                nodes = np.sort(own)
            else:
                child = child[0] * size + child[1]
                nodes = np.unique(np.concatenate([own, child[np.diff(child, prepend=-1) > 0]]))
            where, node = np.divmod(nodes, size)
            many = asked = None
            if child is not None:
                many = np.bincount(np.searchsorted(nodes, child), minlength=len(nodes))
                asked = shard[node] == where
            begin = np.searchsorted(where, np.arange(shards + 1))
            levels.append((begin, ids[level.first[node]].astype(np.uint32), many, asked))
            child = where, level.ending[node]
        counts = np.concatenate(self.counts)[self.order]
        for s in range(shards):
            parts = []
            for begin, words, many, asked in reversed(levels):
                some = slice(begin[s], begin[s + 1])
                parts += _planes(words[some])
                if many is not None:
                    parts += [_packed(many[some]), np.packbits(asked[some]).tobytes()]
            yield [*parts, _packed(counts[self.begin[s] : self.begin[s + 1]])]

    def by_level(self, entries: np.ndarray) -> list[np.ndarray]:
        """Values of the entries, in their dealt order, as one array a length."""
        out = np.empty_like(entries)
        out[self.order] = entries
        return np.split(out, np.cumsum([len(level.first) for level in self.levels])[:-1])


def _packed(counts: np.ndarray) -> bytes:
    """Counts as bytes, most of them in one; those from 255 follow in full."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype(np.int64).tobytes()


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw, np.int64, offset=n)
    return counts


def _planes(numbers: np.ndarray) -> list[bytes]:
    """All lowest bytes, all next ones, and so on: equal bytes come together."""
    return [plane.tobytes() for plane in numbers.view(np.uint8).reshape(-1, numbers.itemsize).T]


def _whole(planes: list[bytes], kind: type) -> np.ndarray:
    """Numbers that were written by planes of bytes."""
    planes = np.stack([np.frombuffer(plane, np.uint8) for plane in planes], axis=1)
    return planes.view(kind).ravel()


def _cell(parts: Iterable[bytes]) -> list[bytes]:
    return [common.squeezed(part) for part in parts]


def _parts(column: pa.ChunkedArray) -> Iterator[list[bytes]]:
    """The parts of each row one after the other, so that only one row's are held uncompressed."""
    return ([common.unsqueezed(part) for part in parts.as_py()] for parts in column)


CELL = "block int, shard int, parts array<binary>"


def _cells(block: int, cells: Iterable[Iterable[bytes]]) -> pa.Table:
    """One row per shard."""
    parts = pa.array(map(_cell, cells), pa.list_(pa.binary()))
    columns = [pa.array([block] * len(parts), pa.int32()), pa.array(range(len(parts)), pa.int32()), parts]
    return pa.table(columns, ["block", "shard", "parts"])


def _list(shards: int):
    """One row per shard of words: the hashes of a block's words, as differences, and how often they occur."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for block, parts in zip(batch["block"].to_pylist(), _parts(batch["words"])):
            hashes, times = _words(parts)
            begin = np.searchsorted(_shard(hashes, shards), np.arange(shards + 1))
            some = [slice(a, b) for a, b in zip(begin, begin[1:])]
            rows.append(_cells(block, ([*_planes(np.diff(hashes[x], prepend=np.uint64(0))), _packed(times[x])] for x in some)))
        return pa.concat_tables(rows).combine_chunks().to_batches()[0]

    return run


def _number(order: int, shards: int, limit: int):
    """Ids of the words of a shard, the more frequent the smaller, and which ones occur more than ``limit`` times."""

    def run(table: pa.Table) -> pa.Table:
        each, times = zip(*map(_words, _parts(table["parts"])))
        hashes, which = np.unique(np.concatenate(each), return_inverse=True)
        total = np.bincount(which, np.concatenate(times), len(hashes))
        ids = np.empty(len(hashes), np.int64)
        ids[np.argsort(-total, kind="stable")] = np.arange(len(hashes))
        ids = ids * shards + table["shard"][0].as_py() + order - 1
        often = total > limit
        for k, mark in enumerate(whole(_starts(order))):  # as if frequent
            ids[hashes == mark], often[hashes == mark] = k, True
        if ids.size and ids.max() >= 1 << 32:
            raise ValueError("ids of words have 32 bits")
        ids = ids.astype(np.uint32)
        rows = np.split(which, np.cumsum([len(e) for e in each])[:-1])
        parts = [_cell([*_planes(ids[row]), np.packbits(often[row]).tobytes()]) for row in rows]
        return table.set_column(table.schema.get_field_index("parts"), "parts", pa.array(parts, pa.list_(pa.binary())))

    return run


def _bits(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def _ask(order: int, shards: int):
    """One row per shard: a block's n-grams and its training counts of them, and in the first one its frequent words."""

    def run(encoded: pa.Table, numbers: pa.Table) -> pa.Table:
        block = Block(encoded, order)
        ids, often = [], []
        for *planes, raw in _parts(numbers.sort_by("shard")["parts"]):
            ids.append(_whole(planes, np.uint32))
            often.append(_bits(raw, len(ids[-1])))
        often = np.concatenate(often)
        block.deal(shards, often)
        out = _cells(encoded["block"][0].as_py(), block.cells(np.concatenate(ids), shards))
        flags = [common.squeezed(np.packbits(often).tobytes())] + [None] * (shards - 1)
        return out.append_column("often", pa.array(flags, pa.binary()))

    return run


class Trie:
    """N-grams seen in training, by context and word."""

    def __init__(self, contexts, words, left, right, counts: np.ndarray, folder: str) -> None:
        """``contexts``, ``words``: increasing hashes and ids; ``left``, ``right``: their numbers, in order, for each n-gram."""
        per = np.bincount(left, minlength=len(contexts))
        pointer = np.concatenate([[0], np.cumsum(per)])
        last = right[pointer[1:] - 1]  # largest successor of each context
        base = np.concatenate([[0], np.cumsum(last + 1)])
        self.contexts = EliasFano(contexts, folder, "contexts")
        self.words = EliasFano(words, folder, "words")
        self.pointers = EliasFano(pointer, folder, "pointers")
        self.successors = EliasFano(base[left] + right, folder, "successors")
        self.bases = EliasFano(base, folder, "bases")
        self.frequencies = mapped(quantised(counts), folder, "frequencies")

    @staticmethod
    def _number(level: EliasFano, hashes: np.ndarray) -> np.ndarray:
        """Numbers of hashes in a level, -1 where they are not in it."""
        hashes = hashes.astype(np.int64)
        if not level.n:
            return np.full(len(hashes), -1)
        none, every = np.zeros(len(hashes), np.int64), np.full(len(hashes), level.n)
        at = level.successor(hashes, none, every)
        found = level.get(np.minimum(at, level.n - 1)) == hashes
        return np.where(found & (at < level.n), at, -1)

    def find(self, contexts: np.ndarray, words: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Levels of the n-grams (left, right), numbers of the given contexts and words; 0 where not seen."""
        out = np.zeros(len(left), np.uint16)
        if not self.contexts.n:
            return out
        context, word = self._number(self.contexts, contexts), self._number(self.words, words)[right]
        # Of each context: its range of successors, and where their values begin and end.
        pointers, bases = self.pointers.every(), self.bases.every()
        begin, end = pointers[context], np.where(context < 0, 0, pointers[context + 1])
        base, limit = bases[context], bases[context + 1]
        known = np.flatnonzero((context[left] >= 0) & (word >= 0))
        for at in range(0, len(known), 1 << 18):
            some = known[at : at + (1 << 18)]
            node = left[some]
            stop, value = end[node], base[node] + word[some]
            place = self.successors.successor(value, begin[node], stop)
            inside = np.flatnonzero((place < stop) & (value < limit[node]))
            inside = inside[self.successors.get(place[inside]) == value[inside]]
            out[some[inside]] = self.frequencies[place[inside]]
        return out


def _grams(parts: list[bytes], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Contexts and last words of the n-grams in a cell, by length."""
    planes = np.dtype(np.uint32).itemsize
    path: list[np.ndarray] = []  # words of each node, the last first
    for n in range(order):
        words = _whole(parts[:planes], np.uint32)
        path.append(words)
        asked, parts = np.ones(len(words), bool), parts[planes:]
        if n + 1 < order:
            many, asked, parts = _unpacked(parts[0], len(words)), _bits(parts[1], len(words)), parts[2:]
        context = np.zeros(np.count_nonzero(asked), np.uint64)  # the empty one
        for words in path[:0:-1]:
            context = mix(context, words[asked].astype(np.uint64))
        yield context, path[0][asked]
        if n + 1 < order:
            path = [np.repeat(words, many) for words in path]


def _used(numbers: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of n numbers that occur, and each one's place among them."""
    used = np.zeros(n, bool)
    used[numbers] = True
    return np.flatnonzero(used), (np.cumsum(used) - 1)[numbers]


def _answer(table: pa.Table, order: int) -> pa.Table:
    """The trie of a shard, and what it says about each block's n-grams, in the order they were asked."""
    of_context, of_word, counts, singles = [], [], [], []
    for *parts, raw in _parts(table["parts"]):
        contexts, words = zip(*_grams(parts, order))
        singles.append(len(words[0]))
        of_context += contexts
        of_word += words
        counts.append(_unpacked(raw, sum(map(len, words))))
    sizes = np.cumsum([len(c) for c in counts])
    contexts, of_context = np.unique(np.concatenate(of_context), return_inverse=True)
    of_word = np.concatenate(of_word)
    span = int(of_word.max(initial=0)) + 1
    asked, which = np.unique(of_context * span + of_word, return_inverse=True)
    del of_context, of_word
    total = np.zeros(len(asked), np.int64)
    np.add.at(total, which, np.concatenate(counts))
    del counts
    left = asked // span
    words, right = np.unique((asked - left * span).astype(np.uint32), return_inverse=True)
    seen = total > 0
    some_contexts, inner_left = _used(left[seen], len(contexts))
    some_words, inner_right = _used(right[seen], len(words))
    with tempfile.TemporaryDirectory(prefix="trie-") as folder:
        trie = Trie(contexts[some_contexts], words[some_words], inner_left, inner_right, total[seen], folder)
        levels = trie.find(contexts, words, left, right)
    # Words alone come first (the empty context is the least); their counts are given as they are.
    alone = int(np.searchsorted(contexts[left], ROOT[0], side="right"))
    tokens = total[:alone] * (words[right[:alone]] >= order - 1)  # marks have the least ids
    each = [_cell([*_planes(levels[some]), _packed(total[some[:k]])]) for some, k in zip(np.split(which, sizes[:-1]), singles)]
    rows = len(each)
    return pa.table(
        {
            "block": table["block"],
            "shard": table["shard"],
            "parts": pa.array(each, pa.list_(pa.binary())),
            "often": table["often"],
            "n": pa.array([int(tokens.sum())] * rows, pa.int64()),
            "v": pa.array([int((tokens > 0).sum())] * rows, pa.int64()),
        }
    )


def _score(order: int, shards: int, prior: float):
    """The figures of each document."""

    def run(encoded: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(encoded, order)
        answers = answers.sort_by("shard")
        n, v = sum(answers["n"].to_pylist()), sum(answers["v"].to_pylist())
        block.deal(shards, _bits(common.unsqueezed(answers["often"][0].as_py()), len(block.words)))
        words, alone = len(block.words), block.order < len(block.words)  # the first level is the words
        each = np.diff(np.append(0, np.cumsum(alone))[block.begin])
        levels, exact = [], []
        for k, (*planes, raw) in zip(each, _parts(answers["parts"])):
            levels.append(_whole(planes, np.uint16))
            exact.append(_unpacked(raw, int(k)))
        counts = [counted(level) for level in block.by_level(np.concatenate(levels))]
        counts[0] = np.empty(words)
        counts[0][block.order[alone]] = np.concatenate(exact)
        lower = (counts[0] + 0.1) / (n + 0.1 * (v + 1))
        tokens = block.grams[0][0]
        p = lower[tokens]
        rows = len(block.sizes)

        def total(values: np.ndarray) -> pa.Array:
            return pa.array(np.bincount(block.doc, values, rows).astype(np.float64))

        base = total(np.log10(p))
        for k in range(1, order):
            context = counts[k - 1][block.grams[k - 1][1]]
            p = (np.minimum(counts[k][block.grams[k][0]], context) + prior * p) / (context + prior)
        return pa.table(
            {
                "doc_id": block.docs,
                "held_out": pa.array(~block.train),
                "n_tokens": pa.array(block.sizes),
                "n_known": pa.array(np.bincount(block.doc, counts[0][tokens] > 0, rows).astype(np.int64)),
                "train_tokens": pa.array([n] * rows, pa.int64()),
                "base_score": base,
                "score": total(np.log10(p)),
            }
        )

    return run


def _squeeze(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Texts compressed, as they are shuffled."""
    texts = [common.squeezed(t.as_buffer()) for t in batch["text"].cast(pa.binary())]
    return batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.binary()))


def score(
    docs: DataFrame,
    order: int = ORDER,
    prior: float = PRIOR,
    block_chars: int = BLOCK_CHARS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    if order < 1 or prior <= 0:
        raise ValueError("order must be at least 1 and prior above 0")
    spark = docs.sparkSession
    common.ready(spark)
    rows = common.texts(docs, key, text)
    chars = rows.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = max(common.partitions(spark), -(-chars // block_chars))
    shards = -(-blocks // 2)
    lists = -(-shards // 8)
    part = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = rows.select(
        "doc_id",
        "text",
        (part % 10 != 0).alias("train"),
        F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(blocks)).cast("int").alias("block"),
    )
    rows = common.map_batches(rows, _squeeze, "doc_id long, text binary, train boolean, block int")
    encoded = rows.repartition(blocks, "block").groupBy("block").applyInArrow(_encode(order), ENCODED)
    encoded = encoded.repartition(blocks, "block")  # all that follows reads this one exchange
    listed = common.map_batches(encoded, _list(lists), CELL)
    numbers = listed.groupBy("shard").applyInArrow(_number(order, lists, block_chars // RARE), CELL)
    by_block = encoded.groupBy("block")
    asked = by_block.cogroup(numbers.groupBy("block")).applyInArrow(_ask(order, shards), f"{CELL}, often binary")
    answers = asked.groupBy("shard").applyInArrow(
        lambda table: _answer(table, order), f"{CELL}, often binary, n long, v long"
    )
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return (
        by_block
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_score(order, shards, prior), schema)
    )
