"""Byte-level BPE with word ends: encoding by a segment tree over adjacent pair ranks.

The leaves hold ``rank * width + position`` of each adjacent pair, so the root
is the leftmost pair of lowest rank. A merge changes three leaves, and each
change climbs the tree in log2(width) steps, until the root holds no pair.
Many words go through their trees in lockstep, one row of an array each; long
words (unbroken junk) have a tree of their own.

Nulls count as the empty text, which has no ids (digest of the empty string).
Texts of any length are encoded whole; equal rows give equal results; an empty
table gives an empty result; only the two named columns are read.
"""

from __future__ import annotations

import gc
import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from . import common
from .words import Words

NONE = np.int64(1) << 60
_BEYOND = regex.compile("[^\\x00-\\u024f]").search
LOCKSTEP = 64  # words up to so many symbols share an array
ROWS = 2_000  # words of one array: its trees stay in the cache of a core


def _byte_names() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next free code point from 256."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in keep else next(spare)) for b in range(256)]


class Model:
    """The parts of a tokenizer file that encoding and decoding need."""

    def __init__(self, data: bytes) -> None:
        file = json.loads(data)
        model = file["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        names = _byte_names()
        self.library = Tokenizer.from_str(data.decode())
        self.byte = {name: b for b, name in enumerate(names)}
        self.first = np.array([vocab[x] for x in names], np.int64)
        self.last = np.array([vocab[x + end] for x in names], np.int64)
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        every = vocab | self.special
        self.size = max(every.values()) + 1
        self.names = [""] * self.size
        for token, i in every.items():
            self.names[i] = token
        split = file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split).findall
        marks = "|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True))
        self.marks = regex.compile(f"({marks})") if marks else None
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b[: len(b)]] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.slot = {int(k): (int(r), int(m)) for k, r, m in zip(self.keys, self.ranks, self.made)}

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or NONE) and merged symbol of each pair."""
        want = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        hit = self.keys[at] == want
        return np.where(hit, self.ranks[at], NONE), self.made[at]

    # -- words ----------------------------------------------------------------------------------

    def split(self, text: str) -> list[str]:
        """Normalised words of a text without white space and special strings.

        Up to the Latin letters of two bytes all versions of Unicode agree and
        composing changes nothing; beyond, the file's own normaliser and word
        pattern say what a letter is.
        """
        if text.isascii() or not _BEYOND(text):
            low = text.lower()
            return [low] if low.isalpha() else self.words(low)  # letters alone are one word
        plain = self.library.normalizer.normalize_str(text)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(plain)
        return [bytes(map(self.byte.__getitem__, piece)).decode() for piece, _ in pieces]

    def parts(self, chunk: str) -> list[str]:
        """The words and special strings of a chunk without white space."""
        if not self.marks or "<|" not in chunk:
            return self.split(chunk)
        out: list[str] = []
        for piece in self.marks.split(chunk):
            out += [piece] if piece in self.special else self.split(piece)
        return out

    # -- segment trees --------------------------------------------------------------------------

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word."""
        return [np.frombuffer(x, np.int64).tolist() for x in self.encode_bytes(words, np.dtype(np.int64))]

    def encode_bytes(self, words: list[str], kind: np.dtype) -> list[bytes]:
        """The ids of each word as numbers of the given type."""
        raw = [w.encode() for w in words]
        out = [b""] * len(words)
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        widths = 1 << np.maximum(1, np.frexp(sizes - 1)[1])  # the power of two that holds each word
        for text in self.special.keys() & set(words):
            for k in [k for k, w in enumerate(words) if w == text]:
                out[k] = np.array([self.special[text]], kind).tobytes()
                widths[k] = 0
        for width in np.unique(widths[widths > 0]).tolist():
            members = np.flatnonzero(widths == width).tolist()
            if width > LOCKSTEP:
                for k in members:
                    out[k] = np.array(self._one_tree(raw[k], width), kind).tobytes()
                continue
            for at in range(0, len(members), ROWS):
                some = members[at : at + ROWS]
                ids, ends = self._lockstep([raw[k] for k in some], width)
                packed, begin = ids.astype(kind).tobytes(), 0
                for k, end in zip(some, (ends * kind.itemsize).tolist()):
                    out[k], begin = packed[begin:end], end
        return out

    def _symbols(self, raw: bytes) -> np.ndarray:
        codes = np.frombuffer(raw, np.uint8)
        symbols = self.first[codes]
        symbols[-1] = self.last[codes[-1]]
        return symbols

    def _lockstep(self, raw: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and where each word's end."""
        rows, bits = len(raw), width.bit_length() - 1
        sizes = np.array([len(b) for b in raw])
        codes = np.frombuffer(b"".join(b.ljust(width, b"\0") for b in raw), np.uint8).reshape(rows, width)
        symbols = self.first[codes]
        every = np.arange(rows)
        symbols[every, sizes - 1] = self.last[codes[every, sizes - 1]]
        place = np.arange(width)
        symbols[place >= sizes[:, None]] = -1
        before = np.tile(place - 1, (rows, 1))
        after = np.tile(place + 1, (rows, 1))
        after[after >= sizes[:, None]] = -1
        tree = np.full((rows, 2 * width), NONE)
        rank, _ = self.look(symbols[:, :-1], symbols[:, 1:])
        some = (rank < NONE) & (place[1:] < sizes[:, None])
        tree[:, width : 2 * width - 1][some] = ((rank << bits) + place[:-1])[some]
        for level in range(bits - 1, -1, -1):
            low = 1 << level
            tree[:, low : 2 * low] = np.minimum(tree[:, 2 * low : 4 * low : 2], tree[:, 2 * low + 1 : 4 * low : 2])
        row = np.flatnonzero(tree[:, 1] < NONE)
        while len(row):
            at = tree[row, 1] & (width - 1)
            gone = after[row, at]
            _, made = self.look(symbols[row, at], symbols[row, gone])
            symbols[row, at], symbols[row, gone] = made, -1
            then = after[row, gone]
            after[row, at] = then
            has = then >= 0
            before[row[has], then[has]] = at[has]
            prior = before[row, at]
            fresh = np.full((3, len(row)), NONE)  # the pairs (at, then), (prior, at) and the one gone
            rank, _ = self.look(made[has], symbols[row[has], then[has]])
            fresh[0, has] = np.where(rank < NONE, (rank << bits) + at[has], NONE)
            had = prior >= 0
            rank, _ = self.look(symbols[row[had], prior[had]], made[had])
            fresh[1, had] = np.where(rank < NONE, (rank << bits) + prior[had], NONE)
            who = np.concatenate([row, row[had], row])
            node = np.concatenate([at, prior[had], gone]) + width
            tree[who, node] = np.concatenate([fresh[0], fresh[1, had], fresh[2]])
            for _ in range(bits):
                node >>= 1
                tree[who, node] = np.minimum(tree[who, 2 * node], tree[who, 2 * node + 1])
            row = row[tree[row, 1] < NONE]
        left = symbols >= 0
        return symbols[left], np.cumsum(left.sum(axis=1))

    def _one_tree(self, raw: bytes, width: int) -> list[int]:
        symbols = self._symbols(raw).tolist()
        n, slot, size, none = len(symbols), self.slot, self.size, (int(NONE), -1)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        tree = [int(NONE)] * (2 * width)
        for k in range(n - 1):
            rank, _ = slot.get(symbols[k] * size + symbols[k + 1], none)
            if rank < NONE:
                tree[width + k] = rank * width + k
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(k: int, other: int) -> None:
            rank = slot.get(symbols[k] * size + symbols[other], none)[0] if other >= 0 else int(NONE)
            node = width + k
            tree[node] = rank * width + k if rank < NONE else int(NONE)
            while node > 1:
                node >>= 1
                tree[node] = min(tree[2 * node], tree[2 * node + 1])

        while tree[1] < NONE:
            at = tree[1] % width
            gone = after[at]
            symbols[at] = slot[symbols[at] * size + symbols[gone]][1]
            symbols[gone] = -1
            then = after[at] = after[gone]
            if then >= 0:
                before[then] = at
            put(gone, -1)
            put(at, then)
            if before[at] >= 0:
                put(before[at], at)
        return [s for s in symbols if s >= 0]


class Encoder:
    """Ids of white-space chunks and words, kept for the length of a task in bounded caches."""

    def __init__(self, data: bytes) -> None:
        self.model = Model(data)
        self.word: dict[str, tuple[str, str]] = {}
        self.chunk: dict[str, tuple[str, str]] = {}
        self.decimal = [str(i) for i in range(self.model.size)]

    def learn(self, found: set[str]) -> None:
        """Fill ``chunk``: the decimal ids and the token texts of each chunk, joined by spaces."""
        if len(self.chunk) > common.CACHE_ENTRIES:
            self.chunk.clear()
        if len(self.word) > common.CACHE_ENTRIES:
            self.word.clear()
        lasting = gc.isenabled()
        gc.disable()  # nothing here is cyclic, and looking for cycles among so many entries takes long
        model, word, decimal, names = self.model, self.word, self.decimal, self.model.names
        parts = [(c, model.parts(c)) for c in found - self.chunk.keys()]
        new = list({w for _, part in parts for w in part} - word.keys())
        for w, ids in zip(new, model.encode_words(new)):
            word[w] = (" ".join([decimal[i] for i in ids]), " ".join([names[i] for i in ids]))
        for c, part in parts:
            if len(part) == 1:
                self.chunk[c] = word[part[0]]
            else:
                pairs = [word[w] for w in part]
                self.chunk[c] = (" ".join([p[0] for p in pairs]), " ".join([p[1] for p in pairs]))
        if lasting:
            gc.enable()


class IdBytes:
    """The ids of a text as little-endian bytes, with those of words and chunks kept in bounded caches.

    Chunks are known by 126 bits of hashes: they are sorted by the first 63, and the others tell when that is not enough.
    """

    def __init__(self, data: bytes) -> None:
        self.model = Model(data)
        self.kind = np.dtype("<u2" if self.model.size <= 1 << 16 else "<u4")
        self.word: dict[str, bytes] = {}
        self.forget()

    def forget(self) -> None:
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)  # hashes of chunks, the first increasing
        self.begin, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)  # where their ids are
        self.ids = np.zeros(0, self.kind)

    def encode(self, texts: list[str]) -> list[bytes]:
        lasting = gc.isenabled()
        gc.disable()  # as above
        if len(self.keys) > 2 * common.CACHE_ENTRIES:
            self.forget()
        if len(self.word) > common.CACHE_ENTRIES:
            self.word.clear()
        found = Words([common.plain_spaces(t).encode() for t in texts])
        hashes, checks = found.hashes((0, 1))
        keys, which = np.unique(hashes, return_inverse=True)
        example = np.empty(len(keys), np.int64)
        example[which] = np.arange(len(which))
        self._learn(keys, checks[example], found, example)
        place = np.searchsorted(self.keys, keys)
        if (self.checks[place][which] == checks).all():
            begin, sizes = self.begin[place][which], self.sizes[place][which]
            ends = np.cumsum(sizes)
            at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + sizes, sizes)
            packed = self.ids[at].tobytes()
            bounds = np.append(0, ends)[np.append(0, np.cumsum(found.per_text))] * self.kind.itemsize
            bounds = bounds.tolist()
            out = [packed[a:b] for a, b in zip(bounds, bounds[1:])]
        else:  # two chunks with the same first hash
            every = self._ids([c.decode() for c in found.bytes(np.arange(len(which)))])
            bounds = np.append(0, np.cumsum(found.per_text)).tolist()
            out = [b"".join(every[a:b]) for a, b in zip(bounds, bounds[1:])]
        if lasting:
            gc.enable()
        return out

    def _learn(self, keys: np.ndarray, checks: np.ndarray, found: Words, example: np.ndarray) -> None:
        """Add those of the chunks, given by increasing hashes, that are not known."""
        place = np.searchsorted(self.keys, keys)
        fresh = np.ones(len(keys), bool)
        inside = place < len(self.keys)
        fresh[inside] = self.keys[place[inside]] != keys[inside]
        fresh = np.flatnonzero(fresh)
        ids = self._ids([c.decode() for c in found.bytes(example[fresh])])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind.itemsize
        begin = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), self.kind)])
        place = place[fresh]
        self.keys, self.checks = np.insert(self.keys, place, keys[fresh]), np.insert(self.checks, place, checks[fresh])
        self.begin, self.sizes = np.insert(self.begin, place, begin), np.insert(self.sizes, place, sizes)

    def _ids(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk."""
        parts = [[c.lower()] if c.isascii() and c.isalpha() else self.model.parts(c) for c in chunks]
        words = list({w for part in parts for w in part} - self.word.keys())
        self.word.update(zip(words, self.model.encode_bytes(words, self.kind)))
        get = self.word.__getitem__
        return [get(part[0]) if len(part) == 1 else b"".join(map(get, part)) for part in parts]


@lru_cache(1)
def kept_bytes(data: bytes) -> IdBytes:
    """One for each Python worker, so that tasks share the caches."""
    return IdBytes(data)


@lru_cache(1)
def kept_encoder(data: bytes) -> Encoder:
    """One for each Python worker, so that tasks share the caches."""
    return Encoder(data)


def encode(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", full: bool = False
) -> DataFrame:
    """Per row: doc_id, n_tokens, digests of the decimal ids and of the decoded text.

    Decoding is the library's default without a decoder: token texts joined by
    one space. ``full`` adds the ids (``ids`` array) and the decoded text itself.
    """
    common.ready(docs.sparkSession)
    data = common.vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(data.value)
        for batch in batches:
            rows = [common.chunks(t) for t in batch["text"].to_pylist()]
            encoder.learn({c for r in rows for c in r})
            known = encoder.chunk
            counts, ids_sha, text_sha, every, decoded = [], [], [], [], []
            for row in rows:
                pairs = [p for p in map(known.__getitem__, row) if p[0]]
                ids = " ".join([p[0] for p in pairs])
                plain = " ".join([p[1] for p in pairs])
                counts.append(ids.count(" ") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                text_sha.append(hashlib.sha256(plain.encode()).hexdigest())
                if full:
                    every.append([int(x) for x in ids.split()])
                    decoded.append(plain)
            columns = [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if full:
                columns += [pa.array(every, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if full else ""
    return common.texts(docs, key, text).mapInArrow(run, schema)
