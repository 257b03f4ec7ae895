"""Alignment of two tokenizers' tokens by the bytes they stand for.

Side A is a byte-level BPE of the tokenizers library and reads a space before the text;
side B is a sentencepiece model, which adds that space itself. Both sides' token bytes,
joined, are then the same, and a token is a byte range. Per Arrow batch, with the
document as key, ``merge_asof`` finds for the start of each token the token of the other
side that covers it. The union of both directions holds every pair of overlapping
tokens; pairs that also end at the same byte are the links, and they end the groups, the
smallest parts in which both sides' tokens cover the same bytes.

How often a pair of ids is linked in all documents decides which of a document's links
are usual. A batch is a block: it counts its own pairs first, the blocks' counts are
summed by pair, and each block gets back the totals of the pairs it holds, so what is
shuffled are a block's different pairs and each document's list of them.

Nulls count as the empty text. Empty texts, and those whose bytes one of the tokenizers
changes, have no tokens: all figures are zero and the groups are empty. Special strings
inside texts are plain text. Texts of any length are read whole; rows with a null or a
repeated id are counted like others; an empty table gives an empty result; only the two
named columns are read.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .bpe import _byte_names

SPACE = "▁"
#: A space behind white space or the space's own sign is no sure cut; one behind any other character is.
_LOOSE = re.compile(f"[\\s{SPACE}] ")
_NONE = np.zeros(0, np.int64)
#: Units that are aligned at a time, of however many documents: groups end with each unit, so a long text needs no more room.
UNITS = 30_000
_CUT = re.compile(f"(?<=[^\\s{SPACE}])(?= )")


class Sides:
    """Both tokenizers, and of each id its bytes, their number, and its decimal in a list of groups."""

    def __init__(self, a: bytes, b: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a.decode())
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        byte = {name: k for k, name in enumerate(_byte_names())}
        names = {i: token for token, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [bytes(byte[c] for c in names.get(i, "") if c in byte) for i in range(max(names) + 1)]
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.size_a = np.array([len(x) for x in self.bytes_a])
        self.size_b = np.array([len(x) for x in self.bytes_b])
        self.forget()
        # An id with what follows it inside a group and at the end of its side.
        self.text_a = np.array([f"{i}{mark}" for mark in ",|" for i in range(len(self.bytes_a))], object)
        self.text_b = np.array([f"{i}{mark}" for mark in ",;" for i in range(len(self.bytes_b))], object)

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[1:-1], 16)])
        return self.b.id_to_piece(i).replace(SPACE, " ").encode()

    def units(self, text: str) -> list[str]:
        """The parts between single spaces behind a solid character, where both sides always cut; that space left out."""
        if not _LOOSE.search(text) and text[:1] != " ":
            return text.split(" ")
        return [u[1:] for u in _CUT.split(" " + text)]

    def learn(self, new: list[str]) -> None:
        """Number the units, and keep the ids of each on both sides; one whose token bytes are not its own is bad."""
        # Units that end solid can stand one behind the other in one text; a lone space at a text's end is one more.
        solid = [u for u in new if u[-1:] != SPACE and u[-1:].strip()]
        loose = [*(set(new) - set(solid))]
        units = solid + loose
        raw = [b" " + u.encode() for u in units]
        ends = np.cumsum([len(x) for x in raw])
        texts = [" " + " ".join(solid[at : at + 20_000]) for at in range(0, len(solid), 20_000)]
        every = self.a.encode_batch_fast(texts + [" " + u for u in loose], add_special_tokens=False)
        a = np.fromiter(chain.from_iterable([x.ids for x in every]), np.int64)
        n_a = np.diff(np.searchsorted(np.cumsum(self.size_a[a]), ends, "right"), prepend=0)
        lists = [b or [self.b.piece_to_id(SPACE)] for b in self.b.encode(units, out_type=int, num_threads=1)]
        b = np.fromiter(chain.from_iterable(lists), np.int64)
        n_b = np.array([len(x) for x in lists])
        bad = np.zeros(len(units), bool)
        joined = b"".join(raw)
        same = joined == b"".join(map(self.bytes_a.__getitem__, a.tolist())) == b"".join(map(self.bytes_b.__getitem__, b.tolist()))
        if not same or (np.cumsum(self.size_b[b])[np.cumsum(n_b) - 1] != ends).any():
            # Some unit differs on some side: each for itself.
            lists_a = [x.ids for x in self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]
            for k, (whole, one, two) in enumerate(zip(raw, lists_a, lists)):
                bad[k] = not (b"".join([self.bytes_a[i] for i in one]) == whole == b"".join([self.bytes_b[i] for i in two]))
            a, n_a = np.fromiter(chain.from_iterable(lists_a), np.int64), np.array([len(x) for x in lists_a])
        self.code.update(zip(units, range(len(self.bad), len(self.bad) + len(units))))
        self.bad = np.concatenate([self.bad, bad])
        self.ids = [np.concatenate([old, x.astype(old.dtype)]) for old, x in zip(self.ids, (a, b))]
        self.cuts = [np.concatenate([old, old[-1] + np.cumsum(n)]) for old, n in zip(self.cuts, (n_a, n_b))]

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.bad = np.zeros(0, bool)
        self.ids = [np.zeros(0, np.uint16 if len(x) <= 1 << 16 else np.uint32) for x in (self.bytes_a, self.bytes_b)]
        self.cuts = [np.zeros(1, np.int64), np.zeros(1, np.int64)]

    def number(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The units of all texts by number, and whose they are; none where token bytes are not the text's."""
        lasting = gc.isenabled()
        gc.disable()  # nothing here is cyclic, and looking for cycles among so many entries takes long
        rows = [self.units(t) if t else [] for t in texts]
        if len(self.code) > common.CACHE_ENTRIES * 4 // 3:
            self.forget()
        new = [*(set().union(*rows) - self.code.keys())]
        for at in range(0, len(new), UNITS):
            self.learn(new[at : at + UNITS])
        sizes = np.array([len(r) for r in rows])
        codes = np.fromiter(map(self.code.__getitem__, chain.from_iterable(rows)), np.int64, int(sizes.sum()))
        doc = np.repeat(np.arange(len(rows)), sizes)
        if lasting:
            gc.enable()
        fine = ~np.isin(doc, doc[self.bad[codes]]) if self.bad.any() else slice(None)
        return codes[fine], doc[fine]

    def tokens(self, side: int, codes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units on a side (0 or 1), and whose each is."""
        cuts = self.cuts[side]
        first, n = cuts[codes], cuts[codes + 1] - cuts[codes]
        upto = np.cumsum(n)
        at = np.repeat(first - upto + n, n) + np.arange(upto[-1])
        return self.ids[side][at].astype(np.int64), np.repeat(doc, n)

    def parts(self, texts: list[str]) -> Iterator[tuple[np.ndarray, ...]]:
        """(ids of A, their document, ids of B, theirs) for so many units at a time; both sides end with each unit."""
        codes, doc = self.number(texts)
        for at in range(0, len(codes), UNITS):
            some = codes[at : at + UNITS], doc[at : at + UNITS]
            yield *self.tokens(0, *some), *self.tokens(1, *some)


@lru_cache(1)
def kept_sides(a: bytes, b: bytes) -> Sides:
    """One pair for each Python worker."""
    return Sides(a, b)


def _ranges(size: np.ndarray, doc: np.ndarray) -> pd.DataFrame:
    """Each token's document, first byte and place, the documents one behind the other."""
    return pd.DataFrame({"start": np.cumsum(size) - size, "doc": doc, "token": np.arange(len(doc))})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Places (in A, in B) of all pairs of tokens of a document that share a byte; ``doc`` keys, starts ascend."""
    keys = ["start", "doc"]
    under_a = pd.merge_asof(a[keys], b, on="start", by="doc")["token"].to_numpy(np.int64)
    under_b = pd.merge_asof(b[keys], a, on="start", by="doc")["token"].to_numpy(np.int64)
    # Pairs with equal starts are found from both sides.
    more = a["start"].to_numpy()[under_b] != b["start"].to_numpy()
    left = np.concatenate([a["token"].to_numpy(), under_b[more]])
    return left, np.concatenate([under_a, b["token"].to_numpy()[more]])


def _group_texts(sides: Sides, ids_a, doc_a, ids_b, doc_b, last_a, last_b) -> Iterator[tuple[int, str]]:
    """``a1,a2|b1;a3|b2,b3`` of each document, given each group's last tokens on both sides."""
    end_a, end_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    end_a[last_a] = end_b[last_b] = True
    group_a, group_b = np.cumsum(end_a) - end_a, np.cumsum(end_b) - end_b
    parts = np.empty(len(ids_a) + len(ids_b), object)
    before_b, upto_a = np.concatenate([[0], last_b + 1]), last_a + 1
    parts[np.arange(len(ids_a)) + before_b[group_a]] = sides.text_a[ids_a + end_a * len(sides.bytes_a)]
    parts[np.arange(len(ids_b)) + upto_a[group_b]] = sides.text_b[ids_b + end_b * len(sides.bytes_b)]
    every = parts.tolist()
    found, first_a = np.unique(doc_a, return_index=True)
    first = first_a + np.searchsorted(doc_b, found)
    for doc, i, j in zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(every)]):
        yield doc, "".join(every[i:j])[:-1]


FIGURES = ("n_a", "n_b", "n_groups", "n_overlaps", "n_links")
LINKS = "links array<struct<a: int, b: int, end: long>>"


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", full: bool = False) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_overlaps, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` counts links whose pair is linked as often as the B id is with any A id in all
    documents; ``count_sum`` adds the pairs' counts over the links. ``full`` adds the groups as
    text and the links as ids with the byte (of space and text) they end before.
    """
    spark = docs.sparkSession
    common.ready(spark)
    data_a, data_b = common.vocabulary(spark, path_a), common.vocabulary(spark, path_b)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, block = kept_sides(data_a.value, data_b.value), TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, base = batch.num_rows, 0
            figures = np.zeros((4, rows), np.int64)  # tokens of A and B, overlaps, links
            groups: list[list[str]] = [[] for _ in range(rows)]
            begin = np.full(rows, -1)  # first byte of each document
            linked = []  # document, pair and last byte of each link
            for ids_a, doc_a, ids_b, doc_b in sides.parts(batch["text"].to_pylist()):
                size_a, size_b = sides.size_a[ids_a], sides.size_b[ids_b]
                left, right = overlaps(_ranges(size_a, doc_a), _ranges(size_b, doc_b))
                end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
                ending = end_a[left] == end_b[right]
                last_a, last_b = np.sort(left[ending]), np.sort(right[ending])  # links: one ends each group
                for row, docs_of in enumerate((doc_a, doc_b, doc_a[left], doc_a[last_a])):
                    figures[row] += np.bincount(docs_of, minlength=rows)
                for k, text_of in _group_texts(sides, ids_a, doc_a, ids_b, doc_b, last_a, last_b):
                    groups[k].append(text_of)
                found, at = np.unique(doc_a, return_index=True)
                begin[found] = np.where(begin[found] < 0, base + end_a[at] - size_a[at], begin[found])
                linked.append((doc_a[last_a], ids_a[last_a] << 32 | ids_b[last_b], base + end_a[last_a]))
                base += int(end_a[-1])
            groups = [";".join(g) for g in groups]
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            link_doc, link_pair, link_end = map(np.concatenate, zip((_NONE, _NONE, _NONE), *linked))
            at, pairs = pd.factorize(link_pair)
            often = np.bincount(at, minlength=len(pairs))
            cuts = np.concatenate([[0], np.cumsum(figures[3])]).tolist()
            lists = [np.sort(at[i:j]).astype("<u4").tobytes() for i, j in zip(cuts, cuts[1:])]
            # The block's pairs lie in its first row.
            own = [None] * (rows - 1)
            columns = [
                pa.array([block] * rows, pa.int64()),
                batch["doc_id"],
                *(pa.array(figures[k], pa.int64()) for k in (0, 1, 3, 2, 3)),
                pa.array(digests),
                pa.array(lists, pa.binary()),
                pa.array([pairs.tolist(), *own], pa.list_(pa.int64())),
                pa.array([often.tolist(), *own], pa.list_(pa.int64())),
            ]
            names = ["block", "doc_id", *FIGURES, "groups_sha256", "at", "pairs", "often"]
            if full:
                links = [
                    {"a": x >> 32, "b": x & 0xFFFFFFFF, "end": e}
                    for x, e in zip(link_pair.tolist(), (link_end - begin[link_doc]).tolist())
                ]
                kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("end", pa.int64())]))
                columns += [pa.array(groups), pa.array([links[i:j] for i, j in zip(cuts, cuts[1:])], kind)]
                names += ["groups", "links"]
            yield pa.RecordBatch.from_arrays(columns, names)
            block += 1

    kept = "doc_id long, " + ", ".join(f"{c} long" for c in FIGURES) + ", groups_sha256 string"
    more = f", groups string, {LINKS}" if full else ""
    schema = f"block long, {kept}, at binary, pairs array<long>, often array<long>{more}"
    # Stored: block numbers and lists belong to one reading of the texts.
    blocks = common.stored(common.texts(docs, key, text).mapInArrow(step, schema), "alignment")

    held = blocks.where("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "often")).alias("at", "held"))
    held = held.select("block", "at", F.col("held.pairs").alias("pair"), F.col("held.often").alias("often"))
    counts = common.stored(held.groupBy("pair").agg(F.sum("often").alias("total")), "pairs")
    counts = counts.withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1))
    highest = counts.groupBy("b").agg(F.max("total").alias("highest"))
    counts = counts.join(highest, "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    known = held.select(F.col("block").alias("of"), "at", "pair").join(counts, "pair").select("of", "at", "total", "best")

    names = [c.split()[0] for c in kept.split(", ")]
    extra = ["groups", "links"] if full else []

    def sums(one: pa.Table, two: pa.Table) -> pa.Table:
        size = two.num_rows
        total, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        at = two["at"].to_numpy()
        total[at], best[at] = two["total"].to_numpy(), two["best"].to_numpy().astype(np.int64)
        lists = [np.frombuffer(x, "<u4") for x in one["at"].to_pylist()]
        out = one.select(names + extra)
        out = out.append_column("n_best", pa.array([int(best[x].sum()) for x in lists], pa.int64()))
        return out.append_column("count_sum", pa.array([int(total[x].sum()) for x in lists], pa.int64()))

    out = blocks.drop("pairs", "often").groupBy("block").cogroup(known.groupBy("of"))
    out = out.applyInArrow(sums, f"{kept}{more}, n_best long, count_sum long")
    return out.select("doc_id", *FIGURES, "n_best", "count_sum", "groups_sha256", *extra)
