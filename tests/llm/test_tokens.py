"""Tokenizers: the library is the brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import ODD, rows
from headway.llm import bpe, common, packing, token_counts

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(WORD)
PIECES = sentencepiece.SentencePieceProcessor(model_file=PIECE)
MODEL = bpe.Model(open(WORD, "rb").read())
MACHINE = token_counts.Transducer(open(PIECE, "rb").read())


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


# ---- BPE ------------------------------------------------------------------


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_bpe_is_the_librarys(text):
    words = [w for c in common.chunks(text) for w in MODEL.parts(c)]
    assert [i for part in MODEL.encode_words(words) for i in part] == ids(text)


def test_both_tree_forms_agree():
    r = random.Random(1)
    words = ["".join(r.choice("theanin0!é") for _ in range(r.randrange(1, 32))).encode() for _ in range(500)]
    for word in words:
        assert MODEL._lockstep([word], 64)[0].tolist() == MODEL._one_tree(word, 64)


def test_bpe_of_odd_rows(spark, odd, none):
    found = rows(bpe.encode(odd, WORD))
    want = []
    for i, text in ODD:
        own = ids(text or "")
        plain = LIBRARY.decode(own, skip_special_tokens=False)
        want.append((i, len(own), hashlib.sha256(" ".join(map(str, own)).encode()).hexdigest(), hashlib.sha256(plain.encode()).hexdigest()))
    assert found == sorted(want, key=str)
    assert bpe.encode(none, WORD).count() == 0


def test_full_encoding_round_trip(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for row in bpe.encode(docs, WORD, full=True).limit(20).collect():
        assert row.decoded == LIBRARY.decode(row.ids, skip_special_tokens=False)


def test_words_go_through_trees_that_stay_small(monkeypatch):
    seen, plain = [], bpe.Model._lockstep

    def watched(self, raw, width):
        seen.append(len(raw) * 2 * width * 8)
        return plain(self, raw, width)

    monkeypatch.setattr(bpe.Model, "_lockstep", watched)
    rng = random.Random(9)
    words = {"".join(rng.choices("abcdefghij", k=rng.choice([1, 2, 3, 4, 5, 8, 9, 16, 17, 63, 64, 65]))) for _ in range(30_000)}
    chunks = [*words, "<|endoftext|>", "Word", "WORD", "don't", "x<|endoftext|>y", "caf\u00e9", "\u00c9t\u00c9", "a1b2"]
    encoder = bpe.IdBytes(open(WORD, "rb").read())
    found = encoder.encode([*chunks, " ".join(chunks), ""])
    want = [ids(c) for c in chunks]
    assert [np.frombuffer(x, encoder.kind).tolist() for x in found] == [*want, [i for w in want for i in w], []]
    assert len(seen) > 7 and max(seen) <= 2 << 20  # bytes


def test_known_chunks_cost_no_object_each(monkeypatch):
    """A chunk met before is found among sorted hashes; only the new ones of a batch are looked at as strings."""
    asked = []
    plain = bpe.IdBytes._ids
    monkeypatch.setattr(bpe.IdBytes, "_ids", lambda self, chunks: asked.append(len(chunks)) or plain(self, chunks))
    encoder = bpe.IdBytes(open(WORD, "rb").read())
    texts = ["the cat, the  CAT\u3000the\xa0cat\n" * 50, "", "\x1c the\u2003cat, new\x1fword " * 50]
    for k in range(2):
        assert [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(texts)] == [ids(t) for t in texts]
    assert asked == [6, 0]


def test_chunks_of_equal_hash_are_told_apart(monkeypatch):
    hashes = bpe.Words.hashes
    monkeypatch.setattr(bpe.Words, "hashes", lambda self, seeds: [hashes(self, seeds)[0] % np.uint64(3), hashes(self, seeds)[1]])
    encoder = bpe.IdBytes(open(WORD, "rb").read())
    for texts in (["one two three four", "five six one", ""], ["seven", "one"]):
        assert [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(texts)] == [ids(t) for t in texts]


def test_a_full_cache_changes_nothing(spark, odd, monkeypatch):
    encoder = bpe.IdBytes(open(WORD, "rb").read())
    monkeypatch.setattr(common, "CACHE_ENTRIES", 1)
    for _ in range(2):
        got = encoder.encode([t or "" for _, t in ODD])
        assert [np.frombuffer(x, encoder.kind).tolist() for x in got] == [ids(t or "") for _, t in ODD]


# ---- transducer -----------------------------------------------------------


@given(st.text(alphabet=st.sampled_from("ab the▁in\n\t1=é日<s>"), max_size=80), st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_counts_are_the_librarys_for_any_chunks(text, size):
    old, token_counts.CHUNK = token_counts.CHUNK, size
    try:
        assert token_counts.count_tokens(MACHINE, text) == len(PIECES.encode(text))
    finally:
        token_counts.CHUNK = old


@given(st.lists(st.text(alphabet="ab▁", max_size=6), min_size=3, max_size=3))
@settings(max_examples=100, deadline=None)
def test_state_maps_compose_in_any_grouping(parts):
    a, b, c = (token_counts.state_map(MACHINE, p, first=k == 0) for k, p in enumerate(parts))
    left, right = a.then(MACHINE, b).then(MACHINE, c), a.then(MACHINE, b.then(MACHINE, c))
    assert (left.count, left.state, left.head) == (right.count, right.state, right.head)


def test_counts_of_odd_rows(odd, none):
    want = [(i, len((t or "").encode()), n := len(PIECES.encode(t or "")), n > 4096) for i, t in ODD]
    assert rows(token_counts.count(odd, PIECE)) == sorted(want, key=str)
    assert token_counts.count(none, PIECE).count() == 0


# ---- packing --------------------------------------------------------------


@pytest.mark.parametrize("bits", [1, 3])
def test_the_curve_visits_each_cell_once_and_steps_to_a_neighbour(bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = packing.hilbert(cells, bits)
    assert sorted(keys) == list(range(side**3))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check_packing(found, texts, length=2048):
    """``texts``: (doc_id, text) rows; ids may repeat or be null."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in sequences.values():
        place = 0
        for offset, n in sorted(parts):
            assert offset == place and n > 0
            place += n
        assert place == length or place & (place - 1) == 0 and place < length
    want = defaultdict(list)
    for i, t in texts:
        want[i].append([*ids(t or ""), 1])
    assert set(want) == set(pieces)
    for i, own in want.items():
        if len(own) > 1:  # several rows of one id: lengths only
            assert sum(map(len, own)) == sum(p.length for p in pieces[i])
            continue
        place = 0
        for p in sorted(pieces[i], key=lambda p: p.start):
            assert p.start == place and p.doc_tokens == len(own[0])
            part = np.array(own[0][place : place + p.length], "<u4")
            assert p.ids_crc32 == zlib.crc32(part.tobytes())
            place += p.length
        assert place == len(own[0])


def test_packing_of_odd_rows(odd, none):
    check_packing(packing.pack(odd, WORD).collect(), ODD)
    check_packing(packing.pack(odd, WORD, length=64).collect(), ODD, 64)
    assert packing.pack(none, WORD).count() == 0


def test_packing_of_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    found = packing.pack(docs, WORD).collect()
    check_packing(found, [tuple(r) for r in docs.collect()])


def test_copies_lie_together(spark):
    texts = [(k, f"alpha beta gamma {k}" if k % 2 else "entirely other words here") for k in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = sorted(packing.pack(docs, WORD).collect(), key=lambda r: (r.sequence_id, r.offset))
    even = [r.doc_id % 2 for r in found]
    assert sum(a != b for a, b in zip(even, even[1:])) < 20
