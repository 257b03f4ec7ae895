"""Periodic runs, fingerprints and alignment against brute force."""

import hashlib
import random
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import ODD, SCHEMA, rows
from headway.llm import alignment, fingerprints, periodic_runs, queries

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ---- periodic runs --------------------------------------------------------


def all_runs(words, least=24, power=3):
    """Each diagonal from its start to its end; the smallest period of a stretch comes first."""
    n, out, known = len(words), [], set()
    for q in range(1, n // power + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            if j > i and j - i + q >= max(least, power * q) and (i - q, j) not in known:
                known.add((i - q, j))
                out.append((i - q, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out)


def made_up(rng):
    n, letters = rng.randint(20, 260), rng.choice([1, 2, 2, 3, 50])
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        start, period = rng.randrange(n), rng.randint(1, 60)
        for i in range(start + period, min(n, start + rng.randint(10, 200))):
            words[i] = words[i - period]
    return words * rng.choice([1, 1, 1, 4])


@pytest.mark.parametrize(("least", "power"), [(24, 3), (24, 4), (10, 3), (5, 5), (1, 3)])
def test_runs_are_those_of_all_diagonals(least, power):
    rng = random.Random(least * power)
    for _ in range(150):
        words = made_up(rng)
        assert periodic_runs.find_runs(np.array(words), least, power) == all_runs(words, least, power)


def test_runs_of_long_texts_cost_no_square():
    assert periodic_runs.find_runs(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]
    nested = np.tile(np.array([0] * 500 + [1]), 200)
    assert len(periodic_runs.find_runs(nested)) == 201


def test_runs_have_their_bounds():
    with pytest.raises(ValueError):
        periodic_runs.gram_size(24, 2)
    assert periodic_runs.gram_size(24, 3) == 16


def test_runs_of_odd_rows(spark, odd, none):
    more = [(21, "a b " * 30 + "c"), (22, "x " + "é\x1c   ż\n" * 12), (23, " ".join("word" for _ in range(24)))]
    pairs = [x for x in ODD if x[0] not in (9, 10)] + more
    table = odd.where("doc_id IS NULL OR doc_id NOT IN (9, 10)")
    table = table.unionByName(spark.createDataFrame([(i, t, "en", "s", 5, "n", 0.5, "o") for i, t in more], SCHEMA))
    found = sorted(map(tuple, periodic_runs.periodic_runs(table).collect()), key=str)
    expected = []
    for key, text in pairs:
        words = (text or "").encode().split()
        runs = all_runs(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        expected.append((key, len(words), runs, kept))
    found = [(key, n, [tuple(r) for r in runs], kept) for key, n, runs, kept in found]
    assert found == sorted(expected, key=str)
    assert found[[f[0] for f in found].index(21)][2:] == ([(0, 60, 2)], "a b c")
    long = periodic_runs.periodic_runs(odd.where("doc_id IN (9, 10)")).select("doc_id", "n_words", "runs")
    assert rows(long) == [(10, 30_002, [(0, 30_000, 9973)]), (9, 30_000, [(0, 30_000, 9973)])]  # squares modulo 9973
    assert periodic_runs.periodic_runs(none).count() == 0


def test_rows_without_an_id_are_not_repeated(spark, odd):
    before = rows(odd.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    after = rows(periodic_runs.repeat_some(odd))
    assert len(after) == len(before)
    assert [a for a in after if a[0] is None] == [b for b in before if b[0] is None]


# ---- fingerprints ---------------------------------------------------------


def slow_features(raw):
    w, span = fingerprints.WINDOW, fingerprints.SPAN
    n = len(raw) - w + 1
    if n < span:
        size = fingerprints.SHORT
        return [raw[p : p + size] for p in range(max(len(raw) - size + 1, min(1, len(raw))))]
    weight, rank = fingerprints._weights(), []
    for p in range(n):
        share = int(weight[w] - sum(weight[c] for c in Counter(raw[p : p + w]).values()))
        weak = share < fingerprints.LEAST * weight[w]
        rank.append((weak, 0 if weak else -abs(share - round(fingerprints.USUAL * weight[w]))))
    points = Counter(min(range(i, i + span), key=lambda p: (rank[p], p)) for i in range(n - span + 1))
    return [raw[p : p + w] for p in sorted(points) if points[p] >= fingerprints.POINTS and not rank[p][0]] or [raw[:w]]


@cache
def slow_chain(raw):
    features = [*dict.fromkeys(hashlib.sha1(f).digest() for f in slow_features(raw))]
    out = []
    for at in range(0, len(features), fingerprints.FILL):
        bits = np.zeros(fingerprints.BITS, np.uint8)
        for f in features[at : at + fingerprints.FILL]:
            for k in range(5):
                bits[int.from_bytes(f[4 * k : 4 * k + 4]) % fingerprints.BITS] = 1
        out.append(np.packbits(bits))
    return np.array(out)


def slow_prints(spark, pairs):
    frame = spark.createDataFrame([(i, t or "") for i, t in pairs], "doc_id long, text string")
    order = [tuple(r) for r in frame.orderBy("doc_id", F.xxhash64("text")).collect()]
    out = []
    for (key, text), (_, other) in zip(order, order[1:] + order[:1]):
        part = len(text) // 4
        edit = text[: len(text) - part] + other[:part]
        a, b, c = (slow_chain(x.encode()) for x in (text, edit, other))
        near = [round(fingerprints.likeness(a, x), 9) for x in (b, c)]
        out.append((key, len(text), edit, fingerprints._text(a), fingerprints._text(b), *near))
    return sorted(out, key=str)


def fast_prints(df, **options):
    found = [tuple(r) for r in fingerprints.fingerprints(df, **options).collect()]
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in found), key=str)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_fingerprints_of_odd_rows(spark, odd, none, parts):
    assert fast_prints(odd, parts=parts) == slow_prints(spark, ODD)
    assert fast_prints(none, parts=parts) == []
    one = odd.where("doc_id = 7")
    assert fast_prints(one, parts=parts) == slow_prints(spark, [x for x in ODD if x[0] == 7])


def test_fingerprints_of_a_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("length(text) < 900")
    expected = slow_prints(spark, [tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert fast_prints(docs, parts=7) == expected
    long = [r for r in expected if r[1] > 400]
    assert min(r[5] for r in long) > 0.5
    assert sorted(r[6] for r in long)[len(long) * 9 // 10] < 0.3


def test_features_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(4)
    texts = [bytes(rng.choices(b"etaoin shrdlu,.ABC", k=rng.choice([0, 5, 31, 62, 63, 64, 200, 5000]))) for _ in range(60)]
    whole = fingerprints.select(texts)
    for k, text in enumerate(texts):
        assert fingerprints.select([text])[0] == whole[k]
    monkeypatch.setattr(fingerprints, "PIECE", 97)
    assert fingerprints.select(texts) == whole


def test_likeness_has_its_ends():
    a, b = slow_chain(b"some words " * 3), slow_chain(b"quite another line of text")
    assert fingerprints.likeness(a, a) == 1
    assert fingerprints.likeness(a, b) == fingerprints.likeness(b, a) < 0.2
    empty = slow_chain(b"")
    assert fingerprints.likeness(empty, empty) == 1 and fingerprints.likeness(a, empty) == 0


# ---- alignment ------------------------------------------------------------


def slow_alignment(pairs):
    sides = alignment.Sides(open(BYTE, "rb").read(), open(PIECE, "rb").read())
    library, other = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    library.encode_special_tokens = True
    docs, counts = [], Counter()
    for key, text in pairs:
        text = text or ""
        a = library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = other.encode(text, out_type=int)
        raw = (" " + text).encode()
        if b"".join(sides.bytes_a[i] for i in a) != raw or b"".join(sides.bytes_b[i] for i in b) != raw:
            a = b = []
        spans = []
        for ids, size in ((a, sides.size_a), (b, sides.size_b)):
            ends = np.cumsum([size[i] for i in ids]).tolist()
            spans.append([(i, e - int(size[i]), e) for i, e in zip(ids, ends)])
        over = sum(min(x[2], y[2]) > max(x[1], y[1]) for x in spans[0] for y in spans[1] if x[1] < y[2]) if len(a) < 2000 else None
        ends_b = {e: i for i, _, e in spans[1]}
        links = [(i, ends_b[e], e) for i, _, e in spans[0] if e in ends_b]
        counts.update(x[:2] for x in links)
        groups, low = [], 0
        for _, _, e in links:
            groups.append("|".join(",".join(str(i) for i, s, t in side if s >= low and t <= e) for side in spans) if len(a) < 2000 else "")
            low = e
        docs.append((key, len(a), len(b), len(links), over, links, ";".join(groups)))
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for key, n_a, n_b, n, over, links, groups in docs:
        best = sum(counts[x[:2]] == top[x[1]] for x in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append((key, n_a, n_b, n, n, best, sum(counts[x[:2]] for x in links), over, digest, groups, links))
    return out


FIELDS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "n_overlaps", "groups_sha256", "groups", "links")


def check_alignment(df, pairs):
    """All figures, groups and links, as ids and places."""
    found = alignment.align(df, BYTE, PIECE, full=True).select(*FIELDS).collect()
    found = sorted(([*r[:10], [tuple(x) for x in r[10]]] for r in found), key=str)
    expected = sorted(map(list, slow_alignment(pairs)), key=str)
    for a, b in zip(found, expected, strict=True):
        if b[7] is None:  # too long for all pairs
            a[7:10] = b[7:10]
        assert a == b


def test_alignment_of_odd_rows(spark, odd, none):
    marks = [(31, "x "), (32, "  two  spaces \n here"), (33, "a▁b ▁ c"), (34, "<s> </s> <unk> <0x0A> <|endoftext|>"), (35, "﻿​ ́e")]
    table = odd.unionByName(spark.createDataFrame([(i, t, "en", "s", 5, "n", 0.5, "o") for i, t in marks], SCHEMA))
    check_alignment(table, ODD + marks)
    assert alignment.align(none, BYTE, PIECE).count() == 0


def test_alignment_of_a_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("length(text) < 700")
    check_alignment(docs.repartition(5), [tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_units_are_cut_where_both_sides_cut():
    sides = alignment.Sides(open(BYTE, "rb").read(), open(PIECE, "rb").read())
    bits = [" ", "  ", "\n", "\t", "▁", "a", "The", "'s", "9", "é", "日本", "\x00", "\x1c", "\x85", "\xa0", "　", "<|endoftext|>", "</s>", "ﬁ", "!!", "😀", "x" * 50, "\r\n", "́"]
    rng = random.Random(9)
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 12))) for _ in range(3000)]
    found = [([], []) for _ in texts]
    alignment.UNITS, kept = 100, alignment.UNITS
    for ids_a, doc_a, ids_b, doc_b in sides.parts(texts):
        for side, ids, docs in ((0, ids_a, doc_a), (1, ids_b, doc_b)):
            for i, doc in zip(ids.tolist(), docs.tolist()):
                found[doc][side].append(i)
    alignment.UNITS = kept
    for text, both in zip(texts, found):
        a = sides.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sides.b.encode(text, out_type=int)
        raw = (" " + text).encode()
        if b"".join(sides.bytes_a[x] for x in a) != raw or b"".join(sides.bytes_b[x] for x in b) != raw:
            a = b = []
        assert both == (a, b)


# ---- registered queries ---------------------------------------------------


def test_queries_derive_digests(spark, small):
    made = {n: queries.QUERIES[n](spark, small) for n in ("op11_improbable_features", "op12_diagonal_runs", "op13_asof_alignment")}
    kinds = {n: dict(d.dtypes) for n, d in made.items()}
    assert all(k == "bigint" for c, k in kinds["op13_asof_alignment"].items() if c != "groups_sha256")
    assert kinds["op12_diagonal_runs"]["runs_sha256"] == "string" and kinds["op12_diagonal_runs"]["start"] == "bigint"
    n = spark.read.parquet(f"{small}/documents.parquet").count()
    for name, df in made.items():
        assert df.count() == n, name
