"""Language model against counting in Python; quality classifier by held-out accuracy."""

import collections
import math
import re
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import ODD
from headway.llm import common, ngram_lm, quality
from headway.llm.elias_fano import EliasFano
from headway.llm.words import Words


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (5, 3), (1000, 100), (1000, 10**6), (3000, 10**12)])
def test_elias_fano(n, top):
    random = np.random.default_rng(n)
    values = np.sort(random.integers(0, top, n))
    with tempfile.TemporaryDirectory() as folder:
        packed = EliasFano(values, folder, "x")
        assert (packed.get(np.arange(n)) == values).all()
        if n:
            want = random.integers(0, top + 5, 300)
            begin = random.integers(0, n, 300)
            end = np.minimum(n, begin + random.integers(0, n, 300))
            brute = [next((i for i in range(a, b) if values[i] >= x), b) for x, a, b in zip(want, begin, end)]
            assert packed.successor(want, begin, end).tolist() == brute


@pytest.mark.parametrize("n, top", [(0, 1), (3000, 2), (40_000, 10**4)])
def test_elias_fano_of_long_runs(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top, n) ** 2)
    with tempfile.TemporaryDirectory() as folder:
        packed = EliasFano(values, folder, "x")
        assert (packed.every() == values).all() and (packed.get(np.arange(n)) == values).all()
        want = np.arange(top + 3)
        found = packed.successor(want, np.zeros(len(want), np.int64), np.full(len(want), n))
        assert not n or (found == np.searchsorted(values, want)).all()


def lm_tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "\n"]


class SlowModel:
    """Counts of n-grams in dictionaries, interpolated by recursion."""

    def __init__(self, texts, order, prior):
        self.order, self.prior, self.grams = order, prior, collections.Counter()
        self.words = collections.Counter(w for t in texts for w in lm_tokens(t))
        for t in texts:
            ws = self.padded(t)
            for end in range(order - 1, len(ws)):
                self.grams.update(tuple(ws[end - k : end + 1]) for k in range(1, order))
        self.contexts = collections.Counter()
        for gram, c in self.grams.items():
            self.contexts[gram[:-1]] += c
        self.n, self.v = sum(self.words.values()), len(self.words)

    def padded(self, text):
        return [("start", k) for k in range(self.order - 1)] + lm_tokens(text)

    def p(self, context, word):
        if not context:
            return (self.words[word] + 0.1) / (self.n + 0.1 * (self.v + 1))
        lower = self.p(context[1:], word)
        return (self.grams[*context, word] + self.prior * lower) / (self.contexts[context] + self.prior)

    def score(self, text):
        ws, first = self.padded(text), self.order - 1
        return sum(math.log10(self.p(tuple(ws[k - first : k]), ws[k])) for k in range(first, len(ws)))


def brute_scores(texts, order=ngram_lm.ORDER, prior=ngram_lm.PRIOR):
    """(doc_id, n_tokens, n_known, train_tokens, base, score) of each row."""
    train = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 10 != 0
    model = SlowModel([t for i, t in texts if train(i)], order, prior)
    out = []
    for i, t in texts:
        ws = lm_tokens(t)
        base = sum(math.log10(model.p((), w)) for w in ws)
        out.append((i, len(ws), sum(model.words[w] > 0 for w in ws), model.n, base, model.score(t)))
    return out


def check_scores(found, texts, **how):
    want = sorted(brute_scores(texts, **how), key=str)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found), key=str)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for a, b in zip(got, want):
        assert a[4] == pytest.approx(b[4], rel=1e-9) and a[5] == pytest.approx(b[5], rel=1e-4, abs=1e-3)


def test_language_model_of_odd_rows(odd, none):
    check_scores(ngram_lm.score(odd).collect(), ODD)
    assert ngram_lm.score(none).count() == 0


@pytest.mark.parametrize("order, prior", [(1, 1.0), (3, 0.5), (5, 9.0)])
def test_language_model_of_any_order(odd, order, prior):
    check_scores(ngram_lm.score(odd, order, prior).collect(), ODD, order=order, prior=prior)


def test_the_default_model_tells_texts_by_more_than_pairs_of_words(spark):
    """Both texts have the same words and equally frequent pairs; "b" goes on otherwise behind "x a"."""
    rows = [(k, "x a b c z a b d" if k % 2 else "x a b c z a b d z") for k in range(400)]
    asked = [(1004, "x a b c"), (1001, "x a b d")]
    ids = {k for k, _ in asked}
    found = ngram_lm.score(spark.createDataFrame(rows + asked, "doc_id long, text string")).collect()
    check_scores(found, rows + asked, order=3)
    apart = ngram_lm.score(spark.createDataFrame(rows + asked, "doc_id long, text string"), order=2).collect()
    assert {r.doc_id: r.score for r in found if r.doc_id in ids} != {r.doc_id: r.score for r in apart if r.doc_id in ids}


def test_a_context_sums_to_one():
    model = SlowModel(["a b a", "a b c", "B a", ""], 3, ngram_lm.PRIOR)
    for context in [*model.contexts, ("a", "never"), ("never", "b")]:
        assert sum(model.p(context, w) for w in [*model.words, "unknown"]) == pytest.approx(1)


def test_a_trie_finds_what_was_seen():
    random = np.random.default_rng(7)
    contexts, words = (np.unique(random.integers(1, 1 << 63, k, dtype=np.uint64)) for k in (400, 150))
    seen = {}
    for left, right in zip(random.integers(0, 400, 3000), random.integers(0, 150, 3000)):
        if left % 5 and right % 7:  # contexts and words without any stay out of the trie
            seen[int(left), int(right)] = int(random.integers(1, 10 ** random.integers(1, 9)))
    pairs = np.array(sorted(seen))
    some_left, left = np.unique(pairs[:, 0], return_inverse=True)
    some_right, right = np.unique(pairs[:, 1], return_inverse=True)
    counts = np.array([seen[tuple(p)] for p in pairs.tolist()])
    asked = [(a, b) for a in range(400) for b in range(150)]
    with tempfile.TemporaryDirectory() as folder:
        trie = ngram_lm.Trie(contexts[some_left], words[some_right], left, right, counts, folder)
        found = ngram_lm.counted(trie.find(contexts, words, *np.array(asked).T))
    want = np.array([seen.get(pair, 0) for pair in asked])
    assert ((found == 0) == (want == 0)).all()
    assert found == pytest.approx(want, rel=5e-4) and (found[want <= ngram_lm.EXACT] == want[want <= ngram_lm.EXACT]).all()


def test_blocks_send_few_bytes_for_an_ngram():
    """Beside its counts a shard needs ids of words, not hashes of contexts (8 bytes an n-gram)."""
    random = np.random.default_rng(3)
    texts = [b" ".join(b"w%d" % w for w in random.zipf(1.3, 2000) % 20_000) for _ in range(100)]
    table = pa.table(
        {
            "block": pa.array([0] * len(texts), pa.int32()),
            "doc_id": pa.array(range(len(texts)), pa.int64()),
            "text": pa.array([common.squeezed(t) for t in texts], pa.binary()),
            "train": pa.array([True] * len(texts)),
        }
    )
    encoded = ngram_lm._encode(3)(table)
    listed = ngram_lm._list(1)(encoded.to_batches()[0])
    asked = ngram_lm._ask(3, 4)(encoded, ngram_lm._number(3, 1, 1000)(pa.Table.from_batches([listed])))
    grams = sum(len(level.first) for level in ngram_lm.Block(encoded, 3).levels)
    assert grams > 150_000 and asked.nbytes < 4 * grams


@pytest.mark.parametrize("limit", [0, 3, 10**9])
def test_shards_of_words_of_any_frequency(odd, monkeypatch, limit):
    """All words frequent, some, or none: n-grams lie in other shards, the scores are the same."""
    number = ngram_lm._number
    monkeypatch.setattr(ngram_lm, "_number", lambda order, shards, _: number(order, shards, limit))
    check_scores(ngram_lm.score(odd).collect(), ODD)


def test_words_of_a_text():
    random = np.random.default_rng(5)
    texts = [bytes(random.choice(list(b"aAbB\0\x85 \t\n\x0b\x0c\r\xc3\x9c"), n).tolist()) for n in (0, 1, 7, 8, 9, 500, 4000)]
    texts += [b"", b"x" * 8 + b" " + b"x" * 16 + b" " + b"x" * 300 + b" X" + b"x" * 299, b"a a\0 a\0\0", b" "]
    found = Words(texts, lower=True)
    hashes, other = found.hashes((0, 1))
    sizes = found.per_text
    assert found.bytes(np.arange(len(hashes))) == [w for t in texts for w in t.lower().split()]
    assert not (hashes == other).any()
    words = [w for t in texts for w in t.lower().split()]
    assert sizes.tolist() == [len(t.split()) for t in texts] and len(hashes) == len(words)
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))


def test_language_model_over_many_blocks(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = ngram_lm.score(docs, block_chars=30_000).collect()
    check_scores(found, [(r.doc_id, r.text) for r in docs.collect()])
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_only_held_out_rows(spark):
    ids = [k for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0][:3]
    docs = spark.createDataFrame([(i, "never seen") for i in ids], "doc_id long, text string")
    for r in ngram_lm.score(docs).collect():
        assert r.held_out and r.train_tokens == 0 and r.n_known == 0 and r.score == pytest.approx(r.base_score, abs=1e-3)


# ---- quality --------------------------------------------------------------


def test_gradients():
    random = np.random.default_rng(1)
    x, sizes = random.standard_normal((9, 4)), np.array([2, 4, 3])
    y = np.array([1.0, 0.0, 1.0])
    model = quality.fit(x, sizes, y, hidden=3, rounds=1)
    loss = lambda: -np.sum(y * np.log(p := model.forward(x, sizes)["p"]) + (1 - y) * np.log(1 - p))
    state = model.forward(x, sizes)
    for name, found in model.gradients(state, state["p"] - y).items():
        w = model.weights[name]
        at = tuple(0 for _ in w.shape)
        w[at] += 1e-6
        high = loss()
        w[at] -= 2e-6
        low = loss()
        w[at] += 1e-6
        assert found[at] == pytest.approx((high - low) / 2e-6, abs=1e-5), name


def slow_score(model, text):
    """The score of a text by plain loops."""
    words = text.split()
    encoded, attention = [], []
    w = {k: v.tolist() for k, v in model.weights.items()}
    for at in range(0, max(1, len(words)), quality.WORDS):
        some = words[at : at + quality.WORDS]
        raw, n = " ".join(some).encode(), max(1, len(some))
        x = [0.0] * quality.FEATURES
        for b in raw:
            x[quality._KIND[b]] += 1 / len(raw)
        for a, b in zip(raw, raw[1:]):
            x[quality.KINDS + ((a | 32) * 31 + (b | 32)) % quality.PAIRS] += 1 / len(raw)
        x = [math.sqrt(v) for v in x[: -quality.FIGURES]]
        x += [min(3.0, len(raw) / n / 10), sum(a == b for a, b in zip(some, some[1:])) / n, len(set(some)) / n]
        x += [sum(s.isupper() for s in some) / n, len(some) / quality.WORDS]
        x = [max(-5.0, min(5.0, (v - m) / s)) for v, m, s in zip(x, model.mean.tolist(), model.spread.tolist())]
        h = [math.tanh(sum(v * row[j] for v, row in zip(x, w["encode"])) + w["shift"][j]) for j in range(len(w["shift"]))]
        inner = {k: [sum(v * row[j] for v, row in zip(h, w[k])) for j in range(len(w["weigh"]))] for k in ("what", "gate")}
        gated = [math.tanh(a) / (1 + math.exp(-b)) for a, b in zip(inner["what"], inner["gate"])]
        encoded.append(h)
        attention.append(math.exp(sum(a * b for a, b in zip(gated, w["weigh"]))))
    z = [sum(a * h[j] for a, h in zip(attention, encoded)) / sum(attention) for j in range(len(w["out"]))]
    return 1 / (1 + math.exp(-sum(a * b for a, b in zip(z, w["out"])) - w["bias"][0]))


def test_scores_are_those_of_plain_loops(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(-k, t) for k, (_, t) in enumerate(ODD, 1)], "doc_id long, text string")
    docs = docs.select("doc_id", "text").union(odd)
    x, sizes, marks = quality.training_bags(quality.common.texts(docs, "doc_id", "text"), labels, quality.SAMPLE)
    model = quality.fit(x, sizes, marks.astype(float))
    found = quality.score(docs, labels).join(docs, "doc_id").collect()
    assert len(found) == docs.count()
    for r in found:
        assert r.score == pytest.approx(slow_score(model, r.text or ""), abs=1e-6)


def test_the_sample_has_one_text_of_an_id_and_passes_over_what_is_too_long(spark):
    ids = [k for k in range(60) if zlib.crc32(str(k).encode()) % 5 != 0][:6]
    text = lambda i, n: " ".join(f"w{i}x{j}" for j in range(quality.WORDS * n))
    rows = [(i, text(i, 3)) for i in ids] + [(ids[0], text("other", 2)), (ids[0], text("another", 4))]
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, quality int")
    bags = []
    for order in (rows, rows[::-1]):
        table = spark.createDataFrame(order, "doc_id long, text string").repartition(4)
        bags.append(quality.training_bags(table, labels, 2000))
    assert (bags[0][0] == bags[1][0]).all() and bags[0][1].tolist() == bags[1][1].tolist()
    for long in ids:  # wherever it stands in the order
        table = spark.createDataFrame([(i, text(i, 9 if i == long else 2)) for i in ids], "doc_id long, text string")
        assert quality.training_bags(table, labels, 2000, 8)[1].tolist() == [2] * 5


def test_a_text_scores_the_same_in_any_batch(spark, small):
    texts = [t or "" for _, t in ODD] + ["a b", "", "zq", "Q", "one two"]
    alone = np.vstack([quality.passages([t])[0] for t in texts])
    x, sizes = quality.passages(texts)
    assert (x == alone).all()
    backwards = np.split(quality.passages(texts[::-1])[0], np.cumsum(sizes[::-1])[:-1])
    assert (np.vstack(backwards[::-1]) == alone).all()
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    scores = quality.scorer(quality.common.texts(docs, "doc_id", "text"), labels)
    one = np.concatenate([scores([t]) for t in texts])
    assert scores(texts) == pytest.approx(one, abs=1e-9)
    assert scores(texts[::-1])[::-1] == pytest.approx(one, abs=1e-9)


def test_sampled_documents_are_whole(spark):
    ids = [k for k in range(60) if zlib.crc32(str(k).encode()) % 5 != 0][:12]
    docs = [(i, " ".join(f"w{i}x{j}" for j in range(quality.WORDS * 400))) for i in ids]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, quality int")
    x, sizes, marks = quality.training_bags(table, labels, 2000)
    assert sizes.tolist() == [400] * 12 and marks.tolist() == [k % 2 for k in range(12)]
    want = quality.passages([t for _, t in docs])[0].astype(np.float32)
    assert (x == want).all()
    for bound, n in ((1200, 3), (1199, 2), (1, 1)):  # fewer documents, each of them whole, and one at least
        x, sizes, marks = quality.training_bags(table, labels, 2000, bound)
        assert sizes.tolist() == [400] * 2 * n and marks.sum() == n and len(x) == 800 * n


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.score(docs, labels).join(labels, "doc_id").where("held_out")
    right, n = found.agg(F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert right / n >= 0.95
    assert found.where("quality = 1 AND predicted = 0").count() == 0


def test_other_columns_are_no_input(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.col("text"), "score": F.lit(0.0)})
    a = {r.doc_id: r.score for r in quality.score(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality.score(other, labels).collect()}
    assert a == pytest.approx(b, abs=1e-9)


def test_odd_rows_and_labels(spark, odd, none):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (5, 0, 0), (7, None, 0), (None, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for marks in (labels, labels.limit(0), labels.where("quality = 1")):
        found = quality.score(odd, marks).collect()
        assert len(found) == len(ODD)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    assert quality.score(none, labels).count() == 0
    kept = quality.keep_good(odd, labels.limit(0))
    assert kept.columns == odd.columns and kept.count() == len(ODD)
