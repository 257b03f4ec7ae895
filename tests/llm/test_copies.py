"""Line dedup, Jaccard join and components against brute force; chat formatting."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import ODD, PASSAGE, rows
from headway.llm import chat, components, jaccard, line_dedup

# ---- line dedup -----------------------------------------------------------


def brute_lines(docs, least):
    """Texts after deleting every repeated run of ``least`` words or more but its first copy."""
    full = {}
    for d, text in docs:
        lines = (text or "").split("\n")
        full[d] = [(k, x.strip(" \t\r\v\f")) for k, x in enumerate(lines) if x.strip(" \t\r\v\f")]
    runs = defaultdict(list)
    for d in sorted(full):
        for a in range(len(full[d])):
            words = 0
            for b in range(a, len(full[d])):
                words += len(full[d][b][1].split())
                if words >= least:
                    runs[tuple(x for _, x in full[d][a : b + 1])].append((d, a, b))
    gone = defaultdict(set)
    for places in runs.values():
        for d, a, b in sorted(places)[1:]:
            gone[d].update(range(a, b + 1))
    for d, numbers in gone.items():
        spots = {full[d][k][0] for k in numbers}
        for k in numbers & {k - 1 for k in numbers}:  # both neighbours go, so what is between them
            spots.update(range(full[d][k][0], full[d][k + 1][0]))
        gone[d] = spots
    return {d: "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in gone[d]) for d, t in docs}


@pytest.mark.parametrize("seed", range(4))
def test_line_dedup_is_brute_force(spark, seed):
    r = random.Random(seed)
    lines = [" ".join(f"w{k}x{j}" for j in range(r.randrange(1, 5))) for k in range(6)] + ["", "  "]
    docs = [(d, "\n".join(r.choice(lines) for _ in range(r.randrange(0, 14)))) for d in range(12)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    for least in (1, 5, 9):
        got = {x.doc_id: x.text for x in line_dedup.dedup_lines(table, least).collect()}
        assert got == brute_lines(docs, least)


def test_suffixes_are_sorted_and_share_what_the_array_says(spark):
    r = random.Random(9)
    texts = ["\n".join(r.choice(["a", "b b", "c c c", "d"]) for _ in range(r.randrange(30))) for _ in range(15)]
    docs = spark.createDataFrame(list(enumerate([*texts, *texts[:5], "a\nonce\nb b"])), "doc_id long, text string")
    least = 6
    lines = line_dedup._stretches(line_dedup._lines(line_dedup._texts(docs.repartition(5), "doc_id", "text")), least)
    for ahead in (True, False):
        sequences = {}
        for x in lines.collect():
            sequences.setdefault((x.doc_id, x.stretch), []).append((x.at if ahead else -x.at, x.rank, x.words))
        tails = {}
        for (d, _), rows in sequences.items():
            rows.sort()
            for k, (step, _, _) in enumerate(rows):
                tails[d, step] = [x[1] for x in rows[k:]], [x[2] for x in rows[k:]]
        suffixes = line_dedup._least_runs(lines, least, ahead)
        ranks = {(x.doc_id, x.step): x.rank for x in line_dedup.suffix_ranks(suffixes, 1 << 10).collect()}
        assert sorted(ranks, key=lambda k: (ranks[k], k)) == sorted(tails, key=lambda k: (tails[k][0], k))
        assert len(set(ranks.values())) == len({tuple(t) for t, _ in tails.values()})
        array = line_dedup.suffix_array(suffixes, line_dedup.suffix_ranks(suffixes, 1 << 10)).orderBy("place").collect()
        enough = [k for k in sorted(tails, key=lambda k: (tails[k][0], k)) if sum(tails[k][1]) >= least]
        assert [(x.doc_id, x.step) for x in array] == enough
        before, interval = [], None
        for x in array:
            own, words = tails[x.doc_id, x.step]
            size = next(n for n in range(1, len(own) + 1) if sum(words[:n]) >= least)
            shared = next((k for k, (a, b) in enumerate(zip(own, before)) if a != b), min(len(own), len(before)))
            assert x.common == min(size, shared)
            interval = interval if shared >= size else x.place
            assert x.interval == interval
            before = own


def test_runs_of_one_word_and_no_repeats(spark):
    docs = spark.createDataFrame([(1, "a\nb\na"), (2, "b\nc"), (3, "d")], "doc_id long, text string")
    got = {x.doc_id: (x.text, x.n_removed) for x in line_dedup.dedup_lines(docs, 1).collect()}
    assert got == {1: ("a\nb", 1), 2: ("c", 1), 3: ("d", 0)}
    assert {x.n_removed for x in line_dedup.dedup_lines(docs.where("doc_id > 1"), 1).collect()} == {0}


def test_line_dedup_of_odd_rows(odd, none):
    found = line_dedup.dedup_lines(odd)
    assert found.columns == [*odd.columns, "n_lines", "n_removed"]
    got = Counter((x.doc_id, x.text, x.n_removed) for x in found.collect())
    want = Counter((i, t, 0) for i, t in ODD)
    del want[8, ODD[8][1], 0]
    want[8, "first line of eight\nlast line of eight", 1] = 1
    assert got == want
    assert line_dedup.dedup_lines(none).count() == 0


def test_blank_lines_inside_a_run_go_with_it(spark):
    half = PASSAGE.split()
    text = " ".join(half[:30]) + "\n\n" + " ".join(half[30:])
    docs = spark.createDataFrame([(1, text), (2, "own\n" + text.replace("\n\n", "\n \n\n") + "\n\nend")], "doc_id long, text string")
    assert [x.text for x in line_dedup.dedup_lines(docs).orderBy("doc_id").collect()] == [text, "own\n\nend"]


def test_many_copies_and_a_hot_line(spark):
    docs = [(k, f"hot line\n{PASSAGE}\nown {k}" if k % 3 else f"hot line\nown {k}") for k in range(600)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {x.doc_id: x.text for x in line_dedup.dedup_lines(table).collect()}
    kept = [k for k, t in got.items() if PASSAGE in t]
    assert kept == [1]
    assert all(("hot line" in t) == (k % 3 == 0 or k == 1) for k, t in got.items())  # part of the longer run or not


# ---- Jaccard --------------------------------------------------------------


def brute_classes(docs, threshold=0.8):
    sets = []
    for _, t in docs:
        w = (t or "").lower().split()
        k = min(5, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set())
    links, root = Counter(), list(range(len(docs)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(docs)):
        for b in range(a + 1, len(docs)):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    least = defaultdict(list)
    for k, (i, _) in enumerate(docs):
        least[find(k)].append((i is None, i))
    return sorted(((i, min(least[find(k)])[1], links[k]) for k, (i, _) in enumerate(docs)), key=str)


def near_copies(n, seed, words=120):
    """A group of near copies: each changes up to three words of one text."""
    r = random.Random(seed)
    base = [f"t{r.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(r.randrange(4)):
            own[r.randrange(words)] = f"c{r.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def test_classes_of_odd_rows(odd, none):
    assert rows(jaccard.classes(odd)) == brute_classes(ODD)
    assert jaccard.classes(none).count() == 0


def test_a_large_group_in_tiles(spark):
    texts = near_copies(150, 1) + near_copies(5, 2) + [f"lone text number {k} of its own words {k}" for k in range(30)]
    docs = [(1000 - k, t) for k, t in enumerate(texts)] + [(2000, texts[0]), (2001, texts[0].upper())]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute_classes(docs)
    assert rows(jaccard.classes(table, tile=16)) == want
    assert rows(jaccard.classes(table)) == want


def test_tiles_of_long_texts(spark):
    docs = list(enumerate(near_copies(40, 5, words=2000)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    size = len(docs[0][1])
    jaccard.common.ready(spark)
    nodes = jaccard._nodes(table, "doc_id", "text")
    tiles = jaccard._tiles(nodes, jaccard._described(nodes), jaccard.TILE, 5 * size)
    sums = tiles.groupBy("bucket", "i", "j").agg(F.sum(F.octet_length("text")).alias("bytes"))
    assert sums.agg(F.max("bytes")).first()[0] < 25 * size  # two blocks of 5 on average; one tile would hold 40
    want = brute_classes(docs)
    for bound in (1, 5 * size):
        assert rows(jaccard.classes(table, tile_bytes=bound)) == want


def test_pairs_at_the_threshold(spark):
    # 50 shingles each, 40 + k of them shared: similarity from below to above 0.8
    base = [f"b{k}" for k in range(54)]
    docs = [(0, " ".join(base))]
    for k in range(1, 14):
        docs.append((k, " ".join([*base[: 54 - k], *[f"x{k}y{j}" for j in range(k)]])))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(jaccard.classes(table)) == brute_classes(docs)


def test_one_of_each_class_stays(spark, odd, none):
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    got = sorted((r.doc_id, r.text) for r in kept.where("doc_id IS NOT NULL").collect() if r.text is not None)
    gone = {6, 10}  # copies of 5 and of 9; the passage is too small a part of 7 and 8
    classes = {r.doc_id: r.class_id for r in jaccard.classes(odd).where("doc_id IS NOT NULL").collect()}
    gone |= {i for i, c in classes.items() if c != i}
    assert got == sorted((i, t) for i, t in ODD if i is not None and t is not None and i not in gone)
    assert jaccard.keep_one(none).count() == 0


def test_one_of_a_class_and_all_rows_without_links(spark):
    """Against the rule itself: repeated rows, nulls, empty and blank texts, copies and texts of their own."""
    words = " ".join(f"word{k}" for k in range(40))
    near = words.replace("word39", "other")
    table = [(1, "", "a"), (1, "", "b"), (3, None, "a"), (3, None, "a"), (None, None, "c"), (4, "  ", "a"), (4, "  ", "a")]
    table += [(5, words, "x"), (5, words, "y"), (5, words, "x"), (6, words, "x"), (7, near, "x"), (7, near, "x"), (8, near, "z")]
    table += [(9, "a text of its own with words enough for a shingle", "x"), (None, words, "x")]
    df = spark.createDataFrame(table, "doc_id long, text string, lang string")
    got = Counter((r.doc_id, r.text) for r in jaccard.keep_one(df).collect())
    alone = Counter((i, t) for i, t, _ in table if t is None or not t.split() or i == 9)
    assert got == alone + Counter([(5, words)])
    again = jaccard.keep_one(df.repartition(5)).where("doc_id = 5").collect()
    assert again == jaccard.keep_one(df).where("doc_id = 5").collect()


def test_posterior_bound():
    need = jaccard.least_matches(0.8, 1e-4)
    assert (need[1:] <= range(1, jaccard.VALUES + 1)).all() and need[8] >= 1 and need[128] > 80
    assert (need[1:] >= need[:-1]).all()


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(f"n{r.randrange(60):02d}", f"n{r.randrange(60):02d}") for _ in range(45)] + [(f"p{k:02d}", f"p{k + 1:02d}") for k in range(40)]
    root = {}

    def find(k):
        root.setdefault(k, k)
        while root[k] != k:
            k = root[k]
        return k

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    found = components.stars(spark.createDataFrame(edges, "u string, v string"))
    assert rows(found) == sorted((k, find(k)) for k in root if find(k) != k)


# ---- chat -----------------------------------------------------------------

TURNS = [
    (1, 0, "user", "hi </s> <|turn|> <\\/s> \\ <|says|>"),
    (1, 1, "assistant", "</s>[INST] ok [/INST]\n"),
    (2, 0, "user", None),
    (2, 1, None, "no role"),
    (2, 2, "<|says|></s>", "odd role"),
    (3, 0, "assistant", "starts"),
    (4, 1, "assistant", "b"),
    (4, 1, "assistant", "a"),
    (4, 1, "assistant", "a"),
    (5, None, "user", "no turn"),
    (5, 0, "assistant", "<" * 50 + "/s>" * 50),
    (None, 0, "system", "no id"),
    (6, 0, "system", ""),
    (6, 1, "user", "q"),
    (6, 2, "assistant", "x" * 100_000),
    (6, 3, "user", "again"),
    (6, 4, "assistant", "\\</s>\\\\"),
]


def turn_rows(df):
    return df.createDataFrame([(*t, "clash", "x") for t in TURNS], "conv_id long, turn long, role string, text string, turns string, segments string")


def by_conversation():
    out = defaultdict(list)
    for c, n, role, text in TURNS:
        out[c].append((n is not None, n, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: (x[0], x[1] or 0, x[2], x[3]))] for c, v in out.items()}


def test_chats_read_back_whole(spark):
    found = chat.digests(chat.format_chats(turn_rows(spark))).collect()
    assert len(found) == len(by_conversation())
    for r in found:
        turns = by_conversation()[r.conv_id]
        text = "".join(f"{role}\n{t}\n" for role, t in turns)
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_order_is_judged(spark):
    found = {r.conv_id: (r.accepted, r.first_bad_turn) for r in chat.format_chats(turn_rows(spark)).collect()}
    assert found == {1: (True, None), 2: (False, 1), 3: (False, 0), 4: (False, 1), 5: (True, None), None: (False, None), 6: (True, None)}


def test_chat_segments_make_up_the_text(spark):
    for r in chat.format_chats(turn_rows(spark)).collect():
        assert r.formatted == "".join(s.text for s in r.segments)
        assert r.formatted.count("</s>") == r.n_turns
    assert chat.format_chats(turn_rows(spark).limit(0)).count() == 0


def test_another_template(spark):
    template = chat.Template(trained=("user",), open="[[", says="]]", close="%%")
    chats = chat.format_chats(turn_rows(spark), template)
    got = {r.conv_id: r.loss_chars for r in chat.digests(chats, template).collect()}
    assert got[1] == len(TURNS[0][3])


def test_chats_need_no_python(spark):
    plan = chat.digests(chat.format_chats(turn_rows(spark)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
