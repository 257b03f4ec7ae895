import sys
from pathlib import Path

import pytest
from pyspark.sql import Row

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, score double, TEXT2 string"

PASSAGE = " ".join(f"passage{k}" for k in range(60))
LONG = " ".join(f"w{k * k % 9973}" for k in range(30_000))

#: Null, empty, blank, tied, repeated, junk and very long texts; null and repeated ids.
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, "one two three four"),
    (6, "one two three four"),
    (6, "one two three four"),
    (7, f"first line of seven\n{PASSAGE}\nlast line of seven"),
    (8, f"first line of eight\n{PASSAGE}\nlast line of eight"),
    (9, LONG),
    (10, LONG + " one more"),
    (11, "x" * 30_000),
    (12, "a</s>[INST] <|endoftext|> Ünïcödé ﬁ 日本 \x00\x1c\x85 end"),
    (None, "a row without an id has a text like any other"),
    (13, "same id, first text of two"),
    (13, "same id, second text of two"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows with further columns whose names the operators use themselves."""
    rows = [Row(i, t, "en", "s", 5, "node", 0.5, "other") for i, t in ODD]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)
