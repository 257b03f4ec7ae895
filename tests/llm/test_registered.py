"""Registered queries, the pipeline, and an installation without this package."""

import re
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from compare import connect, difference
from conftest import PASSAGE, rows
from headway.llm import jaccard, line_dedup, quality, queries
from test_tokens import check_packing

REPO = Path(entry.__file__).resolve().parent


@pytest.mark.parametrize("name", queries.ORACLE)
def test_query_with_sql(spark, small, name):
    table = queries.QUERIES[name](spark, small).toArrow()
    assert difference(table, connect(small).sql(queries.ORACLE[name]).to_arrow_table()) is None


def test_each_operator_is_registered_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", ["op4_chat_format", "op10_line_runs"])
def test_native_queries_have_no_python(spark, small, name):
    plan = queries.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_one_stage_after_the_other(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, small)
    assert good.schema == docs.schema
    scores = quality.score(docs, labels).where("predicted = 1")
    assert rows(good, "doc_id") == rows(scores, "doc_id")
    lines = stages["line_dedup"](spark, good, small)
    assert lines.columns == docs.columns
    full = line_dedup.dedup_lines(good).where("n_removed = 0 OR trim(text) <> ''")
    assert rows(lines, "doc_id", "text") == rows(full, "doc_id", "text")
    assert lines.where(F.col("n_chars") != F.char_length("text")).count() == docs.where(F.col("n_chars") != F.char_length("text")).count()
    kept = stages["near_dup"](spark, lines, small)
    assert rows(kept, "doc_id") == rows(jaccard.classes(lines).where("n_links = 0 OR doc_id = class_id"), "doc_id")
    packed = stages["pack"](spark, kept, small)
    check_packing(packed.collect(), [tuple(r) for r in kept.select("doc_id", "text").collect()])
    whole = corpus_pipeline.run(spark, small)
    assert rows(whole.groupBy("doc_id").agg(F.sum("length"))) == rows(packed.groupBy("doc_id").agg(F.sum("length")))


def test_copies_with_blank_edges_leave_nothing(spark, small):
    assert not any(re.search(corpus_pipeline.SOLID, chr(k)) for k in range(0x110000) if chr(k).isspace())
    assert all(re.search(corpus_pipeline.SOLID, chr(k)) for k in range(0x110000) if not chr(k).isspace())
    edges = [("", ""), ("", "\n\n"), ("\n", "\n"), ("\t\n", "\r\n \n"), ("\r\n\x0b\n", "\n\f"), ("", "\n\xa0"), ("\u3000\n", "")]
    docs = [(k, a + PASSAGE + b, 0) for k, (a, b) in enumerate(edges)]
    docs += [(20, PASSAGE + "\n\nown words", 0), (21, "\n\n", 2), (22, None, 0)]
    table = spark.createDataFrame(docs, "doc_id long, text string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    lines = stages["line_dedup"](spark, table, small)
    assert rows(lines, "doc_id", "text") == sorted([(0, PASSAGE), (20, "\nown words"), (21, "\n\n"), (22, None)], key=str)
    assert len(rows(stages["near_dup"](spark, lines, small))) == 4


def test_stages_take_odd_rows(spark, odd, small):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, small)
        assert out.count() > 0
        if name != "pack":
            assert out.columns == odd.columns
        assert stage(spark, odd.limit(0), small).count() == 0


def test_the_rest_stands_without_this_package(tmp_path):
    for part in ("__spark_entry__.py", "headway"):
        source = REPO / part
        files = [source] if source.is_file() else [f for f in source.rglob("*.py") if "llm" not in f.parts]
        for file in files:
            target = tmp_path / file.relative_to(REPO)
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_bytes(file.read_bytes())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'top_delays' in q and not any(n.startswith('op') for n in q); assert e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_nothing_else_imports_this_package():
    for file in (REPO / "headway").rglob("*.py"):
        if "llm" not in file.parts:
            assert "llm" not in file.read_text()
