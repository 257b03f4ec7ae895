"""The registered queries of this package, with their production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    ann,
    bpe,
    chat,
    fingerprints,
    jaccard,
    line_dedup,
    ngram_lm,
    packing,
    periodic_runs,
    quality,
    token_counts,
    topk,
)

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op2_transducer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE))


def op3_jaccard_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(_table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # Conversation -1 stands for control strings inside texts.
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return chat.digests(chat.format_chats(rows.unionByName(extra)))


def op5_term_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(_table(spark, sf_dir, "documents"))


def op7_one_bit_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op10_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


def op11_improbable_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.fingerprints(_table(spark, sf_dir, "documents"))
    digest = F.sha2("edited", 256).alias("edited_sha256")
    return found.select("doc_id", "n_chars", digest, "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op12_diagonal_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.repeat_some(_table(spark, sf_dir, "documents"))
    found = periodic_runs.periodic_runs(docs)
    # Runs come by start and period: of equal exponents the first stays.
    top = F.reduce("runs", F.get("runs", F.lit(0)), lambda best, r: F.when(r.length * best.period > best.length * r.period, r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    runs = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("top.length * 1000 DIV top.period").alias("exponent_milli"),
        F.sha2(runs, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_asof_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE)
    return alignment.align(_table(spark, sf_dir, "documents"), *paths)


QUERIES = {
    f.__name__: f
    for f in (
        op1_curve_packing,
        op2_transducer_counts,
        op3_jaccard_classes,
        op4_chat_format,
        op5_term_top_k,
        op6_elias_fano_lm,
        op7_one_bit_ann,
        op8_attention_quality,
        op9_segment_tree_bpe,
        op10_line_runs,
        op11_improbable_features,
        op12_diagonal_runs,
        op13_asof_alignment,
    )
}

ORACLE = {
    "op4_chat_format": """
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), ordered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
                -- a backslash goes behind the first character of each mark of the template
                regexp_replace(regexp_replace(text, '<(\\\\*\\|(turn|says)\\|>)', '<\\\\\\1', 'g'),
                    '<(\\\\*/s>)', '<\\\\\\1', 'g') AS safe
            FROM rows
        ), moved AS (
            SELECT *, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY n) AS before FROM ordered
        ), judged AS (
            SELECT *, (before, role) IN (('', 'system'), ('', 'user'), ('system', 'user'),
                ('user', 'assistant'), ('assistant', 'user')) AS ok FROM moved
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
            sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
            sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY n)) AS loss_sha256,
            sum(length('<|turn|>') + length(role) + length('<|says|>') + length(safe) + length('</s>'))::BIGINT
                AS formatted_chars,
            bool_and(ok) AND arg_max(role, n) = 'assistant' AS accepted,
            arg_min(turn, n) FILTER (NOT ok) AS first_bad_turn
        FROM judged GROUP BY conv_id
    """,
    "op5_term_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op12_diagonal_runs": r"""
        WITH checked AS (
            -- crc32 of the decimal id, bit by bit
            SELECT doc_id, coalesce(text, '') AS text, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
                flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c:
                    list_transform(range(8), lambda k: (ascii(c)::BIGINT >> k::BIGINT) & 1)))),
                lambda crc, bit: xor(crc >> 1, 3988292384 * (xor(crc, bit) & 1)))) AS h
            FROM documents
        ), split AS (
            SELECT doc_id, h, list_filter(regexp_split_to_array(text, '[ \t-\r]+'), lambda w: w <> '') AS words FROM checked
        ), placed AS (
            SELECT *, len(words) AS n, (h // 10) % greatest(len(words), 1) AS a FROM split
        ), planted AS (
            SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM placed
        ), texts AS (
            SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
                THEN list_transform(range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END])
                ELSE words END AS words
            FROM planted
        ), grams AS (
            -- every run repeats 16 words: the 16 words up to place i
            SELECT doc_id, n, unnest(range(15, n)) AS i, unnest(list_transform(range(15, n), lambda i: hash(words[i - 14 : i + 1]))) AS gram
            FROM texts WHERE n >= 24
        ), pairs AS (
            SELECT a.doc_id, a.i, a.i - b.i AS lag FROM grams a JOIN grams b USING (doc_id, gram)
            WHERE b.i < a.i AND 3 * (a.i - b.i) <= a.n
        ), stretches AS (
            SELECT doc_id, lag, min(i) - 15 - lag AS start, max(i) - min(i) + 16 + lag AS length
            FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM pairs)
            GROUP BY doc_id, lag, island
        ), runs AS (
            SELECT doc_id, start, length, min(lag) AS period FROM stretches WHERE length >= greatest(24, 3 * lag)
            GROUP BY doc_id, start, length
        ), ranked AS (
            SELECT *, (length * 1000) // period AS milli FROM runs
        ), best AS (
            SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
            FROM runs GROUP BY doc_id
        ), top AS (
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id
                ORDER BY length::DECIMAL(38, 18) / period DESC, start, period) AS k FROM ranked) WHERE k = 1
        ), dropped AS (
            SELECT doc_id, list_distinct(flatten(list(range(start + period, start + length)))) AS gone FROM runs GROUP BY doc_id
        )
        SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, milli AS exponent_milli,
            sha256(coalesce(lines, '')) AS runs_sha256,
            sha256(coalesce(list_aggregate(CASE WHEN gone IS NULL THEN words
                ELSE list_transform(list_sort(list_filter(range(n), lambda i: NOT list_contains(gone, i))), lambda i: words[i + 1]) END,
                'string_agg', ' '), '')) AS collapsed_sha256
        FROM texts t LEFT JOIN best USING (doc_id) LEFT JOIN top USING (doc_id) LEFT JOIN dropped USING (doc_id)
    """,
    "op10_line_runs": r"""
        WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        every AS (
            SELECT doc_id, unnest(range(len(lines))) AS pos, unnest(lines) AS raw,
                trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line FROM docs
        ), numbered AS (
            -- nr: number of the line, or of the line before a blank one, among those that are not blank
            SELECT *, sum((line <> '')::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS nr FROM every
        ), summed AS (
            SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY nr) AS upto FROM (
                SELECT *, len(regexp_extract_all(line, '[^ \t\r\x0B\f]+')) AS words FROM numbered WHERE line <> '')
        ), runs AS (
            -- the shortest run of 50 words from, and up to, each line: its lines and its place
            SELECT doc_id, list(line) OVER f AS run, nr AS first_nr, last(nr) OVER f AS last_nr, sum(words) OVER f AS n
            FROM summed WINDOW f AS (PARTITION BY doc_id ORDER BY upto - words RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
            UNION ALL
            SELECT doc_id, list(line) OVER f, first(nr) OVER f, nr, sum(words) OVER f
            FROM summed WINDOW f AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)
        ), ranked AS (
            SELECT *, dense_rank() OVER (PARTITION BY run ORDER BY doc_id, first_nr) AS k FROM runs WHERE n >= 50
        ), spots AS (
            SELECT DISTINCT doc_id, unnest(range(first_nr::BIGINT, last_nr::BIGINT + 1)) AS nr FROM ranked WHERE k > 1
        ), marked AS (
            -- a blank line goes if the lines round it do
            SELECT e.*, a.nr IS NOT NULL AND (line <> '' OR b.nr IS NOT NULL) AS gone
            FROM numbered e LEFT JOIN spots a ON a.doc_id = e.doc_id AND a.nr = e.nr
                LEFT JOIN spots b ON b.doc_id = e.doc_id AND b.nr = e.nr + 1
        )
        SELECT doc_id, count(*) AS n_lines, sum(gone::INT)::BIGINT AS n_removed,
            coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
        FROM marked GROUP BY doc_id
    """,
}
