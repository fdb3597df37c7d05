"""Registered queries of the text operators, over whole tables, and their SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow.llm.chat import format_chats
from segflow.llm.containment import contaminated
from segflow.llm.exact_dedup import exact_groups
from segflow.llm.near_duplicates import near_classes
from segflow.llm.rank_bpe import encode_and_decode
from segflow.llm.repeats import remove_repeats
from segflow.llm.sharding import shuffled_shards
from segflow.llm.simhash import simhash_classes
from segflow.llm.site_style_tree import main_text
from segflow.llm.tables import table
from segflow.llm.token_alignment import align_tokens
from segflow.llm.token_files import read_tokens, write_tokens
from segflow.llm.toxicity import fit_toxicity, score_toxicity
from segflow.llm.vector_codes import vector_codes
from segflow.scratch import new_scratch_dir

SHARDS = 24
#: Tokenizer files; they must lie at this place on every executor.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents")).drop("print")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(table(spark, sf_dir, "documents"), WORD_BPE).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = format_chats(table(spark, sf_dir, "conversations"))
    return rows.withColumn("inserted", F.array_join("inserted", ","))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffled_shards(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_scratch_dir(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), BYTE_BPE, out)
    return read_tokens(spark, out).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = fit_toxicity(documents, table(spark, sf_dir, "labels"))
    return score_toxicity(documents, model)


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE, public_tokenizers.PATTERN)


QUERIES = {
    "op11_simhash": op11_simhash,
    "op12_vector_codes": op12_vector_codes,
    "op13_token_alignment": op13_token_alignment,
    "op10_repeats": op10_repeats,
    "op5_chat": op5_chat,
    "op6_main_text": op6_main_text,
    "op8_token_files": op8_token_files,
    "op1_jaccard_join": op1_jaccard_join,
    "op9_toxicity": op9_toxicity,
    "op2_bpe": op2_bpe,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_decontamination": op4_decontamination,
    "op7_sharding": op7_sharding,
}

ORACLES = {
    "op3_exact_dedup": """
        WITH texts AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS whole FROM documents
        )
        SELECT doc_id,
            min(doc_id) OVER (PARTITION BY whole) AS keep_id,
            count(*) OVER (PARTITION BY whole) AS group_size,
            row_number() OVER (PARTITION BY whole ORDER BY doc_id NULLS LAST) = 1 AS kept,
            sha256(whole) AS text_sha256
        FROM texts
    """,
    "op4_decontamination": """
        WITH spaced AS (
            SELECT doc_id, NULL AS item_id, trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS t
            FROM documents
            UNION ALL
            SELECT NULL, item_id, trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g'))
            FROM benchmark
        ), worded AS (
            SELECT doc_id, item_id, string_split(t, ' ') AS w FROM spaced WHERE t <> ''
        ), shingled AS (
            SELECT DISTINCT doc_id, item_id, unnest(
                list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))
            ) AS shingle
            FROM worded
        ), items AS (
            SELECT item_id, shingle, count(*) OVER (PARTITION BY item_id) AS n FROM shingled WHERE item_id IS NOT NULL
        )
        SELECT d.doc_id, i.item_id, count(*)::INT AS n_shared, count(*) / any_value(i.n) AS containment
        FROM shingled d JOIN items i ON d.shingle = i.shingle
        WHERE d.doc_id IS NOT NULL
        GROUP BY d.doc_id, i.item_id
        HAVING count(*) / any_value(i.n) >= 0.8
    """,
    "op1_jaccard_join": """
        WITH RECURSIVE spaced AS (
            SELECT doc_id, trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS t FROM documents
        ), worded AS (
            SELECT doc_id, string_split(t, ' ') AS w FROM spaced WHERE t <> ''
        ), shingled AS (
            SELECT DISTINCT doc_id, unnest(
                list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))
            ) AS shingle
            FROM worded
        ), sized AS (
            SELECT doc_id, shingle, count(*) OVER (PARTITION BY doc_id) AS n FROM shingled
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM sized a JOIN sized b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id
            HAVING count(*) >= 0.8 * (any_value(a.n) + any_value(b.n) - count(*)) - 1e-9
        ), reached(a, b) AS (
            SELECT a, b FROM links
            UNION
            SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
        ), classes AS (
            SELECT a, min(b) AS least FROM reached GROUP BY a
        ), counts AS (
            SELECT a, count(*) AS n FROM links GROUP BY a
        )
        SELECT d.doc_id, least(d.doc_id, coalesce(c.least, d.doc_id)) AS class_id, coalesce(n.n, 0) AS n_links
        FROM documents d LEFT JOIN classes c ON c.a = d.doc_id LEFT JOIN counts n ON n.a = d.doc_id
    """,
}
