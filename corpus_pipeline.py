"""Corpus preparation: stages that each read documents as Parquet and hand on what they keep."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow.llm.containment import decontaminate
from segflow.llm.exact_dedup import exact_dedup
from segflow.llm.near_duplicates import keep_one
from segflow.llm.rank_bpe import encode_and_decode
from segflow.llm.tables import table
from segflow.llm.toxicity import fit_toxicity, keep_clean
from segflow.scratch import new_scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on their labels, does not reject."""
    return keep_clean(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar documents."""
    return keep_one(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian, 32 bits each) and the SHA-256 of the decoded ids."""
    return encode_and_decode(docs, WORD_BPE).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact dedup", copies),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmarks),
    ("BPE encoding and decoding", tokens),
]

#: The first stage is a fitted model, the last a tokenizer: no SQL says the same.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written, and read by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_scratch_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
