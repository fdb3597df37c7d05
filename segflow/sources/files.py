"""Landed files as rows: one file, one row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow.functions.ids import file_source_id

# What the two file formats yield for a file.
TEXT_SCHEMA = "value STRING"
BINARY_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"

# A backlog is taken in batches of this many files, so that the listing, the plan
# and the work lost with a failed batch stay bounded.
FILES_PER_BATCH = 100_000

# Spark would skip a file a week older than the newest one seen. A file that lands
# late, with the time it was made, has to be read too.
NO_AGE_LIMIT = "36500d"


def _with_source_id(files: DataFrame, id_column: str) -> DataFrame:
    return files.select(
        file_source_id(F.col("_metadata")).alias(id_column),
        F.col("_metadata").alias("file_metadata"),
        F.current_timestamp().alias("ingest_time"),
        "*",
    )


def _reader(spark: SparkSession, streaming: bool, options: dict):
    options = {"recursiveFileLookup": True, **options}
    if not streaming:
        return spark.read.options(**options)
    return spark.readStream.options(
        **{"maxFilesPerTrigger": FILES_PER_BATCH, "maxFileAge": NO_AGE_LIMIT, **options}
    )


def text_files(
    spark: SparkSession, path: str, *, streaming: bool = True, id_column: str = "transaction_file_source_id", **options
) -> DataFrame:
    """Whole text of every file under ``path``, at any depth, in ``value``.

    As a stream each file is read once; ``maxFilesPerTrigger`` bounds a batch.
    ``cleanSource`` and ``maxFileAge`` keep the list of known files short where
    files leave the landing area or never land late.
    """
    files = _reader(spark, streaming, options).format("text").schema(TEXT_SCHEMA).option("wholetext", "true").load(path)
    return _with_source_id(files, id_column)


def binary_files(
    spark: SparkSession, path: str, *, streaming: bool = True, id_column: str = "spec_file_source_id", **options
) -> DataFrame:
    """Bytes of every file under ``path`` with its path, length and change time."""
    files = _reader(spark, streaming, options).format("binaryFile").schema(BINARY_SCHEMA).load(path)
    return _with_source_id(files, id_column)
