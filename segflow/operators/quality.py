"""Checks of declared constraints, as one-pass aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(rows: DataFrame, *columns: str) -> DataFrame:
    """One row with the number of NULLs in each column declared NOT NULL."""
    return rows.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def duplicate_keys(rows: DataFrame, *key: str) -> DataFrame:
    """Key values that occur more than once, with their row counts."""
    return rows.groupBy(*key).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


#: Name of the metrics that ``repeated_keys`` takes of each batch: `rows`, and NULLs by column.
CHECKS = "checks"


def repeated_keys(rows: DataFrame, *key: str, required: tuple[str, ...] = ()) -> DataFrame:
    """Of a stream, each key that has more rows than one by now, whenever a batch brings another row of it.

    The number of rows of every key is state of the stream, kept in partitions by key and saved with the
    checkpoint: earlier rows are not read again, and nothing grows with a key's rows. Rows are counted
    on the map side first, so a key of many rows is not gathered. To be written in update mode. How
    many rows a batch has, and how many NULLs in the key and `required` columns, is observed on the
    way and reported with the batch's progress as CHECKS. A NULL key is a key like others.
    """
    nulls = [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in dict.fromkeys((*key, *required))]
    watched = rows.observe(CHECKS, F.count("*").alias("rows"), *nulls)
    return watched.groupBy(*key).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
