"""Tables as inputs, in batch or as append-only streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# Table files are far larger than landed ones; see FILES_PER_BATCH for those. They are
# written in time order and read oldest first, so Spark's own age limit loses none and
# keeps the list of known files short.
TABLE_FILES_PER_BATCH = 10_000


def stream_table(spark: SparkSession, name: str, **options) -> DataFrame:
    """Rows appended to a table, each delivered once, a bounded number of its files at a time."""
    return spark.readStream.options(**{"maxFilesPerTrigger": TABLE_FILES_PER_BATCH, **options}).table(name)


def stream_table_sql(spark: SparkSession, name: str, select: str = "*") -> DataFrame:
    """The same inside a SQL query."""
    return spark.sql(f"SELECT {select} FROM STREAM({name})")


def table_by_parameter(spark: SparkSession, name: str) -> DataFrame:
    """Batch scan of a table or view whose name arrives as a query parameter."""
    return spark.sql("SELECT * FROM IDENTIFIER(:source)", args={"source": name})


def preview(spark: SparkSession, name: str, rows: int = 20) -> DataFrame:
    """A few rows of a table for a look at its content."""
    return table_by_parameter(spark, name).limit(rows)
