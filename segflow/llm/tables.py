"""Stored intermediate tables, joins that survive hot keys, and running totals over many rows."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from segflow.scratch import new_scratch_dir

#: A key with more than one in HOT_SHARE of all rows counts as hot, so there are fewer than HOT_SHARE such keys.
HOT_SHARE = 4096
#: Cells of split_by_keys; all of them take some 60 MB as a broadcast table.
KEY_CELLS = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows written to the session's shared folder and read back: lineage ends here."""
    path = new_scratch_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def stored_by(rows: DataFrame, label: str, column: str) -> tuple[DataFrame, int]:
    """The rows stored in buckets of a column, and the number of buckets: that of the session's shuffle partitions.

    A shuffle hash join with rows that are repartitioned to that number by the same column, and by it
    alone, moves only the latter. The table has no name afterwards; its files stay in the session's
    shared folder.
    """
    spark = rows.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{label}_{uuid.uuid4().hex}"
    out = rows.write.option("path", new_scratch_dir(spark, label)).option("compression", "zstd")
    out.bucketBy(buckets, column).saveAsTable(name)
    found = spark.table(name)
    found.schema  # read from the files' folder from here on
    spark.sql(f"DROP TABLE {name}")
    return found, buckets


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def content_key(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(text.cast("binary")))


#: Bytes of text that a worker takes at a time.
SLICE_BYTES = 1 << 20


def text_slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about SLICE_BYTES of text, so what a worker holds does not grow with the batch.

    A longer text has a batch to itself. After the last one, memory that the worker no longer needs
    goes back to the system, as workers live on and serve other stages.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        slices = np.cumsum(sizes + 16) // SLICE_BYTES
        starts = np.flatnonzero(np.r_[True, slices[1:] != slices[:-1]][: len(slices)])
        for a, b in zip(starts, np.r_[starts[1:], len(slices)]):
            yield batch.slice(a, b - a)
    release_memory()


def release_memory() -> None:
    """Give memory that this process holds but does not need back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str, how: str = "left") -> DataFrame:
    """Join rows with the one row that `groups` has for a key; `size` says how many rows share the key.

    Keys held by more than one in HOT_SHARE rows are broadcast: there are fewer than HOT_SHARE of
    them, whatever the input. For the others no task can get more than that share.
    """
    total = groups.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    hot = groups.filter(F.col(size) > total / HOT_SHARE)
    common = rows.join(F.broadcast(hot), on, "inner")
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(groups, on, how)
    return common.unionByName(rest)


def split_by_keys(rows: DataFrame, column: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose 64-bit `column` may be among the keys' values of that column, and rows for which it is not.

    The keys' values fall in KEY_CELLS cells, and the cells that hold any are broadcast: never more
    than KEY_CELLS numbers, however many keys there are. Few keys spare most rows the shuffle of an
    exact join; the more there are, the more rows it gets, and it decides for all of them.
    """
    cell = F.pmod(F.xxhash64(column), F.lit(KEY_CELLS)).cast("int").alias("_seg_cell")
    cells = F.broadcast(keys.select(cell).distinct())
    marked = rows.withColumn("_seg_cell", cell)
    return (
        marked.join(cells, "_seg_cell", "left_semi").drop("_seg_cell"),
        marked.join(cells, "_seg_cell", "left_anti").drop("_seg_cell"),
    )


def parts_for(n: int, each: int, least: int = 1) -> int:
    """How many parts of at most about `each` rows hold n rows."""
    return max(least, -(-n // each))


def totals_before(parts: DataFrame, part: str, count: str, out: str, block: int = 4096) -> DataFrame:
    """For each part, numbered from 0, the sum of `count` over the parts before it.

    Two levels, so that no task sees more than `block` parts or one row for each block.
    """
    blocked = parts.withColumn("_block", (F.col(part) / block).cast("long"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        blocked.groupBy("_block")
        .agg(F.sum(count).alias("_n"))
        .select("_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_block").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocked.join(blocks, "_block")
        .withColumn(out, (F.coalesce(F.sum(count).over(inside), F.lit(0)) + F.col("_before")).cast("long"))
        .drop("_block", "_before")
    )
