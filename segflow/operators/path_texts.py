"""One text for each path, however many documents and parts share it: ordered, in numbered chunks of bounded size."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segflow.functions.variants import evaluated_once
from segflow.operators.documents import PART_SEPARATOR, error_status, part_contents
from segflow.scratch import new_scratch_dir

# What tasks run travels with the plan, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of text after which a new chunk begins.
CHUNK_BYTES = 16 << 20
_SEPARATOR_BYTES = len(PART_SEPARATOR.encode())


def _running_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To sorted rows (path, ..., bytes), the partition and the bytes of the path's earlier rows in it."""
    part = TaskContext.get().partitionId()
    path, held = None, 0
    for batch in batches:
        paths = batch.column(0).to_pylist()
        sizes = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
        if not paths:
            continue
        starts = np.flatnonzero([True] + [a != b for a, b in zip(paths, paths[1:])])
        total = np.cumsum(sizes)
        before = total - sizes
        base = np.repeat(before[starts], np.diff(np.r_[starts, len(paths)]))
        offset = before - base
        if paths[0] == path:
            first = starts[1] if len(starts) > 1 else len(paths)
            offset[:first] += held
        path, held = paths[-1], int(offset[-1] + sizes[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(paths), part, np.int32)), pa.array(offset.astype(np.int64))],
            [*batch.schema.names, "part", "before"],
        )


def text_chunks(parsed: DataFrame, order: tuple[str, ...], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """`path, chunk, text`: the contents of all successfully parsed documents of a path, by `order` and index.

    A path's text is its contents joined by a blank line. It comes in chunks: chunk k holds the
    contents that start within its k-th `chunk_bytes` bytes, so where chunks end depends on the text
    only, and the chunks joined by a blank line are the text. No cell holds more than a chunk and
    one content, and no task more than its share, also if all parts have one path: parts are sorted
    by ranges, a running sum of bytes gives each its place within a range, and the sums of a path's
    ranges, a row for each, give the place of the range. Contents that are absent or JSON null add
    nothing; a path with only such contents has an empty text, if one of them is not absent. Rows
    without a path are left out.
    """
    spark = parsed.sparkSession
    contents = (
        parsed.filter(error_status(F.col("parsed")).isNull() & F.col("path").isNotNull())
        .select("path", F.struct(*order).alias("document"), evaluated_once(part_contents(F.col("parsed"))).alias("contents"))
        .select("path", "document", F.posexplode("contents").alias("idx", "content"))
        .filter("content IS NOT NULL")
        .withColumn("text", F.col("content").cast("string"))
        .drop("content")
    )
    size = (F.octet_length("text") + _SEPARATOR_BYTES).cast("long").alias("bytes")
    keys = ["path", "document", "idx"]
    ordered = contents.filter("text IS NOT NULL").select(*keys, "text", size).repartitionByRange(*keys).sortWithinPartitions(*keys, "text")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema.fields)
    stored = new_scratch_dir(spark, "path-parts")
    ordered.mapInArrow(_running_bytes, f"{columns}, part int, before long").write.parquet(stored)
    placed = spark.read.parquet(stored)
    earlier = Window.partitionBy("path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        placed.groupBy("path", "part")
        .agg(F.sum("bytes").alias("bytes"))
        .select("path", "part", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("base"))
    )
    chunk = F.floor((F.col("base") + F.col("before")) / chunk_bytes).alias("chunk")
    entries = F.array_sort(F.collect_list(F.struct("document", "idx", "text")))
    texts = placed.join(ranges, ["path", "part"]).groupBy("path", chunk).agg(
        F.array_join(F.transform(entries, lambda e: e["text"]), PART_SEPARATOR).alias("text")
    )
    silent = contents.groupBy("path").agg(F.max(F.col("text").isNotNull()).alias("told")).filter("NOT told")
    return texts.unionByName(silent.select("path", F.lit(0).cast("long").alias("chunk"), F.lit("").alias("text")))


def rows_by_reference(parsed: DataFrame, chunks: DataFrame, *carried: str) -> DataFrame:
    """`carried` columns, `path`, `raw_parsed` and `n_chunks` of each row whose path has a text.

    The text itself stays in the table of chunks, once, under its path and the chunk numbers 0 to
    `n_chunks` - 1; n rows of a path do not copy it n times, as a join to the text would.
    """
    counts = chunks.groupBy("path").agg(F.count("*").alias("n_chunks"))
    rows = parsed.join(counts, "path")
    return rows.select(*carried, "path", F.col("parsed").alias("raw_parsed"), "n_chunks")
