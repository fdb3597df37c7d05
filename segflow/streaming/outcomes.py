"""One pass over a stream that feeds several tables, and sets rows aside that cannot be processed.

A batch is transformed once and written once, split by outcome, into a hidden
folder; then the files of each outcome are moved into their table. The write
counts when its mark is there, so a batch that is run again after a crash is
not transformed again, and only files not yet moved are moved: each row reaches
its tables once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from segflow.config import PipelineConfig
from segflow.storage import Storage
from segflow.streaming.tables import StreamTable

OUTCOME = "_outcome"
ERROR = "error"
#: Parts that a set of rows is cut into, again and again, until the rows that fail are alone.
SLICES = 16
#: More failing rows in a batch than this are no matter of single rows: the batch fails as a whole.
FAILURES_AT_MOST = 100
#: Slices written side by side; each is a job of its own, most of them of few rows.
SLICES_AT_ONCE = 8
#: Rows of a slice that a task takes, about: a task that fails is run again, with all its rows, before its job fails.
ROWS_AT_ONCE = 4_096
_SLICE, _HASH = "_slice", "_hash"
_WRITTEN = "_WRITTEN"
_ERROR_CHARS = 2_000


@dataclass(frozen=True)
class Sink:
    """A table and the columns it takes from the transformed rows."""

    table: StreamTable
    columns: tuple[str, ...]


class OutcomeStream:
    """Appends the rows of a stream to the tables named by their outcomes.

    ``transform`` turns rows into rows with a column ``_outcome``, which names
    one of ``sinks``. With ``failed``, a sink whose columns are among the input's
    and ``error``, rows for which the transformation fails go there: the batch is cut
    by a hash of ``key`` until they are alone, and all others are processed. A failure
    only counts against a row if the row fails twice by itself while the
    cluster still answers. The first sink's table names the checkpoint.
    """

    def __init__(
        self,
        transform: Callable[[DataFrame], DataFrame],
        sinks: Mapping[str, Sink],
        config: PipelineConfig,
        *,
        failed: Sink | None = None,
        key: tuple[str, ...] = (),
        failures_at_most: int = FAILURES_AT_MOST,
    ) -> None:
        self.transform = transform
        self.sinks = dict(sinks)
        self.config = config
        self.failed = failed
        self.key = key
        self.failures_at_most = failures_at_most

    def append(self, rows: DataFrame, output_mode: str = "append") -> StreamingQuery:
        """Start appending all available rows; a rerun continues where the last one ended."""
        spark = rows.sparkSession
        schema = self.transform(rows)
        for sink in self.sinks.values():
            sink.table.create(spark, schema.select(*sink.columns).schema, self.config)
        if self.failed:
            with_error = rows.withColumn(ERROR, F.lit("").cast("string"))
            self.failed.table.create(spark, with_error.select(*self.failed.columns).schema, self.config)
        first = next(iter(self.sinks.values())).table
        return (
            rows.writeStream.foreachBatch(lambda batch, number: self._take(spark, first.location(spark), batch, number))
            .queryName(f"{first.name}_{uuid.uuid4().hex[:8]}")
            .option("checkpointLocation", first.checkpoint(spark, self.config))
            .outputMode(output_mode)
            .trigger(availableNow=True)
            .start()
        )

    def _take(self, spark: SparkSession, home: str, batch: DataFrame, number: int) -> None:
        storage = Storage(spark)
        staged = f"{home}/_staged/{number}"
        storage.delete(f"{home}/_staged/{number - 1}")  # this batch is only here because that one is complete
        if not storage.exists(f"{staged}/{_WRITTEN}"):
            storage.delete(staged)
            self._write(storage, batch, staged)
            storage.touch(f"{staged}/{_WRITTEN}")
        sinks = {**self.sinks, **({ERROR: self.failed} if self.failed else {})}
        for outcome, sink in sinks.items():
            target = sink.table.location(spark)
            for part in storage.children(f"{staged}/rows"):
                folder = f"{staged}/rows/{part}/{OUTCOME}={outcome}"
                for file in storage.children(folder):
                    if not file.startswith(("_", ".")):
                        storage.move(f"{folder}/{file}", f"{target}/b{number:08d}-{part}-{file}")
            spark.catalog.refreshTable(sink.table.name)

    def _write(self, storage: Storage, batch: DataFrame, staged: str) -> None:
        try:
            self._write_part(batch, f"{staged}/rows/all")
        except Exception as failure:
            if not self.failed or not self.key:
                raise
            storage.delete(f"{staged}/rows/all")
            self._write_parts(storage, batch.withColumn(_HASH, F.xxhash64(*self.key)), staged, "", [], failure)

    def _write_part(self, rows: DataFrame, path: str) -> None:
        self.transform(rows).write.format(self.config.table_format).partitionBy(OUTCOME).save(path)

    def _write_parts(
        self, storage: Storage, rows: DataFrame, staged: str, name: str, found: list[str], first: Exception
    ) -> None:
        """Write what can be written of rows that fail together. They are stored by slices of their hash, so each is read alone."""
        spark = rows.sparkSession
        held, depth = f"{staged}/_failing/{name or 'all'}", len(name)
        slice_of = F.shiftright(_HASH, 4 * depth).bitwiseAND(SLICES - 1)
        rows.withColumn(_SLICE, slice_of).write.format(self.config.table_format).partitionBy(_SLICE).save(held)
        with_slice = StructType([*rows.schema.fields, StructField(_SLICE, IntegerType())])
        stored = spark.read.schema(with_slice).format(self.config.table_format).load(held)
        one_hash = (F.min(_HASH) == F.max(_HASH)).alias("alone")
        slices = sorted(stored.groupBy(_SLICE).agg(F.count("*").alias("n"), one_hash).collect())

        def part_of(number: int) -> tuple[str, DataFrame, str]:
            part = name + format(number, "x")
            some = spark.read.schema(rows.schema).format(self.config.table_format).load(f"{held}/{_SLICE}={number}")
            return part, some, f"{staged}/rows/{part}"

        def written(held_slice: tuple[int, int, bool]) -> Exception | None:
            number, n, _ = held_slice
            _, some, target = part_of(number)
            few = some.repartition(-(-n // ROWS_AT_ONCE)) if n > ROWS_AT_ONCE else some.coalesce(1)
            return self._failure(storage, few.drop(_HASH), target)

        with ThreadPoolExecutor(SLICES_AT_ONCE) as pool:
            failures = list(pool.map(inheritable_thread_target(spark)(written), slices))
        for (number, _, alone), failure in zip(slices, failures):
            if failure is None:
                continue
            part, some, target = part_of(number)
            if not alone:
                self._write_parts(storage, some, staged, part, found, first)
                continue
            spark.range(1).count()  # raises if the cluster, not the row, is at fault
            failure = self._failure(storage, some.drop(_HASH), target)
            if failure is None:
                continue
            found.append(part)
            if len(found) > self.failures_at_most:
                raise first
            told = some.withColumn(ERROR, F.lit(_message(failure))).select(*self.failed.columns)
            told.write.format(self.config.table_format).save(f"{target}/{OUTCOME}={ERROR}")
        storage.delete(held)

    def _failure(self, storage: Storage, rows: DataFrame, path: str) -> Exception | None:
        try:
            self._write_part(rows, path)
        except Exception as failure:
            storage.delete(path)
            return failure
        return None


def _message(failure: Exception) -> str:
    """The innermost cause that Spark names, in one line of bounded length."""
    lines = [line.strip() for line in str(failure).splitlines() if line.strip()]
    causes = [line for line in lines if line.startswith("Caused by:")] or lines
    return causes[-1].removeprefix("Caused by:").strip()[:_ERROR_CHARS] if causes else type(failure).__name__
