"""Ingest of landed files by a ledger instead of a list of names on the driver.

Spark's file stream keeps the name of every file it has read in the driver's
memory. Here the names read so far are rows of a ledger, partitioned by folder;
tasks list the folders, and an anti-join tells which files are new. The driver
only ever holds the names of folders of one level that a setting bounds, and
counts.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import cloudpickle, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow.config import PipelineConfig
from segflow.functions.ids import file_source_id
from segflow.scratch import new_scratch_dir
from segflow.sources.files import FILES_PER_BATCH
from segflow.storage import Storage
from segflow.streaming.tables import StreamTable

# What tasks run travels with the plan, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Columns of a listing: folder relative to the landing path ("." for itself), path, path as URI, bytes, change time.
LISTING = "folder string, path string, uri string, size long, modified timestamp, is_folder boolean"
#: Names in a batch of a listing, and bytes of content that a task hands on at a time.
_NAMES, _BYTES = 10_000, 32 << 20
#: Bytes of files that one task reads, about.
_TASK_BYTES = 128 << 20
#: Batches taken side by side: each is a few short jobs, and files moved by the driver.
_BATCHES_AT_ONCE = 4
_WRITTEN, _BATCH = "_WRITTEN", "_batch"
_unsafe = re.compile(r'[\x00-\x20"#%<>?\[\]\\^`{|}\x7f]')


def as_uri(base: str, path: str) -> str:
    """A file's path the way Spark's file metadata writes it: scheme and host of `base`, characters escaped that a URI must not hold."""
    scheme, host = re.match(r"(?:([a-z0-9+.-]+):)?(?://([^/]*))?", base).groups()
    escaped = _unsafe.sub(lambda m: f"%{ord(m[0]):02X}", path)
    return f"{scheme or 'file'}:{f'//{host}' if host else ''}{escaped}"


def _list_folders(folders: DataFrame, root: str) -> DataFrame:
    """What lies in each of the folders, hidden names left out; a folder that is gone lists as empty."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        filesystem, base = fs.FileSystem.from_uri(root)
        start = as_uri(root, "")
        names = ["folder", "path", "uri", "size", "modified", "is_folder"]
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                where = base if folder == "." else f"{base}/{folder}"
                found = [f for f in filesystem.get_file_info(fs.FileSelector(where, allow_not_found=True)) if f.base_name[0] not in "_."]
                for at in range(0, len(found), _NAMES):
                    some = found[at : at + _NAMES]
                    inside = [f.type == fs.FileType.Directory for f in some]
                    paths = [f.path for f in some]
                    below = "" if folder == "." else f"{folder}/"
                    columns = [
                        pa.array([below + f.base_name if i else folder for f, i in zip(some, inside)], pa.string()),
                        pa.array(paths, pa.string()),
                        pa.array([as_uri(root, p) if _unsafe.search(p) else start + p for p in paths], pa.string()),
                        pa.array([f.size or 0 for f in some], pa.int64()),
                        pa.array([(f.mtime_ns or 0) // 1_000_000 * 1_000 for f in some], pa.timestamp("us", "UTC")),
                        pa.array(inside, pa.bool_()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return folders.select("folder").repartition("folder").mapInArrow(listed, LISTING)


def list_files(spark: SparkSession, root: str, newest: int | None = None) -> DataFrame:
    """Every file below a landing folder, at any depth, listed by tasks: one for each folder.

    With `newest`, only the so many folders directly below the root whose names are last in
    order are looked into: enough where folders are named by date and older ones are closed. Files
    beside those folders are always listed.
    """
    levels = []
    folders = spark.createDataFrame([(".",)], "folder string")
    while True:
        stored = new_scratch_dir(spark, "listing")
        _list_folders(folders, root).write.parquet(stored)
        level = spark.read.schema(LISTING).parquet(stored)
        levels.append(level.filter("NOT is_folder"))
        folders = level.filter("is_folder").select("folder")
        if newest is not None and len(levels) == 1:
            folders = folders.orderBy(F.desc("folder")).limit(newest)
        if folders.isEmpty():
            break
    files = levels[0]
    for level in levels[1:]:
        files = files.unionAll(level)
    return files.filter("size > 0").drop("is_folder")


def with_contents(files: DataFrame, root: str) -> DataFrame:
    """The files with their bytes, `content`; one that is gone since it was listed has no row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        filesystem, _ = fs.FileSystem.from_uri(root)
        for batch in batches:
            rows, contents, held = [], [], 0
            for i, path in enumerate(batch.column(batch.schema.get_field_index("path")).to_pylist()):
                try:
                    with filesystem.open_input_stream(path, compression=None) as file:
                        content = file.read()
                except FileNotFoundError:
                    continue
                rows.append(i)
                contents.append(content)
                held += len(content)
                if held >= _BYTES:
                    yield with_column(batch, rows, contents)
                    rows, contents, held = [], [], 0
            if rows:
                yield with_column(batch, rows, contents)

    def with_column(batch: pa.RecordBatch, rows: list[int], contents: list[bytes]) -> pa.RecordBatch:
        taken = batch.take(pa.array(rows))
        return pa.RecordBatch.from_arrays([*taken.columns, pa.array(contents, pa.binary())], [*taken.schema.names, "content"])

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in files.schema.fields)
    return files.mapInArrow(read, f"{columns}, content binary")


def file_metadata() -> Column:
    """The metadata struct of Spark's file sources, from the columns of a listing."""
    return F.struct(
        F.col("uri").alias("file_path"),
        F.substring_index("uri", "/", -1).alias("file_name"),
        F.col("size").alias("file_size"),
        F.lit(0).cast("long").alias("file_block_start"),
        F.col("size").alias("file_block_length"),
        F.col("modified").alias("file_modification_time"),
    )


class LedgerIngest:
    """Appends each landed file to a table once, as one row, by a ledger of the files read.

    The ledger belongs to the table's generation and lies beside its checkpoints. A file is known by
    its path, whenever it lands and whatever its change time. New files are taken in batches of about
    `files_per_batch`. A batch's rows and ledger entries are written to a hidden folder, marked as
    complete, and then moved, rows first; what a crash interrupts is taken up by the next run before
    it lists anything, so no file is read twice or lost. The driver lists the ledger's own files: one
    for each folder and batch, not one for each landed file.
    """

    def __init__(
        self,
        spark: SparkSession,
        config: PipelineConfig,
        table: StreamTable,
        path: str,
        *,
        content: Column,
        id_column: str,
        extra: dict[str, Column] | None = None,
        newest: int | None = None,
        files_per_batch: int = FILES_PER_BATCH,
    ) -> None:
        self.spark = spark
        self.config = config
        self.table = table
        self.root = path if "://" in path else Storage(spark).qualified(path).replace("file:/", "file:///", 1)
        self.columns = {**(extra or {}), "_content": content}
        self.id_column = id_column
        self.newest = newest
        self.files_per_batch = files_per_batch
        self.storage = Storage(spark)

    def ledger_path(self) -> str:
        return f"{self.table.checkpoint(self.spark, self.config)}/ledger"

    def ledger(self) -> DataFrame:
        """`path`, `modified`, `batch` of every file read, by `folder`."""
        schema = "path string, modified timestamp, batch string, folder string"
        if not self.storage.children(self.ledger_path()):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.ledger_path()).parquet(self.ledger_path())

    def run(self) -> int:
        """Read all files that are new; returns how many batches that took."""
        self.table.create(self.spark, None, self.config)
        home = self.table.location(self.spark)
        if self.storage.exists(f"{home}/_spark_metadata"):
            raise ValueError(f"{self.table.name} is fed by a stream; a full refresh gives it a ledger")
        for batch in self.storage.children(f"{home}/_staged"):
            self._publish(home, batch)
        found = new_scratch_dir(self.spark, "new-files")
        known = self.ledger().select("folder", "path")
        listed = list_files(self.spark, self.root, self.newest)
        if self.newest is not None:
            # Only the ledger's partitions of the folders that were listed take part.
            known = known.join(listed.select("folder").distinct(), "folder", "left_semi")
        # Names compress well, so Spark would broadcast a ledger of many: they are shuffled instead.
        listed.join(known.hint("merge"), ["folder", "path"], "left_anti").write.parquet(found)
        new = self.spark.read.schema(listed.schema).parquet(found)
        n, size = new.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
        batches = -(-n // self.files_per_batch)
        if batches > 1:
            # Each batch's names lie apart, so that no batch reads those of all others.
            sliced = new_scratch_dir(self.spark, "new-files")
            numbered = new.withColumn(_BATCH, F.pmod(F.xxhash64("path"), F.lit(batches)))
            numbered.repartition(_BATCH).write.partitionBy(_BATCH).parquet(sliced)
            folders = [f"{sliced}/{name}" for name in self.storage.children(sliced) if name.startswith(f"{_BATCH}=")]
            self._take_all(home, [self.spark.read.schema(listed.schema).parquet(folder) for folder in folders], size // batches)
            self.storage.delete(sliced)
        elif batches:
            self._take(home, new, size)
        self.storage.delete(found)
        return batches

    def _take_all(self, home: str, batches: list[DataFrame], size: int) -> None:
        """Take batches side by side; after a failure no other one is begun."""
        take = inheritable_thread_target(self.spark)(self._take)
        with ThreadPoolExecutor(_BATCHES_AT_ONCE) as pool:
            taken = [pool.submit(take, home, files, size) for files in batches]
            try:
                for one in taken:
                    one.result()
            except BaseException:
                pool.shutdown(wait=True, cancel_futures=True)
                raise

    def _take(self, home: str, files: DataFrame, size: int) -> None:
        batch = uuid.uuid4().hex
        staged = f"{home}/_staged/{batch}"
        tasks = max(self.spark.sparkContext.defaultParallelism, size // _TASK_BYTES)
        read = with_contents(files.repartition(tasks), self.root).withColumn("file_metadata", file_metadata())
        rows = read.select(
            "folder",
            F.col("path").alias("_listed"),
            file_source_id(F.col("file_metadata")).alias(self.id_column),
            "file_metadata",
            F.current_timestamp().alias("ingest_time"),
            *[value.alias(name if name != "_content" else self._content_name()) for name, value in self.columns.items()],
        )
        declared = self.table.declared(rows).columns
        if self.config.ingest_partitions:
            rows = rows.coalesce(max(1, self.config.ingest_partitions))
        rows.select("folder", "_listed", *declared).write.format(self.config.table_format).save(f"{staged}/rows")
        written = self.spark.read.format(self.config.table_format).load(f"{staged}/rows")
        entries = written.select(
            F.col("_listed").alias("path"), F.col("file_metadata.file_modification_time").alias("modified"), F.lit(batch).alias("batch"), "folder"
        )
        entries.repartition("folder").write.partitionBy("folder").parquet(f"{staged}/ledger")
        self.storage.touch(f"{staged}/{_WRITTEN}")
        self._publish(home, batch)

    def _content_name(self) -> str:
        return self.table.columns[-1].name

    def _publish(self, home: str, batch: str) -> None:
        """Move a complete batch into the table and the ledger; forget one that is not complete."""
        staged, ledger = f"{home}/_staged/{batch}", self.ledger_path()
        if self.storage.exists(f"{staged}/{_WRITTEN}"):
            self._move(f"{staged}/rows", home, batch)
            for folder in self.storage.children(f"{staged}/ledger"):
                if not folder.startswith(("_", ".")):
                    self.storage.make_folder(f"{ledger}/{folder}")
                    self._move(f"{staged}/ledger/{folder}", f"{ledger}/{folder}", batch)
            self.spark.catalog.refreshTable(self.table.name)
        self.storage.delete(staged)

    def _move(self, source: str, target: str, batch: str) -> None:
        for file in self.storage.children(source):
            if not file.startswith(("_", ".")):
                self.storage.move(f"{source}/{file}", f"{target}/b-{batch}-{file}")
