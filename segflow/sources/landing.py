"""Landing rows as files, one file each, written by the tasks that hold the rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def land_files(rows: DataFrame, directory: str, name: Column, content: Column) -> int:
    """Write ``content`` of every row to ``directory/name``; returns the file count.

    ``directory`` is a qualified URI. A file is written in a hidden folder of its
    task and then moved, so a reader never sees half of it and a repeated task
    only replaces a file by itself. File systems create the files of one folder
    one at a time, so tasks that share a landing folder would wait for each other.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        filesystem, base = fs.FileSystem.from_uri(directory)
        hidden = f"{base}/_{uuid.uuid4().hex}"
        made: set[str] = set()
        try:
            for batch in batches:
                for target, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    folder, _, file_name = f"{base}/{target}".rpartition("/")
                    for needed in {hidden, folder} - made:
                        filesystem.create_dir(needed, recursive=True)
                        made.add(needed)
                    with filesystem.open_output_stream(f"{hidden}/{file_name}", compression=None) as out:
                        out.write(body)
                    filesystem.move(f"{hidden}/{file_name}", f"{folder}/{file_name}")
                yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})
        finally:
            if hidden in made:
                filesystem.delete_dir(hidden)

    named = rows.select(name.cast("string").alias("name"), content.cast("binary").alias("content"))
    return named.mapInArrow(write, "files long").agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]
