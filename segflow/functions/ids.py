"""Row ids of landed files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fields of the hidden file metadata struct, in hashing order.
METADATA_FIELDS = (
    "file_path",
    "file_name",
    "file_size",
    "file_block_start",
    "file_block_length",
    "file_modification_time",
)


def utc_text(ts: Column) -> Column:
    """Timestamp as its UTC wall-clock text, whatever the session time zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch).cast("string")


def file_source_id(metadata: Column) -> Column:
    """SHA-256 over all metadata fields, glued without a separator.

    A timestamp turns into text by session zone; hashing its UTC form keeps the
    id equal between clusters.
    """
    *plain, modified = METADATA_FIELDS
    parts = [metadata[name].cast("string") for name in plain] + [utc_text(metadata[modified])]
    return F.sha2(F.concat(*parts), 256)
