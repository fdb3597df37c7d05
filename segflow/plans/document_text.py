"""Document files to a table with one text per document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segflow.functions.paths import PARSE_EXTENSIONS, needs_parsing
from segflow.functions.variants import evaluated_once
from segflow.operators.distribution import distribute_by_weight
from segflow.operators.documents import (
    Parser,
    error_status,
    first_files,
    has_content,
    join_contents,
    parse_options,
    part_contents,
    spread,
    utf8_text,
)
from segflow.streaming.generations import replace_rows


def documents_to_text(
    files: DataFrame,
    parser: Parser,
    *,
    limit: int | None = None,
    buckets: int | None = None,
    weight: Column | None = None,
    key: tuple[str, ...] = ("path",),
    extensions: Sequence[str] = PARSE_EXTENSIONS,
    image_output_path: str | None = None,
) -> DataFrame:
    """``path, raw_parsed, text, error_status`` for files with ``path`` and ``content``.

    Parsable files give their parts joined by a blank line or an error status,
    all others their decoded bytes. A parsed document without any content is
    left out.

    The files are read and parsed in one pass: each row finds its own branch, so
    there is neither a union of scans, nor a sort and grouping of parts, nor a
    join back to the parse. Other files reach the parser as NULL content. Only
    ``limit`` and ``buckets`` shuffle, and the parse stays behind both, as its
    result is kept from being inlined into the filter that reads it. A row is a
    document, also where rows share a path. ``extensions`` says which files are
    parsed; with an HTML parser, for instance, ``(".html", ".htm")``. With a
    ``weight``, as the bytes of the content, buckets come out even in that instead of in rows.
    """
    if limit is not None:
        files = first_files(files, limit, key)
    if buckets is not None:
        files = spread(files, buckets) if weight is None else distribute_by_weight(files, weight, buckets)

    path, content, parse = F.col("path"), F.col("content"), F.col("parse")
    routed = files.filter(path.isNotNull()).select("path", "content", needs_parsing(path, extensions).alias("parse"))
    result = parser(path, F.when(parse, content), parse_options(image_output_path))
    parsed = routed.select(
        "path",
        "parse",
        evaluated_once(F.when(parse, result)).alias("raw_parsed"),
        F.when(~parse, utf8_text(content)).alias("plain_text"),
    )
    raw = F.col("raw_parsed")
    read = parsed.select(
        "*", error_status(raw).alias("error_status"), evaluated_once(part_contents(raw)).alias("contents")
    )
    contents, failed = F.col("contents"), F.col("error_status").isNotNull()
    text = F.when(~parse, F.col("plain_text")).when(~failed, join_contents(contents))
    kept = read.filter(~parse | failed | has_content(contents))
    return kept.select("path", "raw_parsed", text.alias("text"), "error_status")


def replace_table(rows: DataFrame, name: str, provider: str = "parquet") -> None:
    """Create the table from the rows, or swap them in if it exists: readers see the old rows or the new ones, never none or both."""
    replace_rows(rows, name, provider)
