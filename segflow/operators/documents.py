"""Steps that turn document files into one text per document.

A parser is any function of three columns, path, content bytes and a map of
options, that returns a VARIANT shaped ``{metadata: {version}, document:
{pages|elements: [{content}]}, error_status}``. Version 1.0 lists its text under
``pages``, every other version under ``elements``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segflow.functions.paths import PARSE_EXTENSIONS, needs_parsing
from segflow.functions.variants import evaluated_once, member, member_list, member_text

Parser = Callable[[Column, Column, Column], Column]

# The blank line between the parts of a text, and the version
# that keeps its parts under "pages".
PART_SEPARATOR = "\n\n"
PAGED_VERSION = "1.0"

# Options every parser is given, beside "imageOutputPath".
PARSE_OPTIONS = {"version": "2.0", "descriptionElementTypes": "*"}


def first_files(files: DataFrame, n: int, key: tuple[str, ...] = ("path",)) -> DataFrame:
    """The first ``n`` files by path, ties broken by ``key``; never more than ``n`` rows.

    Only path and key take part in the top-n, so no file content is sorted or
    held in a heap. The last key it finds, and how many rows of it belong, come
    to the driver; all rows of smaller keys are taken, and of the last one as
    many as are missing, any of them if it names several. Where no key exists
    pass ``()``: then the rows themselves are sorted.
    """
    if not key:
        return files.orderBy("path").limit(n)
    order = tuple(dict.fromkeys(("path", *key)))
    chosen = files.select(*order).orderBy(*order).limit(n)
    last = chosen.groupBy(*order).agg(F.count("*").alias("rows_of_last")).orderBy(*[F.desc(c) for c in order]).first()
    if last is None:
        return files.limit(0)
    ends = [F.lit(last[c]).cast(files.schema[c].dataType) for c in order]
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(end) for c, end in zip(order, ends)])
    before = F.struct(*order) < F.struct(*[end.alias(c) for c, end in zip(order, ends)])
    return files.filter(before).unionAll(files.filter(same).limit(last["rows_of_last"]))


def spread(files: DataFrame, buckets: int) -> DataFrame:
    """Deal files evenly over ``buckets`` partitions, files without a path left out.

    Worth its shuffle when parsing costs far more than moving the bytes. A path
    that many rows share does not fill one bucket, as it would if the path were hashed.
    """
    return files.filter(F.col("path").isNotNull()).repartition(buckets)


def parsable_files(files: DataFrame, extensions: Sequence[str] = PARSE_EXTENSIONS) -> DataFrame:
    return files.filter(needs_parsing(F.col("path"), extensions))


def plain_files(files: DataFrame, extensions: Sequence[str] = PARSE_EXTENSIONS) -> DataFrame:
    return files.filter(~needs_parsing(F.col("path"), extensions))


def utf8_text(content: Column) -> Column:
    """Bytes as UTF-8 text; bytes that are not UTF-8 become U+FFFD."""
    return F.make_valid_utf8(content.cast("string"))


def parse_options(image_output_path: str | None = None) -> Column:
    options = {**PARSE_OPTIONS, "imageOutputPath": image_output_path}
    return F.create_map(*[F.lit(part).cast("string") for pair in options.items() for part in pair])


def parse_files(files: DataFrame, parser: Parser, *carried: str, image_output_path: str | None = None) -> DataFrame:
    """Apply the parser to every file; ``carried`` columns stay beside the result.

    Filters on the result never repeat the parse, nor meet files that an earlier
    filter took out. Store the rows if several steps read them.
    """
    parsed = parser(F.col("path"), F.col("content"), parse_options(image_output_path))
    return files.select(*(carried or ("path",)), evaluated_once(parsed).alias("parsed"))


def error_status(parsed: Column) -> Column:
    """Error text of a parse, NULL for a success."""
    return member_text(parsed, "error_status")


def parts(parsed: Column) -> Column:
    """The list that holds the text of the document, by its version."""
    version = member_text(parsed, "metadata", "version")
    return F.when(version == PAGED_VERSION, member_list(parsed, "document", "pages")).otherwise(
        member_list(parsed, "document", "elements")
    )


def part_contents(parsed: Column) -> Column:
    """Content of each part; SQL NULL where a part has none, JSON null kept."""
    return F.transform(parts(parsed), lambda part: member(part, "content"))


def join_contents(contents: Column) -> Column:
    return F.array_join(F.transform(contents, lambda c: c.cast("string")), PART_SEPARATOR)


def has_content(contents: Column) -> Column:
    return F.coalesce(F.exists(contents, lambda c: c.isNotNull()), F.lit(False))


def has_text(contents: Column) -> Column:
    """Like ``has_content``, but a JSON null does not count."""
    return F.coalesce(F.exists(contents, lambda c: c.cast("string").isNotNull()), F.lit(False))


def error_documents(parsed: DataFrame) -> DataFrame:
    status = error_status(F.col("parsed"))
    return parsed.filter(status.isNotNull()).select("path", F.col("parsed").alias("raw_parsed"), status.alias("error_status"))


def document_parts(parsed: DataFrame) -> DataFrame:
    """A row per part of each successfully parsed document, with its index."""
    return (
        parsed.filter(error_status(F.col("parsed")).isNull())
        .select("path", parts(F.col("parsed")).alias("parts"))
        .select("path", F.posexplode("parts").alias("idx", "element"))
        .select("path", "idx", member(F.col("element"), "content").alias("content"))
    )


def document_texts(parsed: DataFrame, *carried: str) -> DataFrame:
    """``carried`` columns, ``raw_parsed`` and ``text`` of each document, a row being a document.

    Parts are joined in index order within their row, so nothing is grouped or
    joined, and rows that share a path stay apart. Parts without content are left
    out, a JSON null adds nothing; errors and documents without content have no row.
    """
    contents = F.col("contents")
    return (
        parsed.filter(error_status(F.col("parsed")).isNull())
        .select(
            *(carried or ("path",)),
            F.col("parsed").alias("raw_parsed"),
            evaluated_once(part_contents(F.col("parsed"))).alias("contents"),
        )
        .filter(has_content(contents))
        .withColumn("text", F.when(has_text(contents), join_contents(contents)))
        .drop("contents")
    )


def texts_by_path(parsed: DataFrame) -> DataFrame:
    """One text per path, for tables where a path has few rows; otherwise see ``document_texts``.

    All texts of a path are gathered in one cell. Each row joins its own parts in index order first, so the grouping moves one
    text per row instead of every part, and gathers no more than what ends up in
    one cell. Parts without content are left out, a JSON null adds nothing, and
    a path without any content has no row.
    """
    texts = (
        parsed.filter(error_status(F.col("parsed")).isNull())
        .select("path", evaluated_once(part_contents(F.col("parsed"))).alias("contents"))
        .filter(has_content(F.col("contents")))
        .select("path", F.when(has_text(F.col("contents")), join_contents(F.col("contents"))).alias("text"))
    )
    return texts.groupBy("path").agg(
        F.array_join(F.array_sort(F.collect_list("text")), PART_SEPARATOR).alias("text")
    )


def with_raw(texts: DataFrame, parsed: DataFrame) -> DataFrame:
    """Put the raw parse beside the text of its path again, for paths of few rows; documents without text drop out.

    Spark takes the gathered texts for a fiftieth of the stored parses and would broadcast them, all through the driver: both
    sides are as large as the documents, so they are shuffled.
    """
    return texts.join(parsed.hint("merge"), "path").select("path", F.col("parsed").alias("raw_parsed"), "text")
