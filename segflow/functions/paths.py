"""File-name predicates that decide how a document is handled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Extensions of documents that need parsing.
PARSE_EXTENSIONS = (".pdf", ".jpg", ".jpeg", ".png", ".doc", ".docx", ".ppt", ".pptx")
EXTENSION_PATTERN = r"(\.[^.]+)$"


def file_extension(path: Column) -> Column:
    """Lower-case text from the last dot on, dot included; '' without a dot."""
    return F.lower(F.regexp_extract(path, EXTENSION_PATTERN, 1))


def needs_parsing(path: Column, extensions: Sequence[str] = PARSE_EXTENSIONS) -> Column:
    """Whether a file goes to the parser, by its extension: dot included, any case."""
    return file_extension(path).isin(*[ext.lower() for ext in extensions])


def declare_parse_extensions(
    spark: SparkSession, name: str = "parse_extensions", extensions: Sequence[str] = PARSE_EXTENSIONS
) -> str:
    """Publish the extension list as a SQL session variable and return its name."""
    listed = ", ".join("'" + ext.lower().replace("\\", "\\\\").replace("'", "\\'") + "'" for ext in extensions)
    spark.sql(f"DECLARE OR REPLACE VARIABLE {name} ARRAY<STRING> DEFAULT array({listed})")
    return name
