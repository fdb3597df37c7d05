"""Streams of document files: landing to table, table to parsed view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from segflow.config import PipelineConfig
from segflow.functions.paths import PARSE_EXTENSIONS
from segflow.operators.documents import Parser, parsable_files, parse_files
from segflow.sources.files import binary_files
from segflow.sources.tables import stream_table
from segflow.streaming.pipelines import Pipeline
from segflow.streaming.tables import FILE_METADATA_TYPE, Column, StreamTable, packed

# Names of the document datasets.
DOCUMENTS_TABLE = "specification_documents"
PARSED_VIEW = "parsed_documents"

DOCUMENT_COLUMNS = (
    Column("spec_file_source_id", "STRING", False, "Hash of the file metadata, one per landed file."),
    Column("file_metadata", FILE_METADATA_TYPE, False, "What the file source knows about the file."),
    Column("ingest_time", "TIMESTAMP", False, "Start of the batch that read the file.", "current_timestamp()"),
    Column("path", "STRING", True, "Full path of the file."),
    Column("modificationTime", "TIMESTAMP", True, "When the file was last changed."),
    Column("length", "BIGINT", True, "File size in bytes."),
    Column("content", "BINARY", True, "File content."),
)


class DocumentPipeline(Pipeline):
    """Ingests every document of a volume and offers the parsed ones as a stream."""

    def __init__(self, spark: SparkSession, config: PipelineConfig, **source_options) -> None:
        self.spark = spark
        self.config = config
        self.source_options = source_options
        self.documents = StreamTable(
            config.table(DOCUMENTS_TABLE),
            DOCUMENT_COLUMNS,
            "Document files with their content.",
            primary_key="spec_file_source_id",
            cluster_by=("path",),
        )

    def __repr__(self) -> str:
        return f"DocumentPipeline(config={self.config!r})"

    def stream_ingest(self) -> StreamingQuery | None:
        """Read new files; by the ledger, if the config says so, and then all is done on return."""
        path = self.config.landing_path()
        if self.config.ledger:
            facts = {"path": F.col("path"), "modificationTime": F.col("modified"), "length": F.col("size")}
            self.by_ledger(self.documents, path, content=F.col("content"), id_column="spec_file_source_id", extra=facts)
            return None
        return self.documents.append(packed(binary_files(self.spark, path, **self.source_options), self.config), self.config)

    def parse_documents(self, parser: Parser, extensions: Sequence[str] = PARSE_EXTENSIONS) -> str:
        """Register the streaming view of parsed documents and return its name."""
        stored = stream_table(self.spark, self.documents.name)
        parsed = parse_files(
            parsable_files(stored, extensions),
            parser,
            "spec_file_source_id",
            "path",
            image_output_path=self.config.image_output_path(),
        )
        parsed.createOrReplaceTempView(PARSED_VIEW)
        return PARSED_VIEW

    def stages(self) -> list[list]:
        return [[self.stream_ingest]]

    def tables(self) -> list[StreamTable]:
        return [self.documents]
