"""The message tables of one file type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from segflow.config import PipelineConfig
from segflow.operators.messages import MALFORMED, PARSED, by_outcome
from segflow.operators.quality import repeated_keys
from segflow.operators.sections import requests, responses, supplemental
from segflow.sources.files import text_files
from segflow.sources.tables import stream_table
from segflow.streaming.outcomes import ERROR, OUTCOME, OutcomeStream, Sink
from segflow.streaming.pipelines import Pipeline
from segflow.streaming.tables import FILE_METADATA_TYPE, Column, StreamTable, packed

BRONZE_COLUMNS = (
    Column("transaction_file_source_id", "STRING", False, "Hash of the file metadata, one per landed file."),
    Column("file_metadata", FILE_METADATA_TYPE, False, "What the file source knows about the file."),
    Column("ingest_time", "TIMESTAMP", False, "Start of the batch that read the file.", "current_timestamp()"),
    Column("value", "STRING", True, "Whole text of the file."),
)


class MessagePipeline(Pipeline):
    """Text files of one type to text, VARIANT, request, response, supplemental, malformed and failed tables.

    Every method starts one append-only stream that stops once it has taken all
    available input. Texts and variants are stored in between, so a message is
    parsed once however many tables are derived from it. A text that makes the
    parse fail, as one too large for a VARIANT, is set aside with the error.
    ``check`` adds a stream that reports repeated ids.
    """

    def __init__(
        self,
        spark: SparkSession,
        config: PipelineConfig,
        file_type: str,
        *,
        keep_messages: bool = True,
        check: bool = False,
        **source_options,
    ) -> None:
        self.spark = spark
        self.config = config
        self.file_type = file_type
        self.keep_messages = keep_messages
        self.check = check
        self.source_options = source_options
        self.bronze = StreamTable(
            self._table("bronze"),
            BRONZE_COLUMNS,
            f"{file_type} files as whole texts.",
            primary_key="transaction_file_source_id",
            cluster_by=("file_metadata.file_path",),
        )
        self.variant = self._derived("bronze_variant", "messages parsed from XML")
        self.malformed = self._derived("bronze_malformed", "texts that are not well-formed, kept as they came")
        self.failed = self._derived("bronze_failed", "texts that the parse failed on, with its error")
        self.repeated = self._derived("bronze_repeated", "ids of more than one row")
        self.requests = self._derived("bronze_requests", "request segments and fields")
        self.responses = self._derived("bronze_responses", "response segments and fields")
        self.supplemental = self._derived("bronze_supplemental", "supplemental fields")

    def __repr__(self) -> str:
        return f"MessagePipeline(file_type={self.file_type!r}, config={self.config!r})"

    def _table(self, suffix: str) -> str:
        return self.config.table(f"{self.file_type}_{suffix}")

    def _derived(self, suffix: str, what: str) -> StreamTable:
        return StreamTable(self._table(suffix), (), f"{self.file_type} {what}.")

    def _variants(self) -> DataFrame:
        return stream_table(self.spark, self.variant.name)

    def stream_ingest(self) -> StreamingQuery | None:
        """Read new files; by the ledger, if the config says so, and then all is done on return."""
        path = self.config.landing_path(self.file_type)
        if self.config.ledger:
            text = F.col("content").cast("string")
            self.by_ledger(self.bronze, path, content=text, id_column="transaction_file_source_id")
            return None
        return self.bronze.append(packed(text_files(self.spark, path, **self.source_options), self.config), self.config)

    def variant_transform(self) -> StreamingQuery:
        """Parse each text once, into the tables of variants, of malformed texts, and of texts that cannot be processed."""
        kept = tuple(c.name for c in BRONZE_COLUMNS if c.name != "value")
        split = OutcomeStream(
            self.parse,
            {PARSED: Sink(self.variant, (*kept, "messages")), MALFORMED: Sink(self.malformed, (*kept, "value"))},
            self.config,
            failed=Sink(self.failed, (*kept, "value", ERROR)),
            key=("transaction_file_source_id",),
        )
        return split.append(stream_table(self.spark, self.bronze.name))

    def parse(self, texts: DataFrame) -> DataFrame:
        """Texts to parsed and malformed rows; a subclass may parse otherwise."""
        return by_outcome(texts)

    def check_keys(self) -> StreamingQuery:
        """Report ids that occur more than once, as their rows arrive, and count NULLs where the table allows none."""
        required = tuple(c.name for c in BRONZE_COLUMNS if not c.nullable)
        repeated = repeated_keys(stream_table(self.spark, self.bronze.name), self.bronze.primary_key, required=required)
        sink = Sink(self.repeated, (self.bronze.primary_key, "n_rows"))
        report = OutcomeStream(lambda rows: rows.withColumn(OUTCOME, F.lit("repeated")), {"repeated": sink}, self.config)
        return report.append(repeated, "update")

    def extract_requests(self) -> StreamingQuery:
        return self.requests.append(requests(self._variants(), keep_messages=self.keep_messages), self.config)

    def extract_responses(self) -> StreamingQuery:
        return self.responses.append(responses(self._variants(), keep_messages=self.keep_messages), self.config)

    def extract_supplemental(self) -> StreamingQuery:
        return self.supplemental.append(supplemental(self._variants(), keep_messages=self.keep_messages), self.config)

    def stages(self) -> list[list]:
        """Starters of the streams; those of one stage only need the stages before."""
        return [
            [self.stream_ingest],
            [self.variant_transform, *([self.check_keys] if self.check else [])],
            [self.extract_requests, self.extract_responses, self.extract_supplemental],
        ]

    def tables(self) -> list[StreamTable]:
        """All tables, dependents first."""
        checked = [self.repeated] if self.check else []
        return [*checked, self.supplemental, self.responses, self.requests, self.failed, self.malformed, self.variant, self.bronze]


def message_pipelines(spark: SparkSession, config: PipelineConfig, **options) -> list[MessagePipeline]:
    """One independent pipeline for each file type of the config."""
    return [MessagePipeline(spark, config, file_type, **options) for file_type in config.file_types]
