"""Append-only tables fed by streams."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from segflow.config import PipelineConfig
from segflow.storage import Storage
from segflow.streaming import generations

# The struct Spark's file sources keep about each file.
FILE_METADATA_TYPE = (
    "STRUCT<file_path: STRING, file_name: STRING, file_size: BIGINT, file_block_start: BIGINT, "
    "file_block_length: BIGINT, file_modification_time: TIMESTAMP>"
)


@dataclass(frozen=True)
class Column:
    name: str
    sql_type: str
    nullable: bool = True
    comment: str | None = None
    default: str | None = None

    def ddl(self) -> str:
        text = f"`{self.name}` {self.sql_type}"
        if not self.nullable:
            text += " NOT NULL"
        if self.default:
            text += f" DEFAULT {self.default}"
        if self.comment:
            text += f" COMMENT {_quoted(self.comment)}"
        return text


@dataclass(frozen=True)
class StreamTable:
    """A table declared by its columns, or by the query that feeds it if it has none.

    Its rows lie in a folder of their generation, after which the checkpoint of
    the stream that feeds it is named too. ``home`` is the name of the table
    whose generations these are, where it differs from the table's own.
    """

    name: str
    columns: tuple[Column, ...] = ()
    comment: str = ""
    primary_key: str | None = None
    cluster_by: tuple[str, ...] = ()
    home: str | None = None

    def append(self, rows: DataFrame, config: PipelineConfig) -> StreamingQuery:
        """Start appending all available rows; a rerun continues where the last one ended."""
        spark = rows.sparkSession
        self.create(spark, rows.schema, config)
        checkpoint = self.checkpoint(spark, config)
        if Storage(spark).exists(f"{checkpoint}/ledger"):
            raise ValueError(f"{self.name} is fed by a ledger; a full refresh lets a stream feed it")
        return (
            self.declared(rows)
            .writeStream.format(config.table_format)
            .outputMode("append")
            .queryName(f"{self.name}_{uuid.uuid4().hex[:8]}")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .toTable(self.name)
        )

    def declared(self, rows: DataFrame) -> DataFrame:
        """The rows with the declared columns and types, if there are any."""
        if not self.columns:
            return rows
        return rows.selectExpr(*[f"CAST(`{c.name}` AS {c.sql_type}) AS `{c.name}`" for c in self.columns])

    def create(self, spark: SparkSession, schema: StructType | None, config: PipelineConfig, location: str | None = None) -> None:
        """Make the table if it does not exist, with a first generation or with the rows at a location.

        The schema is only needed for a table that declares no columns.
        """
        if spark.catalog.tableExists(self.name):
            return
        columns = self.columns or [Column(f.name, f.dataType.simpleString()) for f in schema.fields]
        properties = config.properties()
        if self.primary_key:
            properties["primary_key"] = self.primary_key
        listed = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
        clustering = f"CLUSTER BY ({', '.join(self.cluster_by)}) " if self.cluster_by else ""
        if location is None:
            location = generations.new_location(spark, self.home or self.name)
            Storage(spark).make_folder(location)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({', '.join(c.ddl() for c in columns)}) "
            f"USING {config.table_format} {clustering}COMMENT {_quoted(self.comment)} TBLPROPERTIES ({listed}) "
            f"LOCATION {_quoted(location)}"
        )

    def location(self, spark: SparkSession) -> str:
        return generations.location(spark, self.name)

    def checkpoint(self, spark: SparkSession, config: PipelineConfig) -> str:
        """Where the stream that feeds this generation of the table keeps its progress."""
        found = generations.generation(spark, self.name)
        if found is None:
            raise ValueError(f"{self.name} was not made as a stream table: its rows have no generation")
        return f"{self._checkpoints(spark, config)}/{found}"

    def _checkpoints(self, spark: SparkSession, config: PipelineConfig) -> str:
        return f"{config.checkpoint_dir(spark)}/{self.home or self.name}"

    def drop(self, spark: SparkSession) -> None:
        """Forget the rows of all generations."""
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        if self.home is None:
            Storage(spark).delete(generations.table_folder(spark, self.name))

    def beside(self) -> StreamTable:
        """A table of another name for the next generation of this one's rows."""
        return replace(self, name=f"{self.name}__next", home=self.name)

    def take_over(self, built: StreamTable, spark: SparkSession, config: PipelineConfig) -> None:
        """Make the rows built beside this table its own, in one change, and forget the other name.

        Checkpoints of generations that are gone go too.
        """
        new = built.location(spark)
        if spark.catalog.tableExists(self.name):
            kept = {generations.generation(spark, self.name), new.rpartition("/")[2]}
            generations.point_to(spark, self.name, new)
            generations.remove_generations(spark, self._checkpoints(spark, config), kept)
        else:
            self.create(spark, spark.table(built.name).schema, config, new)
        spark.sql(f"DROP TABLE {built.name}")


def packed(files: DataFrame, config: PipelineConfig) -> DataFrame:
    """Fewer, larger output files for landed files that are small; no shuffle."""
    return files.coalesce(config.ingest_partitions) if config.ingest_partitions else files


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
