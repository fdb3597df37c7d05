"""Where files land and what the tables built from them are called."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

# Spark conf keys a deployment sets for a pipeline.
CATALOG_KEY = "catalog_use"
SCHEMA_KEY = "schema_use"
VOLUME_KEY = "volume_use"
SUB_PATH_KEY = "volume_sub_path_use"
IMAGE_SUB_PATH_KEY = "volume_parsed_image_output_sub_path_use"
FILE_TYPES_KEY = "file_types"


@dataclass(frozen=True)
class PipelineConfig:
    """Names and paths shared by every dataset of one pipeline.

    ``volumes_root`` is the directory above ``catalog/schema/volume``;
    ``checkpoint_root`` must be on storage every executor reaches and defaults
    to the folder named by ``spark.checkpoint.dir``. ``ingest_partitions`` packs
    the many small files of an ingest batch into that many output files.

    ``ledger`` makes ingest keep the files it has read as rows of a ledger, not
    as a list on the driver; with ``newest_folders`` it then only looks into the
    so many folders below the landing path whose names come last.
    """

    catalog: str
    schema: str
    volume: str
    file_types: tuple[str, ...] = ()
    volume_sub_path: str | None = None
    image_sub_path: str | None = None
    volumes_root: str = "/Volumes"
    checkpoint_root: str | None = None
    table_format: str = "parquet"
    ingest_partitions: int | None = None
    ledger: bool = False
    newest_folders: int | None = None
    table_properties: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_conf(cls, spark: SparkSession, **overrides) -> PipelineConfig:
        """Read the pipeline keys from the Spark conf; overrides win."""
        conf = spark.conf
        return replace(
            cls(
                catalog=conf.get(CATALOG_KEY),
                schema=conf.get(SCHEMA_KEY),
                volume=conf.get(VOLUME_KEY),
                file_types=split_file_types(conf.get(FILE_TYPES_KEY, "")),
                volume_sub_path=conf.get(SUB_PATH_KEY, None),
                image_sub_path=conf.get(IMAGE_SUB_PATH_KEY, None),
            ),
            **overrides,
        )

    def _under_volume(self, *parts: str | None) -> str:
        # An empty sub-path means the same as none: no "//" in the path.
        levels = (self.volumes_root.rstrip("/"), self.catalog, self.schema, self.volume, *parts)
        return "/".join(level for level in levels if level)

    def landing_path(self, file_type: str | None = None) -> str:
        return self._under_volume(self.volume_sub_path, file_type)

    def image_output_path(self) -> str:
        """Where parsers put page images; refused at or below the landing path, where they would be ingested."""
        path, landing = self._under_volume(self.image_sub_path), self.landing_path()
        if self.image_sub_path and f"{path}/".startswith(f"{landing}/"):
            raise ValueError(f"image output {path} lies in the landing folder {landing}: set volume_sub_path apart from it")
        return path

    def table(self, name: str) -> str:
        return f"{self.catalog}.{self.schema}.{name}"

    def checkpoint_dir(self, spark: SparkSession) -> str:
        root = self.checkpoint_root or spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise ValueError("set checkpoint_root or spark.checkpoint.dir to a folder all executors share")
        return f"{root.rstrip('/')}/segflow/{self.catalog}.{self.schema}"

    def properties(self) -> dict[str, str]:
        return {**self.table_properties, "quality": "bronze"}


def split_file_types(listed: str) -> tuple[str, ...]:
    return tuple(name.strip() for name in listed.split(",") if name.strip())
