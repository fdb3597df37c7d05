import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "16")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="segflow-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def pipeline_config(spark, tmp_path):
    """A config with its own schema, landing area and checkpoints."""
    from segflow import PipelineConfig

    schema = "t_" + "".join(c for c in tmp_path.name if c.isalnum()) + f"_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{tmp_path.as_uri()}/tables'")
    return PipelineConfig(
        "spark_catalog",
        schema,
        "landing",
        ("claims",),
        volumes_root=tmp_path.as_uri(),
        checkpoint_root=f"{tmp_path.as_uri()}/checkpoints",
    )


def plan_of(df) -> str:
    """Physical plan of a DataFrame."""
    return df._jdf.queryExecution().executedPlan().toString()
