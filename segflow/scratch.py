"""Working folders on storage that every executor of the session can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from segflow.storage import Storage


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the session names; where it names none, a local folder, in local mode only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    return tempfile.gettempdir()


def _session_root(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/segflow-{spark.sparkContext.applicationId}"


def new_scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, fully qualified directory name below the session's folder; nothing is created yet."""
    return qualified(spark, f"{_session_root(spark)}/{label}-{uuid.uuid4().hex}")


def remove_scratch(spark: SparkSession) -> None:
    """Delete all working folders of this session; tables stored in them can no longer be read."""
    Storage(spark).delete(_session_root(spark))


def qualified(spark: SparkSession, path: str) -> str:
    """Path with the scheme of the cluster's default file system filled in."""
    return Storage(spark).qualified(path)
