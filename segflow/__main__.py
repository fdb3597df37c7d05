"""Bring the tables of a deployment up to date: ``python -m segflow messages|documents [--full]``.

The names come from the Spark conf, see ``PipelineConfig.from_conf``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from segflow import DocumentPipeline, PipelineConfig, refresh
from segflow.plans.messages import message_pipelines


def run(spark: SparkSession, what: str, full: bool = False, **overrides) -> None:
    """Refresh all message tables, of every file type, or the document table."""
    config = PipelineConfig.from_conf(spark, **overrides)
    refresh(*(message_pipelines(spark, config) if what == "messages" else [DocumentPipeline(spark, config)]), full=full)


def main(arguments: list[str]) -> None:
    parser = argparse.ArgumentParser(prog="segflow", description=__doc__)
    parser.add_argument("what", choices=("messages", "documents"))
    parser.add_argument("--full", action="store_true", help="read every landed file again")
    parser.add_argument("--ledger", action="store_true", help="keep the files read in a ledger, not on the driver")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName(f"segflow {given.what}").getOrCreate()
    run(spark, given.what, given.full, ledger=given.ledger)


if __name__ == "__main__":
    main(sys.argv[1:])
