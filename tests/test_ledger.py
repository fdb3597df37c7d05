import os
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from samples import REPEATED, SINGLE
from segflow import DocumentPipeline, MessagePipeline, refresh
from segflow.sources.files import binary_files, text_files
from segflow.sources.ledger import LedgerIngest, list_files
from segflow.storage import Storage
from segflow.streaming.refresh import RefreshError


@pytest.fixture
def config(pipeline_config):
    return replace(pipeline_config, ledger=True)


def land(config, name, text, file_type="claims"):
    path = Path(config.landing_path(file_type).removeprefix("file://")) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return path


def names(spark, pipeline):
    return sorted(r[0] for r in spark.table(pipeline.bronze.name).select("file_metadata.file_name").collect())


def test_files_give_the_rows_of_the_stream(spark, config):
    for name in ("a.xml", "2026-01-01/b c%.xml", "2026-01-01/deep/é#1.xml", "2026-01-02/x.xml", "_hidden.xml", "2026-01-02/.x", "2026-01-02/empty.xml"):
        land(config, name, "" if "empty" in name else SINGLE)
    path = config.landing_path("claims")
    pipeline = MessagePipeline(spark, config, "claims")
    refresh(pipeline)
    wanted = text_files(spark, path, streaming=False).drop("ingest_time")
    found = spark.table(pipeline.bronze.name)
    assert found.columns == ["transaction_file_source_id", "file_metadata", "ingest_time", "value"]
    assert sorted(map(tuple, found.drop("ingest_time").collect())) == sorted(map(tuple, wanted.collect()))
    assert spark.table(pipeline.requests.name).count() == 4 * 44

    documents = DocumentPipeline(spark, config)
    refresh(documents)
    files = binary_files(spark, config.landing_path(), streaming=False)
    stored = spark.table(documents.documents.name)
    assert stored.columns == files.columns
    compared = ["spec_file_source_id", "file_metadata", "modificationTime", "length", "content"]
    assert sorted(map(tuple, stored.select(compared).collect())) == sorted(map(tuple, files.select(compared).collect()))


def test_each_file_is_read_once_whenever_it_lands(spark, config):
    pipeline = MessagePipeline(spark, config, "claims")
    refresh(pipeline)  # nothing has landed yet
    assert names(spark, pipeline) == []
    land(config, "2026-01-02/a.xml", SINGLE)
    refresh(pipeline)
    refresh(pipeline)
    late = land(config, "2026-01-01/late.xml", REPEATED)
    os.utime(late, (1_400_000_000, 1_400_000_000))
    land(config, "2026-01-02/a.xml", REPEATED)  # an overwritten path is not read again
    refresh(pipeline)
    refresh(pipeline)
    assert names(spark, pipeline) == ["a.xml", "late.xml"]
    assert spark.table(pipeline.variant.name).count() == 2
    refresh(pipeline, full=True)
    assert names(spark, pipeline) == ["a.xml", "late.xml"] and spark.table(pipeline.requests.name).count() == 2 * 44
    land(config, "b.xml", SINGLE)
    refresh(pipeline)
    assert names(spark, pipeline) == ["a.xml", "b.xml", "late.xml"]


def test_many_names_stay_off_the_driver(spark, config):
    for i in range(6_000):
        land(config, f"2026-{i % 12:02d}/{i}.xml", f"<a>{i}</a>")
    root = config.landing_path("claims")
    newest = list_files(spark, root, newest=2)
    assert {r[0] for r in newest.select("folder").distinct().collect()} == {"2026-10", "2026-11"} and newest.count() == 1_000
    pipeline = MessagePipeline(spark, config, "claims")
    ingest = LedgerIngest(
        spark, config, pipeline.bronze, root, content=F.col("content").cast("string"), id_column="transaction_file_source_id", files_per_batch=2_500
    )
    assert ingest.run() == 3 and ingest.run() == 0
    assert spark.table(pipeline.bronze.name).select("value").distinct().count() == 6_000
    assert ingest.ledger().select("path").distinct().count() == ingest.ledger().count() == 6_000
    land(config, "2026-00/late.xml", "<a/>")
    ingest.newest = 3  # closed folders are not looked into
    land(config, "2026-11/new.xml", "<a/>")
    assert ingest.run() == 1 and spark.table(pipeline.bronze.name).count() == 6_001
    ingest.newest = None
    assert ingest.run() == 1 and spark.table(pipeline.bronze.name).count() == 6_002


@pytest.mark.parametrize("at", range(4))
def test_a_crash_neither_loses_nor_repeats_a_file(spark, config, monkeypatch, at):
    for i in range(5):
        land(config, f"d{i % 2}/{i}.xml", SINGLE)
    pipeline = MessagePipeline(spark, config, "claims")
    calls = []

    def broken(self, *paths):
        calls.append(paths)
        if len(calls) > at:
            raise OSError("the driver is gone")
        return move(self, *paths)

    move = Storage.move
    with monkeypatch.context() as patched:
        patched.setattr(Storage, "move", broken)
        with pytest.raises(RefreshError):
            refresh(pipeline)
    land(config, "d0/5.xml", SINGLE)
    refresh(pipeline)
    refresh(pipeline)
    assert names(spark, pipeline) == [f"{i}.xml" for i in range(6)]


def test_ways_of_ingest_are_not_mixed(spark, config, pipeline_config):
    land(config, "a.xml", SINGLE)
    by_stream, by_ledger = MessagePipeline(spark, pipeline_config, "claims"), MessagePipeline(spark, config, "claims")
    refresh(by_stream)
    with pytest.raises(RefreshError, match="fed by a stream"):
        refresh(by_ledger)
    refresh(by_ledger, full=True)
    assert names(spark, by_ledger) == ["a.xml"]
    with pytest.raises(RefreshError, match="fed by a ledger"):
        refresh(by_stream)


def test_a_batch_reads_only_its_own_names(spark, config, monkeypatch):
    """Batches of many new files do not read the names of all others each: F2, F6."""
    for i in range(60):
        land(config, f"d{i % 3}/{i}.xml", f"<a>{i}</a>")
    pipeline = MessagePipeline(spark, config, "claims")
    read, take = [], LedgerIngest._take

    def noted(self, home, files, size):
        read.append((set(files.inputFiles()), {r["path"] for r in files.collect()}))
        take(self, home, files, size)

    monkeypatch.setattr(LedgerIngest, "_take", noted)
    ingest = LedgerIngest(
        spark, config, pipeline.bronze, config.landing_path("claims"), content=F.col("content").cast("string"), id_column="transaction_file_source_id", files_per_batch=10
    )
    assert ingest.run() == 6 and len(read) > 1
    inputs, paths = [r[0] for r in read], [r[1] for r in read]
    assert sum(map(len, inputs)) == len(set().union(*inputs)) and sum(map(len, paths)) == len(set().union(*paths)) == 60
    assert ingest.run() == 0 and spark.table(pipeline.bronze.name).select("value").distinct().count() == 60


def test_a_batch_that_fails_stops_the_next_and_is_taken_up(spark, config, monkeypatch):
    for i in range(40):
        land(config, f"{i}.xml", f"<a>{i}</a>")
    pipeline = MessagePipeline(spark, config, "claims")
    ingest = LedgerIngest(
        spark, config, pipeline.bronze, config.landing_path("claims"), content=F.col("content").cast("string"), id_column="transaction_file_source_id", files_per_batch=3
    )
    publish, calls = LedgerIngest._publish, []

    def broken(self, home, batch):
        calls.append(batch)
        if len(calls) == 2:
            raise OSError("the driver is gone")
        publish(self, home, batch)

    with monkeypatch.context() as patched:
        patched.setattr(LedgerIngest, "_publish", broken)
        with pytest.raises(OSError, match="the driver is gone"):
            ingest.run()
    assert len(calls) < 14
    ingest.run()
    assert ingest.run() == 0
    assert spark.table(pipeline.bronze.name).count() == spark.table(pipeline.bronze.name).select("value").distinct().count() == 40
