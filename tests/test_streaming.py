import os
import threading
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import plan_of
from samples import FILLED, REPEATED, SINGLE
from segflow import DocumentPipeline, MessagePipeline, refresh
from segflow.operators.messages import MALFORMED, PARSED, by_outcome, malformed, to_variant
from segflow.operators.sections import requests, responses, supplemental
from segflow.operators.quality import repeated_keys
from segflow.plans.document_text import replace_table
from segflow.plans.messages import message_pipelines
from segflow.plans.workload import line_parser
from segflow.sources.tables import stream_table, stream_table_sql
from segflow.storage import Storage
from segflow.streaming import generations
from segflow.streaming.outcomes import OutcomeStream, Sink
from segflow.streaming.refresh import RefreshError
from segflow.streaming.tables import StreamTable


def drop_in(config, name, text, file_type="claims"):
    folder = Path(config.landing_path(file_type).removeprefix("file://"))
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def counts(spark, pipeline):
    return tuple(
        spark.table(t.name).count()
        for t in (pipeline.bronze, pipeline.variant, pipeline.requests, pipeline.responses, pipeline.supplemental)
    )


def test_incremental_then_full_refresh(spark, pipeline_config):
    drop_in(pipeline_config, "single.xml", SINGLE)
    pipeline = MessagePipeline(spark, pipeline_config, "claims")
    refresh(pipeline)
    assert counts(spark, pipeline) == (1, 1, 44, 29, 7)
    refresh(pipeline)
    assert counts(spark, pipeline) == (1, 1, 44, 29, 7)

    drop_in(pipeline_config, "repeated.xml", REPEATED)
    drop_in(pipeline_config, "bad.xml", "<ClaimBilling>")
    drop_in(pipeline_config, "single.xml", FILLED)  # an overwritten path is not read again
    refresh(MessagePipeline(spark, pipeline_config, "claims"))
    assert counts(spark, pipeline) == (3, 3, 44 + 44 + 1, 29 + 34 + 1, 7 + 7 + 1)
    bad = malformed(spark.table(pipeline.bronze.name))
    assert [r[0] for r in bad.select("file_metadata.file_name").collect()] == ["bad.xml"]

    refresh(pipeline, full=True)
    assert counts(spark, pipeline) == (3, 3, 80 + 44 + 1, 38 + 34 + 1, 7 + 7 + 1)


def test_stream_equals_batch(spark, pipeline_config):
    for name, text in (("a.xml", SINGLE), ("b.xml", REPEATED), ("c.xml", FILLED), ("d.xml", " ")):
        drop_in(pipeline_config, name, text)
    pipeline = MessagePipeline(spark, pipeline_config, "claims", maxFilesPerTrigger="2")
    refresh(pipeline)
    assert counts(spark, pipeline)[:2] == (4, 4)
    variants = to_variant(spark.table(pipeline.bronze.name))
    for flatten, stored in (
        (requests, pipeline.requests),
        (responses, pipeline.responses),
        (supplemental, pipeline.supplemental),
    ):
        batch, stream = flatten(variants), spark.table(stored.name)
        assert batch.columns == stream.columns
        as_rows = [
            sorted(map(repr, df.withColumns({c: F.to_json(c) for c in ("messages", "value")}).collect()))
            for df in (batch, stream)
        ]
        assert as_rows[0] == as_rows[1]


def test_a_backlog_is_taken_in_bounded_batches(spark, pipeline_config):
    for i in range(5):
        drop_in(pipeline_config, f"{i}.xml", SINGLE)
    pipeline = MessagePipeline(spark, pipeline_config, "claims", maxFilesPerTrigger=2)

    def sizes(query):
        query.awaitTermination()
        return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]

    assert sizes(pipeline.stream_ingest()) == [2, 2, 1]
    one_file = stream_table(spark, pipeline.bronze.name, maxFilesPerTrigger=1)
    copy = StreamTable(pipeline_config.table("copy"))
    assert len(sizes(copy.append(one_file, pipeline_config))) >= 3
    assert spark.table(copy.name).count() == 5


def test_a_file_that_lands_late_with_an_old_time_is_read(spark, pipeline_config):
    drop_in(pipeline_config, "new.xml", SINGLE)
    pipeline = MessagePipeline(spark, pipeline_config, "claims")
    refresh(pipeline)
    drop_in(pipeline_config, "old.xml", SINGLE)
    folder = Path(pipeline_config.landing_path("claims").removeprefix("file://"))
    os.utime(folder / "old.xml", (1_500_000_000, 1_500_000_000))
    refresh(pipeline)
    drop_in(pipeline_config, "older.xml", SINGLE)
    os.utime(folder / "older.xml", (1_400_000_000, 1_400_000_000))
    refresh(pipeline)
    assert counts(spark, pipeline) == (3, 3, 132, 87, 21)


def test_bronze_table_is_declared(spark, pipeline_config):
    drop_in(pipeline_config, "a.xml", SINGLE)
    pipeline = MessagePipeline(spark, pipeline_config, "claims")
    refresh(pipeline)
    table = spark.table(pipeline.bronze.name)
    assert table.columns == ["transaction_file_source_id", "file_metadata", "ingest_time", "value"]
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {pipeline.bronze.name}").collect()}
    assert properties["quality"] == "bronze" and properties["primary_key"] == "transaction_file_source_id"
    described = spark.sql(f"DESCRIBE EXTENDED {pipeline.bronze.name}").collect()
    text = "\n".join(f"{r[0]} {r[1]} {r[2]}" for r in described)
    assert "Hash of the file metadata" in text and "file_metadata.file_path" in text and "current_timestamp()" in text
    assert table.filter("ingest_time IS NULL").count() == 0


def test_file_types_are_independent(spark, pipeline_config):
    from dataclasses import replace

    config = replace(pipeline_config, file_types=("A", "B"), ingest_partitions=1)
    for i in range(3):
        drop_in(config, f"{i}.xml", SINGLE, f"A/sub{i}")
    drop_in(config, "0.xml", REPEATED, "B")
    pipelines = message_pipelines(spark, config, keep_messages=False)
    refresh(*pipelines)
    assert [counts(spark, p) for p in pipelines] == [(3, 3, 132, 87, 21), (1, 1, 44, 34, 7)]
    assert "messages" not in spark.table(pipelines[0].requests.name).columns
    stored = Path(pipelines[0].bronze.location(spark).removeprefix("file:"))
    assert len([f for f in os.listdir(stored) if f.endswith(".parquet")]) == 1


def test_documents_stream_and_parsed_view(spark, pipeline_config):
    for name, text in (("doc11.PDF", "a\nb"), ("doc10.docx", "c"), ("doc12.docx", "d"), ("doc13.txt", "e")):
        drop_in(pipeline_config, name, text, None)
    pipeline = DocumentPipeline(spark, pipeline_config)
    refresh(pipeline)
    stored = spark.table(pipeline.documents.name)
    assert stored.columns == [
        "spec_file_source_id", "file_metadata", "ingest_time", "path", "modificationTime", "length", "content"
    ]
    assert stored.count() == 4
    view = pipeline.parse_documents(line_parser)
    assert spark.table(view).isStreaming and spark.table(view).columns == ["spec_file_source_id", "path", "parsed"]
    parsed = StreamTable(pipeline_config.table("parsed"))
    for _ in range(2):
        parsed.append(stream_table_sql(spark, view), pipeline_config).awaitTermination()
    rows = spark.table(parsed.name).select(
        F.substring_index("path", "/", -1), F.expr("try_variant_get(parsed, '$.error_status', 'string')")
    )
    assert sorted(map(tuple, rows.collect()), key=lambda r: r[0]) == [
        ("doc10.docx", "unreadable"), ("doc11.PDF", None), ("doc12.docx", None)
    ]


def test_a_failed_batch_is_read_again_once(spark, pipeline_config):
    for name, text in (("doc11.PDF", "a"), ("doc12.docx", "b")):
        drop_in(pipeline_config, name, text, None)
    pipeline = DocumentPipeline(spark, pipeline_config)
    refresh(pipeline)
    parsed = StreamTable(pipeline_config.table("parsed"))

    def broken(path, content, options):
        return F.when(path.endswith("docx"), F.parse_json(F.raise_error("no luck").cast("string"))).otherwise(
            line_parser(path, content, options)
        )

    def run(parser):
        view = pipeline.parse_documents(parser)
        parsed.append(stream_table_sql(spark, view), pipeline_config).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run(broken)
    assert spark.table(parsed.name).count() == 0
    run(line_parser)
    run(line_parser)
    assert spark.table(parsed.name).count() == 2


def test_a_failing_stream_lets_the_others_of_its_stage_finish(spark, pipeline_config):
    drop_in(pipeline_config, "a.xml", SINGLE)
    good = MessagePipeline(spark, pipeline_config, "claims")

    class Failing(MessagePipeline):
        def stream_ingest(self):
            files = stream_table(spark, good.bronze.name)
            return self.bronze.append(files.withColumn("value", F.raise_error("no luck").cast("string")), self.config)

    refresh(good)
    drop_in(pipeline_config, "b.xml", SINGLE)
    bad = Failing(spark, pipeline_config, "bad")

    class Unstarted(MessagePipeline):
        def stream_ingest(self):
            raise OSError("no folder")

    with pytest.raises(RefreshError) as raised:
        refresh(Unstarted(spark, pipeline_config, "none"), bad, good, at_once=1)
    assert len(raised.value.failures) == 2 and "no folder" in str(raised.value) and "no luck" in str(raised.value)
    assert spark.table(good.bronze.name).count() == 2 and not spark.streams.active
    refresh(good)
    assert counts(spark, good)[:3] == (2, 2, 88)


def test_malformed_texts_are_set_aside(spark, pipeline_config):
    drop_in(pipeline_config, "a.xml", SINGLE)
    drop_in(pipeline_config, "b.xml", SINGLE[:-3])
    pipeline = MessagePipeline(spark, pipeline_config, "claims")
    refresh(pipeline)
    refresh(pipeline)
    assert [r["value"] for r in spark.table(pipeline.malformed.name).collect()] == [SINGLE[:-3]]
    assert spark.table(pipeline.bronze.name).count() == 2


def test_a_table_of_other_origin_is_refused(spark, pipeline_config):
    pipeline = MessagePipeline(spark, pipeline_config, "claims")
    drop_in(pipeline_config, "a.xml", SINGLE)
    spark.sql(f"CREATE TABLE {pipeline.bronze.name} (value STRING) USING parquet")
    with pytest.raises(RefreshError, match="not made as a stream table"):
        refresh(pipeline)


def test_one_pass_feeds_the_parsed_and_the_malformed(spark, pipeline_config):
    for i in range(6):
        drop_in(pipeline_config, f"{i}.xml", SINGLE if i % 3 else SINGLE[:-3])
    pipeline = MessagePipeline(spark, pipeline_config, "claims", maxFilesPerTrigger=2)
    pipeline.stream_ingest().awaitTermination()
    query = pipeline.variant_transform()
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 6  # bronze is read once
    rows = spark.table(pipeline.variant.name)
    assert rows.columns == ["transaction_file_source_id", "file_metadata", "ingest_time", "messages"]
    assert (rows.count(), rows.filter("messages IS NULL").count()) == (6, 2)
    assert [r["value"] for r in spark.table(pipeline.malformed.name).collect()] == [SINGLE[:-3]] * 2
    assert spark.table(pipeline.failed.name).count() == 0
    plan = plan_of(by_outcome(spark.table(pipeline.bronze.name)))
    assert plan.count("from_xml") == plan_of(to_variant(spark.table(pipeline.bronze.name))).count("from_xml")


class Poisoned(MessagePipeline):
    """A parse that fails for texts with a mark."""

    def parse(self, texts):
        poison = F.when(F.col("value").contains("POISON"), F.raise_error("too much for the parser").cast("string"))
        return super().parse(texts.withColumn("value", F.coalesce(poison, F.col("value"))))


def test_texts_that_make_the_parse_fail_are_set_aside(spark, pipeline_config):
    for i in range(40):
        drop_in(pipeline_config, f"{i}.xml", SINGLE.replace("<Vendor>", "<Vendor>POISON ") if i in (7, 23) else SINGLE)
    drop_in(pipeline_config, "bad.xml", SINGLE[:-3])
    pipeline = Poisoned(spark, pipeline_config, "claims", keep_messages=False)
    refresh(pipeline)
    refresh(pipeline)
    failed = spark.table(pipeline.failed.name)
    assert sorted(r[0] for r in failed.select("file_metadata.file_name").collect()) == ["23.xml", "7.xml"]
    assert all("too much for the parser" in r["error"] and "POISON" in r["value"] for r in failed.collect())
    assert counts(spark, pipeline)[:3] == (41, 39, 38 * 44 + 1)
    assert spark.table(pipeline.malformed.name).count() == 1
    drop_in(pipeline_config, "later.xml", SINGLE)
    refresh(pipeline)
    assert counts(spark, pipeline)[:2] == (42, 40) and spark.table(pipeline.failed.name).count() == 2


def test_slices_of_rows_that_fail_together_are_written_side_by_side(spark, pipeline_config, monkeypatch):
    """One after the other, each waits for the slowest task of the slice before: F3."""
    for i in range(40):
        drop_in(pipeline_config, f"{i}.xml", SINGLE.replace("<Vendor>", "<Vendor>POISON ") if i == 7 else SINGLE)
    at_work, most, lock, write = [0], [0], threading.Lock(), OutcomeStream._write_part

    def noted(self, rows, path):
        with lock:
            at_work[0] += 1
            most[0] = max(most[0], at_work[0])
        try:
            return write(self, rows, path)
        finally:
            with lock:
                at_work[0] -= 1

    monkeypatch.setattr(OutcomeStream, "_write_part", noted)
    pipeline = Poisoned(spark, pipeline_config, "claims", keep_messages=False)
    refresh(pipeline)
    assert most[0] > 1
    assert counts(spark, pipeline)[:2] == (40, 39) and spark.table(pipeline.failed.name).count() == 1


def test_a_parser_that_fails_for_many_texts_fails_the_batch(spark, pipeline_config):
    for i in range(6):
        drop_in(pipeline_config, f"{i}.xml", SINGLE.replace("<Vendor>", "<Vendor>POISON "))
    pipeline = MessagePipeline(spark, pipeline_config, "claims")
    pipeline.stream_ingest().awaitTermination()
    kept = ("transaction_file_source_id", "value")
    stream = OutcomeStream(
        Poisoned(spark, pipeline_config, "claims").parse,
        {PARSED: Sink(pipeline.variant, (kept[0], "messages")), MALFORMED: Sink(pipeline.malformed, kept)},
        pipeline_config,
        failed=Sink(pipeline.failed, (*kept, "error")),
        key=kept[:1],
        failures_at_most=3,
    )
    with pytest.raises(StreamingQueryException, match="too much for the parser"):
        stream.append(stream_table(spark, pipeline.bronze.name)).awaitTermination()
    assert [spark.table(t.name).count() for t in (pipeline.variant, pipeline.malformed, pipeline.failed)] == [0, 0, 0]


@pytest.mark.parametrize("stop", ["before the mark", "while files are moved"])
def test_a_batch_that_is_cut_short_reaches_its_tables_once(spark, pipeline_config, monkeypatch, stop):
    for i in range(9):
        drop_in(pipeline_config, f"{i}.xml", SINGLE if i % 3 else SINGLE[:-3])
    pipeline = MessagePipeline(spark, pipeline_config, "claims")
    pipeline.stream_ingest().awaitTermination()
    done = []

    def broken(self, *paths):
        if stop == "before the mark" or done:
            raise OSError("the driver is gone")
        done.append(paths)
        return move(self, *paths)

    move = Storage.move
    with monkeypatch.context() as patched:
        patched.setattr(Storage, "touch" if stop == "before the mark" else "move", broken)
        with pytest.raises(StreamingQueryException):
            pipeline.variant_transform().awaitTermination()
    pipeline.variant_transform().awaitTermination()
    pipeline.variant_transform().awaitTermination()
    found = spark.table(pipeline.variant.name).groupBy("transaction_file_source_id").count().collect()
    assert len(found) == 9 and {r["count"] for r in found} == {1} and spark.table(pipeline.malformed.name).count() == 3


def read_while(work, read):
    """What `read` returned, again and again, while `work` ran; no reading may fail."""
    seen, over = [], threading.Event()

    def loop():
        while not over.is_set():
            seen.append(read())

    with ThreadPoolExecutor(1) as pool:
        reading = pool.submit(loop)
        try:
            work()
        finally:
            over.set()
        reading.result()
    return seen


def test_a_table_can_be_read_while_it_is_replaced(spark, pipeline_config):
    name = pipeline_config.table("texts")

    def rows(version, n):
        return spark.range(n).select(F.lit(version).alias("version"), "id").repartition(3)

    replace_table(rows(0, 100), name)

    def replace_often():
        for version in range(1, 9):
            replace_table(rows(version, 100 + version), name)

    def read():
        return tuple(spark.table(name).agg(F.min("version"), F.max("version"), F.count("*")).first())

    seen = read_while(replace_often, read)
    assert all(low == high and n == 100 + low for low, high, n in seen) and read() == (8, 8, 108)
    folder = Path(generations.table_folder(spark, name).removeprefix("file:"))
    assert len([f for f in os.listdir(folder) if f.startswith("g-")]) == 2
    # From the table itself, with one column more and one less.
    replace_table(spark.table(name).select("id", F.lit("x").alias("note")), name)
    assert spark.table(name).columns == ["version", "id", "note"]
    assert spark.table(name).filter("version IS NULL AND note = 'x'").count() == 108
    with pytest.raises(ValueError, match="type"):
        replace_table(spark.range(1).select(F.lit("a").alias("id")), name)
    with pytest.raises(Exception, match="no luck"):
        replace_table(spark.table(name).withColumn("note", F.raise_error("no luck").cast("string")), name)
    assert spark.table(name).count() == 108


def test_tables_can_be_read_during_a_full_refresh(spark, pipeline_config):
    for i in range(5):
        drop_in(pipeline_config, f"{i}.xml", SINGLE)
    pipeline = MessagePipeline(spark, pipeline_config, "claims", keep_messages=False)
    refresh(pipeline)
    drop_in(pipeline_config, "5.xml", SINGLE)

    def work():
        refresh(pipeline, full=True)
        refresh(pipeline, full=True)

    seen = read_while(work, lambda: counts(spark, pipeline))
    assert {n for n, *_ in seen} <= {5, 6} and {r[2] for r in seen} <= {5 * 44, 6 * 44}
    assert counts(spark, pipeline) == (6, 6, 264, 174, 42)
    assert not [t.name for t in spark.catalog.listTables(pipeline_config.schema) if t.name.endswith("__next")]
    drop_in(pipeline_config, "6.xml", SINGLE)
    refresh(pipeline)
    assert counts(spark, pipeline)[0] == 7 and counts(spark, pipeline)[2] == 7 * 44


def test_a_full_refresh_that_fails_leaves_the_tables_as_they_are(spark, pipeline_config):
    drop_in(pipeline_config, "a.xml", SINGLE)
    pipeline = MessagePipeline(spark, pipeline_config, "claims", keep_messages=False)
    refresh(pipeline)

    class Failing(MessagePipeline):
        def extract_requests(self):
            raise OSError("no luck")

    with pytest.raises(RefreshError):
        refresh(Failing(spark, pipeline_config, "claims", keep_messages=False), full=True)
    assert counts(spark, pipeline) == (1, 1, 44, 29, 7)
    drop_in(pipeline_config, "b.xml", SINGLE)
    refresh(pipeline)
    assert counts(spark, pipeline) == (2, 2, 88, 58, 14)
    refresh(pipeline, full=True)
    assert counts(spark, pipeline) == (2, 2, 88, 58, 14)


def test_keys_are_checked_as_rows_arrive(spark, pipeline_config):
    for i in range(4):
        drop_in(pipeline_config, f"{i}.xml", SINGLE)
    pipeline = MessagePipeline(spark, pipeline_config, "claims", check=True, keep_messages=False)
    refresh(pipeline)
    repeated = spark.table(pipeline.repeated.name)
    assert repeated.columns == ["transaction_file_source_id", "n_rows"] and repeated.count() == 0
    # Rows of known and of new keys that come into the table by another way.
    known = spark.table(pipeline.bronze.name).limit(1)
    other = StreamTable(pipeline_config.table("other"))
    copies = known.unionAll(known.withColumn("transaction_file_source_id", F.lit("new"))).unionAll(known)
    other.create(spark, copies.schema, pipeline_config)
    folder = other.location(spark)
    found = []
    for rows in (known, copies, copies.withColumn("ingest_time", F.lit(None).cast("timestamp")).limit(1)):
        rows.write.mode("append").parquet(folder)
        again = repeated_keys(stream_table(spark, other.name), "transaction_file_source_id", required=("ingest_time",))
        sink = Sink(StreamTable(pipeline_config.table("again")), ("transaction_file_source_id", "n_rows"))
        report = OutcomeStream(lambda r: r.withColumn("_outcome", F.lit("again")), {"again": sink}, pipeline_config)
        query = report.append(again, "update")
        query.awaitTermination()
        done = [p for p in query.recentProgress if p["numInputRows"]]
        checks = [p["observedMetrics"]["checks"] for p in done]
        found.append((sum(p["numInputRows"] for p in done), [(c["rows"], c["ingest_time_nulls"]) for c in checks]))
    assert found == [(1, [(1, 0)]), (3, [(3, 0)]), (1, [(1, 1)])]
    told = spark.table(pipeline_config.table("again")).orderBy("n_rows").collect()
    assert [r["n_rows"] for r in told] == [3, 4] and len({r[0] for r in told}) == 1
    refresh(pipeline, full=True)
    assert spark.table(pipeline.repeated.name).count() == 0


def test_a_message_too_large_for_a_variant_is_set_aside(spark, pipeline_config):
    for i in range(30):
        drop_in(pipeline_config, f"{i}.xml", SINGLE)
    drop_in(pipeline_config, "large.xml", f"<ClaimBilling><Supplemental>{'<v>' + 'x' * 1_000_000 + '</v>'}{('<v>' + 'y' * 2_000_000 + '</v>') * 70}</Supplemental></ClaimBilling>")
    pipeline = MessagePipeline(spark, pipeline_config, "claims", keep_messages=False)
    refresh(pipeline)
    assert counts(spark, pipeline)[:3] == (31, 30, 30 * 44)
    failed = spark.table(pipeline.failed.name).select("file_metadata.file_name", F.length("value").alias("chars"), "error").collect()
    assert [(r["file_name"], r["chars"] > 140_000_000) for r in failed] == [("large.xml", True)] and "VARIANT" in failed[0]["error"].upper()
