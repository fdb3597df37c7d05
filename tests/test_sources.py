import pytest
import os

from pyspark.sql import functions as F

from segflow import PipelineConfig
from segflow.config import split_file_types
from segflow.functions.ids import file_source_id
from segflow.operators.quality import duplicate_keys, null_counts
from segflow.scratch import new_scratch_dir, scratch_root
from segflow.sources.files import binary_files, text_files
from segflow.sources.landing import land_files


def test_text_files_are_whole_rows_with_metadata(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<M>\n<x>é</x>\n</M>\n", encoding="utf-8")
    rows = text_files(spark, tmp_path.as_uri(), streaming=False)
    assert rows.columns == ["transaction_file_source_id", "file_metadata", "ingest_time", "value"]
    row = rows.first()
    assert row["value"] == "<M>\n<x>é</x>\n</M>\n"
    meta = row["file_metadata"].asDict()
    assert meta["file_name"] == "a.xml" and meta["file_size"] == os.path.getsize(tmp_path / "a.xml")
    assert list(meta) == [
        "file_path", "file_name", "file_size", "file_block_start", "file_block_length", "file_modification_time"
    ]


def test_nested_empty_and_hidden_files(spark, tmp_path):
    (tmp_path / "2026" / "day=1").mkdir(parents=True)
    (tmp_path / "2026" / "day=1" / "deep.xml").write_text("<M/>")
    (tmp_path / "empty.xml").write_text("")
    (tmp_path / "_partial.xml").write_text("x")
    (tmp_path / ".hidden.xml").write_text("x")
    for read in (text_files, binary_files):
        rows = read(spark, tmp_path.as_uri(), streaming=False).select("file_metadata.file_name", "file_metadata.file_size")
        assert sorted(map(tuple, rows.collect())) == [("deep.xml", 4)]  # nothing to scan in an empty file


def test_binary_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"\x00\xff")
    row = binary_files(spark, tmp_path.as_uri(), streaming=False).first()
    assert bytes(row["content"]) == b"\x00\xff" and row["length"] == 2
    assert row["path"].endswith("/a.pdf") and len(row["spec_file_source_id"]) == 64


def test_id_is_the_hash_of_all_metadata_in_utc_and_ignores_the_session_zone(spark, tmp_path):
    for i in range(3):
        path = tmp_path / f"{i}.xml"
        path.write_text("x")
        os.utime(path, ns=(0, 1_700_000_000_000_000_000 + i * 1_230_000_000))
    files = spark.read.text(tmp_path.as_uri())
    plain = F.expr("sha2(concat(_metadata.*), 256)")
    same = files.select((file_source_id(F.col("_metadata")) == plain).alias("same"))
    assert [r[0] for r in same.collect()] == [True] * 3
    ids = files.select(file_source_id(F.col("_metadata")))
    utc = sorted(r[0] for r in ids.collect())
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert sorted(r[0] for r in ids.collect()) == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_landed_files_hold_the_rows(spark, tmp_path):
    rows = spark.range(20).select(F.concat(F.lit("t"), F.col("id") % 2, F.lit("/f"), "id").alias("n"), F.col("id").cast("string").alias("v"))
    for _ in range(2):
        assert land_files(rows, tmp_path.as_uri(), F.col("n"), F.col("v")) == 20
    found = {p.relative_to(tmp_path).as_posix(): p.read_text() for p in tmp_path.rglob("*") if p.is_file()}
    assert found == {f"t{i % 2}/f{i}": str(i) for i in range(20)}
    assert land_files(rows.filter("n = ''"), tmp_path.as_uri(), F.col("n"), F.col("v")) == 0


def test_landing_path():
    base = PipelineConfig("c", "s", "v", volumes_root="/Volumes")
    assert base.landing_path("T") == "/Volumes/c/s/v/T"
    assert base.landing_path() == "/Volumes/c/s/v"
    for sub, expected in ((None, "/Volumes/c/s/v/T"), ("", "/Volumes/c/s/v/T"), ("in", "/Volumes/c/s/v/in/T")):
        assert PipelineConfig("c", "s", "v", volume_sub_path=sub).landing_path("T") == expected
    assert PipelineConfig("c", "s", "v", volume_sub_path="in", image_sub_path="img").image_output_path() == "/Volumes/c/s/v/img"
    for landing, images in ((None, "img"), ("in", "in"), ("in", "in/img")):
        with pytest.raises(ValueError, match="landing folder"):
            PipelineConfig("c", "s", "v", volume_sub_path=landing, image_sub_path=images).image_output_path()
    assert base.table("x") == "c.s.x"
    assert base.properties()["quality"] == "bronze"


def test_config_from_spark_conf(spark):
    keys = {"catalog_use": "c", "schema_use": "s", "volume_use": "v", "volume_sub_path_use": "", "file_types": " A, B ,C"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        config = PipelineConfig.from_conf(spark, table_format="orc")
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert config.file_types == ("A", "B", "C") and config.table_format == "orc" and config.catalog == "c"
    assert config.landing_path("A") == "/Volumes/c/s/v/A"
    assert split_file_types("") == ()


def test_scratch_lies_in_the_shared_folder_and_is_new_each_time(spark):
    path = new_scratch_dir(spark, "x")
    assert path.startswith("file:") and scratch_root(spark) in path
    assert new_scratch_dir(spark, "x") != path


def test_constraint_checks(spark):
    rows = spark.createDataFrame([("a", 1), ("a", None), ("b", 2), (None, 3)], "id string, n int")
    assert null_counts(rows, "id", "n").first().asDict() == {"id_nulls": 1, "n_nulls": 1}
    assert [tuple(r) for r in duplicate_keys(rows, "id").collect()] == [("a", 2)]


def test_a_deployment_is_run_from_its_conf(spark, pipeline_config):
    from pathlib import Path

    from samples import SINGLE
    from segflow.__main__ import run

    folder = Path(pipeline_config.landing_path("claims").removeprefix("file://"))
    folder.mkdir(parents=True)
    (folder / "a.xml").write_text(SINGLE)
    conf = {"catalog_use": pipeline_config.catalog, "schema_use": pipeline_config.schema, "volume_use": "landing", "file_types": "claims"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        places = {"volumes_root": pipeline_config.volumes_root, "checkpoint_root": pipeline_config.checkpoint_root}
        run(spark, "messages", **places)
        run(spark, "documents", full=True, **places)
    finally:
        for key in conf:
            spark.conf.unset(key)
    assert spark.table(pipeline_config.table("claims_bronze_requests")).count() == 44
    assert spark.table(pipeline_config.table("specification_documents")).count() == 1


def test_a_landing_that_fails_leaves_no_hidden_files(spark, tmp_path):
    """Files are made in a folder of their task, not all in the one they land in, and that folder goes with the task: F3 to F13."""
    (tmp_path / "t" / "taken").mkdir(parents=True)
    rows = spark.createDataFrame([("t/taken", "a")], "n string, v string")
    with pytest.raises(Exception, match="taken"):
        land_files(rows, tmp_path.as_uri(), F.col("n"), F.col("v"))
    assert [p.relative_to(tmp_path).as_posix() for p in sorted(tmp_path.rglob("*"))] == ["t", "t/taken"]
