import pytest
from pyspark.sql import functions as F

from segflow.operators.clustering import files_between, read_clustered, replace_clustered
from segflow.streaming.generations import replace_rows


def rows(spark, n=20_000):
    path = F.concat(F.lit("/v/ä b%"), F.lpad((F.col("id") * 7919 % n).cast("string"), 6, "0"))
    kind = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") * 31 % 1_000)
    return spark.range(n).select("id", path.alias("path"), kind.alias("kind"), F.struct(path.alias("file_path")).alias("meta")).repartition(7)


def test_a_filter_on_the_path_reads_a_tenth_of_the_files(spark, pipeline_config):
    name = pipeline_config.table("by_path")
    replace_clustered(rows(spark), name, ("path",), 40)
    ranges = {"path": ("/v/ä b%001000", "/v/ä b%001999")}
    files = files_between(spark, name, ranges)
    assert 0 < len(files) <= 4
    found = read_clustered(spark, name, **ranges)
    assert found.count() == 1_000 and len(found.inputFiles()) == len(files)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, spark.table(name).filter("path BETWEEN '/v/ä b%001000' AND '/v/ä b%001999'").collect()))
    assert read_clustered(spark, name, path=("zzz", None)).count() == 0
    assert read_clustered(spark, name, path=(None, None)).count() == spark.table(name).count() == 20_000


def test_several_columns_are_all_narrow(spark, pipeline_config):
    name = pipeline_config.table("by_two")
    replace_clustered(rows(spark), name, ("meta.file_path", "kind"), 64)
    for ranges in ({"meta.file_path": ("/v/ä b%000000", "/v/ä b%000999")}, {"kind": (100, 120)}):
        assert 0 < len(files_between(spark, name, ranges)) <= 24
    found = read_clustered(spark, name, meta__file_path=("/v/ä b%000000", "/v/ä b%009999"), kind=(100, 120))
    wanted = rows(spark).filter("meta.file_path <= '/v/ä b%009999' AND kind BETWEEN 100 AND 120")
    assert found.count() == wanted.count() > 0


def test_nulls_other_tables_and_replacement(spark, pipeline_config):
    name, plain = pipeline_config.table("nulls"), pipeline_config.table("plain")
    some = rows(spark, 500).withColumn("kind", F.when(F.col("id") % 2 == 0, F.col("kind")))
    for columns in (("kind",), ("kind", "path")):
        replace_clustered(some, name, columns, 8)
        assert spark.table(name).count() == 500
        assert read_clustered(spark, name, kind=(0, 10_000)).count() == 250
    replace_clustered(some.filter("id < 0"), name, ("kind", "path"), 8)
    assert read_clustered(spark, name, kind=(0, 1)).count() == 0
    replace_rows(some, plain)
    assert files_between(spark, plain, {"kind": (0, 1)}) is None
    assert read_clustered(spark, plain, kind=(None, 10_000)).count() == 250
