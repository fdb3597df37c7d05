from collections import Counter

import pytest
from pyspark.sql import functions as F

from segflow.functions.variants import member_text
from segflow.operators.distribution import distribute_by_path, distribute_by_weight
from segflow.operators.documents import parse_files
from segflow.operators.path_texts import rows_by_reference, text_chunks
from segflow.plans.workload import line_parser


def loads(rows, weight):
    sums = rows.groupBy(F.spark_partition_id().alias("bucket")).agg(F.sum(weight), F.max(weight), F.count("*")).collect()
    return [r[1] for r in sums], max(r[2] for r in sums), sum(r[3] for r in sums)


@pytest.mark.parametrize("huge", [0, 5_000_000])
def test_buckets_weigh_the_same(spark, huge):
    rows = spark.range(20_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "one path").otherwise(F.col("id").cast("string")).alias("path"),
        F.when(F.col("id") == 7, huge).otherwise(F.pmod(F.xxhash64("id"), F.lit(1_000))).cast("long").alias("bytes"),
    )
    dealt = distribute_by_weight(rows.repartition(3), F.col("bytes"), 16)
    assert dealt.columns == ["id", "path", "bytes"] and dealt.rdd.getNumPartitions() == 16
    sums, largest, n = loads(dealt, "bytes")
    assert n == 20_000 and dealt.select("id").distinct().count() == 20_000
    others = sorted(sums)[:-1] if huge else sums
    assert max(sums) <= max(1.01 * sum(sums) / 16, largest) and max(others) <= 1.01 * sum(others) / len(others)


def test_few_rows_rows_without_weight_and_none(spark):
    rows = spark.createDataFrame([(1, 10), (2, None), (3, 0), (4, 10), (5, 0)], "id int, w int")
    dealt = distribute_by_weight(rows, F.col("w"), 4)
    assert Counter(map(tuple, dealt.collect())) == Counter(map(tuple, rows.collect()))
    assert max(loads(dealt, F.coalesce("w", F.lit(0)))[0]) == 10
    assert distribute_by_weight(rows.filter("id < 0"), F.col("w"), 4).count() == 0


def test_a_path_lies_in_one_partition(spark):
    files = spark.range(600).select(F.concat(F.lit("/v/"), F.col("id") % 50).alias("path")).unionAll(spark.range(1).select(F.lit(None)))
    placed = distribute_by_path(files, 8).select("path", F.spark_partition_id().alias("bucket"), (F.crc32("path") % 8).alias("wanted"))
    assert placed.filter("bucket = wanted").count() == placed.count() == 600


# Texts by path


def parsed_rows(spark, rows):
    files = spark.createDataFrame(rows, "doc_id long, path string, content string")
    return parse_files(files.withColumn("content", F.encode("content", "utf-8")).repartition(5), line_parser, "doc_id", "path")


@pytest.mark.parametrize("chunk_bytes", [1, 64, 1_000, 1 << 24])
def test_chunks_are_the_text_in_order(spark, chunk_bytes):
    rows = [(i, "hot.pdf" if i % 3 else f"p{i}.PDF", "\n".join(f"line {i} {j} é" for j in range(i % 7 + 1))) for i in range(1, 200)]
    chunks = text_chunks(parsed_rows(spark, rows), ("doc_id",), chunk_bytes)
    found = {}
    for path, chunk, text in sorted(map(tuple, chunks.collect())):
        found.setdefault(path, []).append((chunk, text))
    wanted = {}
    for i, path, text in sorted(rows):
        if not path.endswith("0.PDF"):
            wanted.setdefault(path, []).extend(text.split("\n"))
    assert {p: "\n\n".join(t for _, t in c) for p, c in found.items()} == {p: "\n\n".join(lines) for p, lines in wanted.items()}
    for path, lines in wanted.items():
        starts, at = [], 0
        for line in lines:
            starts.append(at // chunk_bytes)
            at += len(line.encode()) + 2
        assert [c for c, _ in found[path]] == sorted(set(starts))


def test_absent_null_and_failed_contents(spark):
    json = {
        1: ("a", '{"document":{"elements":[{"content":"x"},{"content":null},{},{"content":"y"}]}}'),
        2: ("a", '{"document":{"elements":[{"content":""}]}}'),
        3: ("silent", '{"document":{"elements":[{"content":null}]}}'),
        4: ("gone", '{"document":{"elements":[{}]}}'),
        5: ("failed", '{"document":{"elements":[{"content":"x"}]},"error_status":"no"}'),
        6: (None, '{"document":{"elements":[{"content":"x"}]}}'),
        7: ("empty", None),
    }
    rows = spark.createDataFrame([(k, *v) for k, v in json.items()], "doc_id long, path string, json string")
    parsed = rows.select("doc_id", "path", F.parse_json("json").alias("parsed"))
    chunks = text_chunks(parsed, ("doc_id",), 100)
    assert Counter(map(tuple, chunks.collect())) == Counter([("a", 0, "x\n\ny\n\n"), ("silent", 0, "")])
    referred = rows_by_reference(parsed, chunks, "doc_id")
    kept = referred.select("doc_id", "path", member_text(F.col("raw_parsed"), "document").isNotNull(), "n_chunks")
    assert Counter(map(tuple, kept.collect())) == Counter([(1, "a", True, 1), (2, "a", True, 1), (3, "silent", True, 1)])
    assert text_chunks(parsed.filter("doc_id < 0"), ("doc_id",)).count() == 0


def test_a_hot_path_is_spread(spark):
    parsed = spark.range(60_000).select(
        F.lit("hot").alias("path"), "id", F.to_variant_object(F.expr("named_struct('document', named_struct('elements', array(named_struct('content', cast(id as string)))))")).alias("parsed")
    )
    chunks = text_chunks(parsed, ("id",), 10_000).cache()
    whole = "\n\n".join(r["text"] for r in chunks.orderBy("chunk").collect())
    assert whole == "\n\n".join(map(str, range(60_000))) and chunks.agg(F.max(F.length("text"))).first()[0] <= 10_010
