import re

from pyspark.sql import functions as F

from conftest import plan_of
from segflow.plans.queries import request_segments
from segflow.plans.workload import KEY_STEP, claims_by_message, customer_messages, message_text, order_messages, table

SF = "/root/testdata/sf0.001"


def test_a_hot_key_becomes_many_small_messages(spark):
    rows = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id", F.lit(1).cast("bigint").alias("q")
    )
    claims = claims_by_message(rows, "k", F.col("id"), F.col("id"), F.col("id"), F.col("q"), F.col("id") % 2 == 0)
    filled = {"party": F.col("owner"), "label": F.lit("L"), "status": F.lit("F"), "stamp": F.lit("S")}
    texts = claims.withColumns(filled).select(
        "owner", "message_key", F.size("claims").alias("rows"), F.length(message_text()).alias("chars")
    )
    hot = texts.filter("owner = 1").agg(F.sum("rows"), F.max("rows"), F.max("chars"), F.count_distinct("message_key")).first()
    assert hot[0] >= 30_000 and hot[1] <= 40 and hot[2] < 12_000 and hot[3] > 1_000
    assert texts.agg(F.sum("rows")).first()[0] == 90_000
    assert texts.filter("message_key % 1000000000000 <> owner").count() == 0 and KEY_STEP == 10**12


def test_every_line_is_an_occurrence(spark):
    rows = request_segments(spark, SF).filter("request_segment = 'S_07'")
    once = rows.filter("key = 'F_402_D2'").count()
    repeated = rows.filter("key IS NULL")
    assert once + repeated.count() == table(spark, SF, "lineitem").join(
        table(spark, SF, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi"
    ).count()
    assert repeated.agg(F.max("pos")).first()[0] > 3


def test_counts_are_taken_before_the_shuffle(spark):
    plan = plan_of(order_messages(spark, SF))
    assert re.search(r"partial_count", plan)


def test_rows_of_small_files_are_not_sent_to_the_driver(spark):
    for messages in (order_messages, customer_messages):
        texts = messages(spark, SF).agg(F.count("*"))
        texts.collect()
        assert "Broadcast" not in plan_of(texts)


def test_texts_are_built_in_as_many_partitions_as_the_session_shuffles_into(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for messages in (order_messages, customer_messages):
        sizes = messages(spark, SF).groupBy(F.spark_partition_id()).agg(F.count("*")).collect()
        rows = [r[1] for r in sizes]
        assert len(rows) == n and max(rows) < 2 * sum(rows) / n
