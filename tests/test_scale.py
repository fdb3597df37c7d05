"""What must not grow on the driver: broadcasts that Spark takes for small ones, lists of landed files."""

from pyspark.sql import functions as F

from conftest import plan_of
from segflow.llm import toxicity
from segflow.operators import documents as docs
from segflow.plans.queries import _document_tables, _message_tables
from segflow.sources.ledger import LedgerIngest
from segflow.storage import Storage


def test_texts_by_path_are_not_broadcast_to_their_parses(spark):
    """Spark guesses a size from types, which is far too small for gathered texts: F1."""
    made = F.parse_json(F.concat(F.lit('{"document":{"elements":[{"content":"t'), "id", F.lit('"}]}}')))
    parsed = spark.range(100).select(F.concat(F.lit("p"), "id").alias("path"), made.alias("parsed"))
    rows = docs.with_raw(docs.texts_by_path(parsed), parsed)
    assert "Broadcast" not in plan_of(rows)
    assert sorted(r["text"] for r in rows.collect()) == sorted(f"t{i}" for i in range(100))


def _tables(spark, folder):
    """Customers of two market segments with their orders, and documents."""
    customers = "id AS c_custkey, 'Customer' AS c_name, 1 AS c_nationkey, id * 100.0D AS c_acctbal, concat('SEG',id % 2) AS c_mktsegment"
    orders = "id AS o_orderkey, id % 40 AS o_custkey, 'F' AS o_orderstatus, '1-URGENT' AS o_orderpriority"
    spark.range(40).selectExpr(*customers.split(", ")).write.parquet(f"{folder}/customer.parquet")
    spark.range(200).selectExpr(*orders.split(", ")).write.parquet(f"{folder}/orders.parquet")
    spark.range(30).selectExpr("id AS doc_id", "concat('text ',id) AS text").write.parquet(f"{folder}/documents.parquet")


def test_queries_ingest_by_a_ledger(spark, tmp_path):
    """Names of landed files do not come to the driver, which a file stream's listing brings there: F2 to F14, F18 to F20."""
    _tables(spark, str(tmp_path))
    messages, documents = _message_tables(spark, str(tmp_path)), _document_tables(spark, str(tmp_path))
    fed = [(p.bronze, p.config) for p in messages] + [(documents.documents, documents.config)]
    assert len(fed) == 3
    assert all(Storage(spark).exists(f"{table.checkpoint(spark, config)}/ledger") for table, config in fed)
    assert [spark.table(table.name).count() for table, _ in fed] == [20, 20, 30]


def test_a_ledger_is_not_broadcast(spark, tmp_path, monkeypatch):
    """Stored names look small to Spark and are not; nor are new ones told from them through the driver."""
    _tables(spark, str(tmp_path))
    pipeline = _document_tables(spark, str(tmp_path))
    frame, plans = type(spark.range(1)), []
    join = frame.join

    def noted(self, other, on=None, how=None):
        joined = join(self, other, on, how)
        plans.append(plan_of(joined))
        return joined

    monkeypatch.setattr(frame, "join", noted)
    path = pipeline.config.landing_path()
    again = LedgerIngest(spark, pipeline.config, pipeline.documents, path, content=F.col("content"), id_column="spec_file_source_id")
    assert again.run() == 0
    assert plans and not any("Broadcast" in plan for plan in plans)


def test_features_are_the_same_in_pieces_of_any_size(spark, monkeypatch):
    words = F.when(F.col("id") % 2 == 0, F.lit("good plain words")).otherwise(F.lit("awful nasty words"))
    sample = spark.range(60).select(words.alias("text"), F.array((F.col("id") % 2).cast("double")).alias("labels"))
    wanted = toxicity._selected_features(sample, ["toxic"])
    assert {" awful", " nasty"} <= set(wanted)
    monkeypatch.setattr(toxicity, "COUNTED_ROWS", 3)
    assert toxicity._selected_features(sample, ["toxic"]) == wanted
