"""Messages and document files derived from the given tables, for queries and benchmarks.

Messages have the shape of claim messages: a supplemental section, a request
and a response, each with segments that hold fields. Every line of an order, or
order of a customer, is a claim. An order or customer with many claims becomes
several messages: claims are dealt by arithmetic on their columns to as many
messages as their number needs, so no message is large and no row is left out.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow.operators.documents import PAGED_VERSION, parsable_files, parse_files
from segflow.operators.messages import to_variant
from segflow.scratch import new_scratch_dir

#: Claims of a message, on average, if its order or customer has more.
MESSAGE_CLAIMS = 8
#: Keys of further messages of an order or customer lie this far apart.
KEY_STEP = 1_000_000_000_000
XML_HEADER = '<?xml version="1.0" encoding="utf-8"?>'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tag(name: str, *inner: Column | str) -> Column:
    parts = [F.lit(part) if isinstance(part, str) else part.cast("string") for part in inner]
    return F.concat(F.lit(f"<{name}>"), *parts, F.lit(f"</{name}>"))


def claims_by_message(rows: DataFrame, key: str, deal: Column, number: Column, item: Column, quantity: Column, returned: Column):
    """``owner, message_key, claims``: every row is a claim of one message of its key.

    The rows of a key are counted on the map side; ``deal`` modulo the number of
    messages says which one a row goes to. Rows of a small file can be many, so
    neither side is broadcast through the driver.
    """
    claims = rows.select(
        F.col(key).alias("owner"),
        deal.cast("bigint").alias("deal"),
        F.struct(number.alias("number"), item.alias("item"), quantity.alias("quantity"), returned.alias("returned")).alias("claim"),
    )
    counts = claims.groupBy("owner").agg(F.ceil(F.count("*") / MESSAGE_CLAIMS).alias("messages"))
    message = F.col("owner") + F.col("deal") % F.col("messages") * KEY_STEP
    return (
        claims.join(counts.hint("merge"), "owner")
        .groupBy("owner", message.alias("message_key"))
        .agg(F.array_sort(F.collect_list("claim")).alias("claims"))
    )


def _per_claim(make) -> Column:
    return F.coalesce(F.array_join(F.transform("claims", make), ""), F.lit(""))


def message_text() -> Column:
    """XML of one message from ``message_key, party, label, status, stamp`` and ``claims``."""
    col = F.col
    supplemental = tag(
        "Supplemental",
        tag("Vendor", col("label")),
        tag("RecordType", "Claim"),
        tag("SwitchTransactionId", col("message_key")),
        tag("Store", tag("StoreId", col("party")), tag("State", "MN")),
        _per_claim(lambda c: tag("Drug", tag("Units", c["quantity"]))),
    )
    request = tag(
        "NcpdpRequest",
        tag(
            "S_HD",
            tag("F_102_A2", "D0"),
            tag("F_103_A3", "B1"),
            tag("F_109_A9", F.coalesce(F.size("claims"), F.lit(0))),
            tag("F_401_D1", col("stamp")),
            "<F_110_AK/>",
        ),
        tag("S_01", tag("F_302_C2", F.lpad(col("party").cast("string"), 12, "0"))),
        _per_claim(
            lambda c: F.concat(
                tag("S_07", tag("F_402_D2", c["number"]), tag("F_407_D7", c["item"]), tag("F_442_E7", c["quantity"])),
                F.when(c["returned"], tag("S_11", tag("F_409_D9", c["number"]))).otherwise(""),
            )
        ),
        F.when(col("status") == "P", "<S_05/>").otherwise(""),
    )
    response = tag(
        "NcpdpResponse",
        tag("S_HD", tag("F_102_A2", "D0"), tag("F_501_F1", F.when(col("status") == "F", "A").otherwise("R"))),
        tag("S_25", tag("F_524_FO", col("label"))),
        _per_claim(
            lambda c: tag(
                "S_21",
                tag("F_112_AN", F.when(c["returned"], "R").otherwise("P")),
                tag("F_526_FQ.1", "QTY ", c["quantity"], " &amp; ITEM ", c["item"]),
            )
        ),
    )
    answered = F.when(col("status") == "P", "").otherwise(response)
    return F.concat(F.lit(XML_HEADER), tag("ClaimBilling", supplemental, request, answered))


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of every order, a claim for each of its lines; lines without an order belong to no message."""
    lines = claims_by_message(
        table(spark, sf_dir, "lineitem"),
        "l_orderkey",
        F.col("l_partkey") + F.col("l_suppkey") + F.col("l_linenumber"),
        F.col("l_linenumber").cast("bigint"),
        F.col("l_partkey"),
        F.col("l_quantity").cast("bigint"),
        F.col("l_returnflag") == "R",
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("owner"),
        F.col("o_custkey").alias("party"),
        F.col("o_orderpriority").alias("label"),
        F.col("o_orderstatus").alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("stamp"),
    )
    return _messages(orders.join(lines.hint("merge"), "owner", "left"))


def customer_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of every customer, a claim for each order, with the market segment as ``label``."""
    orders = claims_by_message(
        table(spark, sf_dir, "orders"),
        "o_custkey",
        F.col("o_orderkey"),
        F.col("o_orderkey"),
        F.col("o_orderkey"),
        F.length("o_orderpriority").cast("bigint"),
        F.col("o_orderstatus") == "F",
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("owner"),
        F.col("c_nationkey").alias("party"),
        F.col("c_mktsegment").alias("label"),
        F.when(F.col("c_acctbal") < 0, "P").when(F.col("c_acctbal") < 5000, "F").otherwise("O").alias("status"),
        F.col("c_name").alias("stamp"),
    )
    return _messages(customers.join(orders.hint("merge"), "owner", "left"))


def spread_evenly(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt over as many partitions as the session shuffles into; an explicit number, which AQE leaves alone."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _messages(filled: DataFrame) -> DataFrame:
    """Texts of the messages. Keys and claims are dealt out before they become XML: few bytes move, all cores parse."""
    keyed = spread_evenly(filled.withColumn("message_key", F.coalesce("message_key", "owner")), "message_key")
    return keyed.select(
        "message_key",
        "label",
        "status",
        F.sha2(F.col("message_key").cast("string"), 256).alias("transaction_file_source_id"),
        message_text().alias("value"),
    )


def per_session(build):
    """Run ``build(spark, sf_dir)`` once for each Spark application and input folder."""
    done: dict[tuple[str, str], object] = {}

    @functools.wraps(build)
    def once(spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in done:
            done[key] = build(spark, sf_dir)
        return done[key]

    return once


def _stored(rows: DataFrame, label: str) -> str:
    directory = new_scratch_dir(rows.sparkSession, label)
    rows.write.parquet(directory)
    return directory


@per_session
def _variant_dir(spark: SparkSession, sf_dir: str) -> str:
    texts = order_messages(spark, sf_dir).select("transaction_file_source_id", "value")
    return _stored(to_variant(texts), "variant")


def order_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed order messages, stored once so that every reader shares the parse."""
    return spark.read.parquet(_variant_dir(spark, sf_dir))


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file row; the extension follows from the id."""
    extension = F.element_at(F.array(*[F.lit(e) for e in (".PDF", ".docx", ".txt", "")]), (F.col("doc_id") % 4 + 1).cast("int"))
    name = F.concat(F.lit("/v/doc"), F.lpad(F.col("doc_id").cast("string"), 8, "0"), extension)
    return table(spark, sf_dir, "documents").select(
        "doc_id", name.alias("path"), F.encode("text", "utf-8").alias("content")
    )


def line_parser(path: Column, content: Column, options: Column) -> Column:
    """Parse result with one part per line; ``.PDF`` is version 1.0, ids ending in 0 fail."""
    lines = F.transform(F.split(content.cast("string"), "\n"), lambda line: F.struct(line.alias("content")))
    failed = path.rlike(r"0\.[^.]+$")
    paged = path.endswith(".PDF")
    document = F.struct(F.when(paged, lines).alias("pages"), F.when(~paged, lines).alias("elements"))
    return F.to_variant_object(
        F.struct(
            F.struct(F.when(paged, PAGED_VERSION).otherwise(options["version"]).alias("version")).alias("metadata"),
            F.when(~failed, document).alias("document"),
            F.when(failed, "unreadable").alias("error_status"),
        )
    )


@per_session
def _parsed_dir(spark: SparkSession, sf_dir: str) -> str:
    return _stored(parse_files(parsable_files(document_files(spark, sf_dir)), line_parser, "doc_id", "path"), "parsed")


def parsed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse results of the documents that need parsing, stored once like the messages."""
    return spark.read.parquet(_parsed_dir(spark, sf_dir))
