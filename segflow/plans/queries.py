"""The registered queries: every operator run over whole tables.

VARIANT results are returned as JSON text, since a VARIANT column can neither be
compared nor sorted.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow.config import PipelineConfig
from segflow.functions.parsers import html_parser
from segflow.functions.paths import EXTENSION_PATTERN, declare_parse_extensions
from segflow.functions.paths import file_extension as extension_of
from segflow.functions.variants import evaluated_once, is_readable_xml, member, member_list, member_text, xml_to_variant
from segflow.operators import documents as docs
from segflow.operators import quality
from segflow.operators.claims import claim_segments
from segflow.operators.clustering import files_between, read_clustered, replace_clustered
from segflow.operators.distribution import distribute_by_path, distribute_by_weight
from segflow.operators.messages import to_variant
from segflow.operators.path_texts import rows_by_reference, text_chunks
from segflow.operators.sections import MESSAGE_ID, requests, responses, supplemental
from segflow.operators.typed import learned_schema, path_evidence, typed_message
from segflow.plans.document_text import documents_to_text, replace_table
from segflow.plans.documents import DocumentPipeline
from segflow.plans.messages import MessagePipeline, message_pipelines
from segflow.plans.workload import (
    customer_messages,
    document_files,
    line_parser,
    order_messages,
    order_variants,
    parsed_documents,
    per_session,
    spread_evenly,
    table,
)
from segflow.scratch import new_scratch_dir
from segflow.sources.landing import land_files
from segflow.sources.tables import preview, stream_table, stream_table_sql, table_by_parameter
from segflow.streaming.outcomes import OUTCOME, OutcomeStream, Sink
from segflow.streaming.refresh import refresh
from segflow.streaming.tables import StreamTable

BUCKETS = 16
TOP_FILES = 50


def _json(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.to_json(c) for c in columns})


def _message_key(messages: str = "messages") -> Column:
    return F.variant_get(messages, "$.Supplemental.SwitchTransactionId", "bigint")


# Messages in batch


def variant_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = order_messages(spark, sf_dir).select("transaction_file_source_id", "value")
    return _json(to_variant(texts), "messages")


def variant_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = F.col("messages")
    return order_variants(spark, sf_dir).select(
        _message_key().alias("message_key"),
        F.variant_get(messages, "$.Supplemental.Store.StoreId", "bigint").alias("party"),
        member_text(messages, "Supplemental", "Vendor").alias("label"),
        member_text(messages, "NcpdpResponse", "S_HD", "F_501_F1").alias("answer"),
        F.to_json(member(messages, "NcpdpRequest", "S_HD", "F_110_AK")).alias("empty_field"),
        member_text(messages, "ncpdprequest").alias("wrong_case"),
    )


def variant_try_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = ("NcpdpRequest", "S_07")
    occurrences = F.size(member_list(F.col("messages"), *claims))
    shape = (
        F.when(member(F.col("messages"), *claims).isNull(), "absent")
        .when(member_list(F.col("messages"), *claims).isNull(), "object")
        .otherwise("array")
    )
    return (
        order_variants(spark, sf_dir)
        .select(shape.alias("shape"), F.when(occurrences > 0, occurrences).alias("occurrences"))
        .groupBy("shape", "occurrences")
        .agg(F.count("*").alias("n_messages"))
    )


def variant_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncated, empty and absent texts next to whole ones."""
    value = (
        F.when(F.col("status") == "F", F.expr("left(value, length(value) - 3)"))
        .when((F.col("status") == "P") & F.col("label").startswith("1"), "")
        .when((F.col("status") == "P") & F.col("label").startswith("2"), F.lit(None))
        .otherwise(F.col("value"))
    )
    texts = order_messages(spark, sf_dir).select("message_key", value.alias("value"))
    checked = texts.select(
        "message_key",
        (F.col("value").isNotNull() & ~is_readable_xml(F.col("value"))).alias("broken"),
        xml_to_variant(F.col("value")).isNotNull().alias("parsed"),
    )
    outcomes = F.array_compact(
        F.array(F.when(F.col("broken"), "malformed"), F.when(F.col("parsed"), "parsed").otherwise("null"))
    )
    return (
        checked.select("message_key", F.explode(outcomes).alias("outcome"))
        .groupBy("outcome")
        .agg(F.count("*").alias("n_messages"), F.sum("message_key").alias("key_sum"))
    )


def variant_long_exponents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of digits, E and many digits stay text wherever they stand; short exponents stay numbers."""
    key, exponent = F.col("o_orderkey"), F.lit(1_000_000) + F.col("o_orderkey") % 9_000_000
    value = F.format_string(
        '<m><a>%1$dE%2$d</a><b c="%1$de+%3$d"/><d><![CDATA[-0.5E%2$d]]></d><t>lot "7E%2$d" held</t><u> 7E00%2$d </u><z>1E0000012</z></m>',
        key, exponent, exponent + 100_000_000,
    )
    texts = spread_evenly(table(spark, sf_dir, "orders").select("o_orderkey")).select(
        key.alias("message_key"), value.alias("value")
    )
    return _json(to_variant(texts), "messages")


def request_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _json(requests(order_variants(spark, sf_dir), keep_messages=False), "value")


def response_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = order_variants(spark, sf_dir).withColumn("message_key", _message_key())
    rows = responses(variants, keys=(MESSAGE_ID, "message_key"), keep_messages=False)
    return _json(rows.select(*[c for c in rows.columns if c != "message_key"], "message_key"), "value")


def supplemental_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = supplemental(order_variants(spark, sf_dir))
    return _json(rows.withColumn("message_key", _message_key()).drop("messages"), "value")


@per_session
def _order_schema(spark: SparkSession, sf_dir: str):
    return learned_schema(path_evidence(order_messages(spark, sf_dir)))


def typed_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims of messages parsed by the schema that all messages taught: codes whole, segments always lists."""
    typed = order_messages(spark, sf_dir).select(
        "message_key", evaluated_once(typed_message(F.col("value"), _order_schema(spark, sf_dir))).alias("message")
    )
    request = F.col("message.NcpdpRequest")
    return typed.select(
        "message_key", request["S_01"]["F_302_C2"].alias("member"), F.posexplode(request["S_07"]).alias("pos", "claim")
    ).select(
        "message_key",
        "member",
        "pos",
        F.col("claim.F_402_D2").alias("number"),
        F.col("claim.F_407_D7").alias("item"),
        F.col("claim.F_442_E7").alias("quantity"),
    )


def typed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all messages say about each path of their elements."""
    return path_evidence(order_messages(spark, sf_dir)).select(
        F.array_join("path", "/").alias("path"), "occurrences", "most", "codes", (F.col("not_numbers") > 0).alias("is_text")
    )


def claims_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request segment with the claim it was written for."""
    return _json(claim_segments(order_messages(spark, sf_dir), "message_key"), "value")


# Documents in batch


def _texts(files: DataFrame) -> DataFrame:
    return files.select("path", docs.utf8_text(F.col("content")).alias("text"))


def file_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_files(spark, sf_dir).select("path", extension_of(F.col("path")).alias("extension"))


def docs_route_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(docs.parsable_files(document_files(spark, sf_dir)))


def docs_route_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(docs.plain_files(document_files(spark, sf_dir)))


def docs_route_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routing in SQL: the list in a session variable, the source name as a parameter."""
    document_files(spark, sf_dir).createOrReplaceTempView("document_files")
    listed = declare_parse_extensions(spark)
    return spark.sql(
        f"""
        SELECT path, array_contains({listed}, lower(regexp_extract(path, :pattern, 1))) AS parsed,
               octet_length(content) AS n_bytes
        FROM IDENTIFIER(:source)
        """,
        args={"source": "document_files", "pattern": EXTENSION_PATTERN},
    )


def docs_topn_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-n and distribution in SQL, both numbers as parameters."""
    document_files(spark, sf_dir).createOrReplaceTempView("document_files")
    return spark.sql(
        """
        SELECT path, sha2(content, 256) AS content_hash
        FROM (SELECT path, content FROM IDENTIFIER(:source) ORDER BY path LIMIT :n)
        DISTRIBUTE BY crc32(path) % :buckets
        """,
        args={"source": "document_files", "n": TOP_FILES, "buckets": BUCKETS},
    )


def docs_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _json(docs.error_documents(parsed_documents(spark, sf_dir)), "raw_parsed")


def docs_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.document_parts(parsed_documents(spark, sf_dir)).withColumn("content", F.col("content").cast("string"))


def _in_folders(rows: DataFrame) -> DataFrame:
    """Many documents under one path."""
    return rows.withColumn("path", F.concat(F.lit("/v/folder"), F.col("doc_id") % 7, F.lit(".pdf")))


def docs_elements_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of documents that share paths: one per document, not per path."""
    rows = docs.document_texts(_in_folders(parsed_documents(spark, sf_dir)), "doc_id", "path")
    return rows.select("doc_id", "path", "text")


def docs_with_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _json(docs.document_texts(_in_folders(parsed_documents(spark, sf_dir)), "doc_id", "path"), "raw_parsed")


def docs_texts_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-path form, on paths that name one document each."""
    parsed = parsed_documents(spark, sf_dir)
    return _json(docs.with_raw(docs.texts_by_path(parsed), parsed), "raw_parsed")


def docs_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _json(documents_to_text(document_files(spark, sf_dir), line_parser), "raw_parsed")


def docs_to_text_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, distributed over buckets, by rows and then by bytes, and written to a replaced table."""
    name = f"{_scratch_schema(spark, 'texts')}.document_text"
    for weight in (None, F.octet_length("content")):
        replace_table(documents_to_text(document_files(spark, sf_dir), line_parser, buckets=BUCKETS, weight=weight), name)
    return _json(table_by_parameter(spark, name), "raw_parsed")


def docs_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = document_files(spark, sf_dir)
    files.createOrReplaceTempView("document_files")
    shown = preview(spark, "document_files")
    found = shown.join(files, ["doc_id", "path", "content"], "left_semi")
    return shown.agg(F.count("*").alias("n_rows")).crossJoin(found.agg(F.count("*").alias("n_found")))


def docs_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(docs.first_files(document_files(spark, sf_dir), TOP_FILES))


def docs_topn_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows where many share a path: as many as asked for, the last path's share of them."""
    first = docs.first_files(_in_folders(document_files(spark, sf_dir)), TOP_FILES)
    return first.groupBy("path").agg(F.count("*").alias("n_rows"))


def docs_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file, with its content, dealt to one of the buckets."""
    files = docs.spread(document_files(spark, sf_dir), BUCKETS)
    return files.select(
        "path", F.sha2("content", 256).alias("content_hash"), (F.spark_partition_id() < BUCKETS).alias("in_bucket")
    )


def html_parse_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = spread_evenly(table(spark, sf_dir, "pages")).select(
        "page_id", F.concat(F.lit("/v/page"), "page_id", F.lit(".html")).alias("path"), F.encode("html", "utf-8").alias("content")
    )
    return _html_texts(files)


def docs_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file in the partition that its path's checksum names."""
    files = distribute_by_path(document_files(spark, sf_dir), BUCKETS)
    return files.select("path", F.sha2("content", 256).alias("content_hash"), F.spark_partition_id().cast("long").alias("bucket"))


def docs_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of few paths, one of which holds a third of all rows, dealt by their bytes; whether buckets came out even."""
    hot = F.when(F.col("doc_id") % 3 == 0, "/v/hot.pdf").otherwise(F.col("path"))
    files = _in_folders(document_files(spark, sf_dir)).withColumn("path", hot)
    dealt = distribute_by_weight(files, F.octet_length("content"), BUCKETS).select(
        "doc_id", "path", F.octet_length("content").alias("n_bytes"), F.spark_partition_id().alias("bucket")
    )
    sums = dealt.groupBy("bucket").agg(F.sum("n_bytes").alias("bytes"), F.max("n_bytes").alias("largest"))
    bound = F.greatest(1.1 * F.sum("bytes") / BUCKETS, F.max("largest"))
    even = sums.agg((F.max("bytes") <= bound).alias("even"))
    return dealt.drop("bucket").crossJoin(F.broadcast(even))


CHUNK = 1 << 16


def docs_path_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of paths that many documents share, in order, in chunks."""
    return text_chunks(_in_folders(parsed_documents(spark, sf_dir)), ("doc_id",), CHUNK)


def docs_by_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of a path beside the number of its text's chunks."""
    parsed = _in_folders(parsed_documents(spark, sf_dir))
    return _json(rows_by_reference(parsed, text_chunks(parsed, ("doc_id",), CHUNK), "doc_id"), "raw_parsed")


HTML_EXTENSIONS = (".html", ".htm")


def _html_texts(files: DataFrame) -> DataFrame:
    """Files routed to the HTML parser by their extension, and what it makes of them."""
    parsed = F.col("parsed")
    return docs.parse_files(docs.parsable_files(files, HTML_EXTENSIONS), html_parser, "page_id").select(
        "page_id",
        F.size(docs.parts(parsed)).alias("n_parts"),
        docs.join_contents(docs.part_contents(parsed)).alias("text"),
        docs.error_status(parsed).alias("error_status"),
    )


def html_mixed_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of which some are PDF or ZIP by their first bytes, or hold NUL bytes: errors, not texts."""
    kind = F.col("page_id") % 5
    head = F.when(kind == 0, F.lit(b"%PDF-1.7 ")).when(kind == 1, F.lit(b"PK\x03\x04")).when(kind == 2, F.lit(b"\0"))
    html = F.encode("html", "utf-8")
    files = spread_evenly(table(spark, sf_dir, "pages")).select(
        "page_id",
        F.concat(F.lit("/v/page"), "page_id", F.lit(".HTM")).alias("path"),
        F.when(head.isNull(), html).otherwise(F.concat(head, html)).alias("content"),
    )
    return _html_texts(files).select("page_id", (F.col("n_parts") > 0).alias("has_text"), "error_status")


# Streams over landed files


def _scratch_schema(spark: SparkSession, label: str) -> str:
    """A new schema whose tables lie in the shared scratch folder."""
    location = new_scratch_dir(spark, label)
    name = location.rpartition("/")[2].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{location}/tables'")
    return name


def _config(spark: SparkSession, label: str, **settings) -> PipelineConfig:
    """Tables of their own. Files are landed by the million, so tasks list them and a ledger holds the names read."""
    base = new_scratch_dir(spark, label)
    schema = _scratch_schema(spark, label)
    return PipelineConfig(
        "spark_catalog",
        schema,
        "landing",
        volumes_root=base,
        checkpoint_root=f"{base}/checkpoints",
        ingest_partitions=spark.sparkContext.defaultParallelism,
        **{"ledger": True, **settings},
    )


def _segments(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    return tuple(sorted(r[0] for r in table(spark, sf_dir, "customer").select("c_mktsegment").distinct().collect()))


def _land_messages(messages: DataFrame, config: PipelineConfig, file_type: Column) -> int:
    name = F.concat(file_type, F.lit("/msg"), "message_key", F.lit(".xml"))
    return land_files(messages, config.landing_path(), name, F.col("value"))


@per_session
def _message_tables(spark: SparkSession, sf_dir: str) -> list[MessagePipeline]:
    """All customer messages landed by market segment and streamed into tables once."""
    config = _config(spark, "messages", file_types=_segments(spark, sf_dir))
    _land_messages(customer_messages(spark, sf_dir), config, F.col("label"))
    pipelines = message_pipelines(spark, config)
    refresh(*pipelines)
    return pipelines


def _all_types(spark: SparkSession, pipelines: list[MessagePipeline], which: str) -> DataFrame:
    tables = [
        spark.table(getattr(p, which).name).withColumn("file_type", F.lit(p.file_type)) for p in pipelines
    ]
    return reduce(DataFrame.unionByName, tables)


def ingest_text_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_types(spark, _message_tables(spark, sf_dir), "bronze").select(
        "file_type",
        F.col("file_metadata.file_name").alias("file_name"),
        F.col("file_metadata.file_size").alias("file_size"),
        "value",
    )


def file_source_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.col("transaction_file_source_id")
    return _all_types(spark, _message_tables(spark, sf_dir), "bronze").agg(
        F.count("*").alias("n_files"),
        F.count_distinct(ids).alias("n_ids"),
        F.count_if(ids.rlike("^[0-9a-f]{64}$")).alias("n_hex"),
    )


def bronze_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _all_types(spark, _message_tables(spark, sf_dir), "bronze")
    repeated = quality.duplicate_keys(bronze, "transaction_file_source_id").agg(F.count("*").alias("repeated_ids"))
    nulls = quality.null_counts(bronze, "transaction_file_source_id", "file_metadata", "ingest_time")
    as_rows = [nulls.select(F.lit(c).alias("check"), F.col(c).alias("violations")) for c in nulls.columns]
    as_rows.append(repeated.select(F.lit("repeated_ids").alias("check"), F.col("repeated_ids").alias("violations")))
    return reduce(DataFrame.unionAll, as_rows)


def variant_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _all_types(spark, _message_tables(spark, sf_dir), "variant")
    return _json(rows.select("file_type", _message_key().alias("message_key"), "messages"), "messages")


def _streamed(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    rows = _all_types(spark, _message_tables(spark, sf_dir), which).withColumn("message_key", _message_key())
    return _json(rows.drop("messages", "transaction_file_source_id"), "value")


def requests_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, "requests")


def responses_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, "responses")


def supplemental_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, "supplemental")


def multi_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pipelines = _message_tables(spark, sf_dir)
    return (
        _all_types(spark, pipelines, "bronze")
        .groupBy("file_type")
        .agg(F.count("*").alias("n_files"), F.sum(F.length("value")).alias("n_chars"))
    )


@per_session
def _quarantined(spark: SparkSession, sf_dir: str) -> str:
    """Messages of which some were cut short, streamed into the tables of one type; the name of the last table."""
    config = _config(spark, "quarantine", file_types=("mixed",))
    (pipeline,) = message_pipelines(spark, config, keep_messages=False)
    cut = F.when(F.col("status") == "F", F.expr("left(value, length(value) - 3)")).otherwise(F.col("value"))
    _land_messages(customer_messages(spark, sf_dir).withColumn("value", cut), config, F.lit("mixed"))
    refresh(pipeline)
    return pipeline.malformed.name


def malformed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts set aside as malformed, as they came."""
    rows = spark.table(_quarantined(spark, sf_dir))
    return rows.select(F.col("file_metadata.file_name").alias("file_name"), "value")


def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks on rows that break them: repeated keys and nulls that the tables hold."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("label")
    )
    repeated = quality.duplicate_keys(rows, "id").agg(F.count("*").alias("n"), F.sum("n_rows").alias("n_rows"))
    return quality.null_counts(rows, "id", "label").crossJoin(
        repeated.select(F.col("n").alias("repeated_ids"), F.col("n_rows").alias("repeated_rows"))
    )


def _waves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    messages = customer_messages(spark, sf_dir)
    late = F.col("status") == "P"
    return messages.filter(~late), messages.filter(late)


def _steps(spark: SparkSession, steps: list[tuple[str, int]]) -> DataFrame:
    return spark.createDataFrame(steps, "step string, n_rows bigint")


@per_session
def _refresh_steps(spark: SparkSession, sf_dir: str) -> dict[str, list[tuple[str, int]]]:
    """Row counts of all six tables after each kind of refresh."""
    config = _config(spark, "refresh", file_types=("all",))
    (pipeline,) = message_pipelines(spark, config, keep_messages=False)
    first, late = _waves(spark, sf_dir)
    steps: dict[str, list[tuple[str, int]]] = {"incremental": [], "full": []}

    def note(kind: str, step: str) -> None:
        for which in ("bronze", "variant", "malformed", "requests", "responses", "supplemental"):
            steps[kind].append((f"{step} {which}", spark.table(getattr(pipeline, which).name).count()))

    _land_messages(first, config, F.lit("all"))
    refresh(pipeline)
    note("incremental", "first run")
    refresh(pipeline)
    note("incremental", "no new files")
    _land_messages(late, config, F.lit("all"))
    refresh(pipeline)
    note("incremental", "new files")
    refresh(pipeline, full=True)
    note("full", "full refresh")
    return steps


def refresh_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _steps(spark, _refresh_steps(spark, sf_dir)["incremental"])


def refresh_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _steps(spark, _refresh_steps(spark, sf_dir)["full"])


def ledger_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in dated folders read by the ledger: all, none again, late ones of the newest folders, late ones of all."""
    config = _config(spark, "ledger", file_types=("all",))
    first, late = _waves(spark, sf_dir)
    folder = F.concat(F.lit("all/2026-01-0"), F.col("message_key") % 5)
    steps: list[tuple[str, int]] = []

    def step(name: str, newest: int | None = None) -> None:
        (pipeline,) = message_pipelines(spark, replace(config, newest_folders=newest), keep_messages=False)
        refresh(pipeline)
        steps.extend((f"{name} {which}", spark.table(getattr(pipeline, which).name).count()) for which in ("bronze", "requests"))

    _land_messages(first, config, folder)
    step("first run")
    step("no new files")
    _land_messages(late, config, folder)
    step("newest folders", 2)
    step("all folders")
    return _steps(spark, steps)


def repeated_keys_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that order again, told as the orders arrive in two runs, with the number of their orders."""
    config = _config(spark, "keys")
    orders = table(spark, sf_dir, "orders")
    arriving, again = StreamTable(config.table("orders")), StreamTable(config.table("orders_again"))
    for wave in (F.col("o_orderstatus") != "O", F.col("o_orderstatus") == "O"):
        wanted = orders.filter(wave).select("o_custkey", "o_orderkey")
        arriving.create(spark, wanted.schema, config)
        wanted.write.mode("append").parquet(arriving.location(spark))
        report = OutcomeStream(
            lambda rows: rows.withColumn(OUTCOME, F.lit("again")), {"again": Sink(again, ("o_custkey", "n_rows"))}, config
        )
        report.append(quality.repeated_keys(stream_table(spark, arriving.name), "o_custkey"), "update").awaitTermination()
    return spark.table(again.name).groupBy("o_custkey").agg(F.max("n_rows").alias("n_rows"))


def docs_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a range of paths from a table clustered by path and size, and whether a part of its files was enough."""
    name = f"{_scratch_schema(spark, 'clustered')}.document_files"
    files = document_files(spark, sf_dir).withColumn("n_bytes", F.octet_length("content"))
    replace_clustered(files, name, ("path", "n_bytes"), 64)
    limits = {"path": ("/v/doc00000100", "/v/doc00000120"), "n_bytes": (None, 5_000)}
    found = read_clustered(spark, name, **limits)
    few = len(files_between(spark, name, limits)) <= 32
    return found.select("path", F.sha2("content", 256).alias("content_hash"), F.lit(few).alias("few_files"))


class _StopsAtTheLast(MessagePipeline):
    """A parse that fails, in the task, for the messages of one key."""

    def __init__(self, *args, key: int, **options) -> None:
        super().__init__(*args, **options)
        self.key = key

    def parse(self, texts: DataFrame) -> DataFrame:
        mark = F.lit(f"<SwitchTransactionId>{self.key}<")
        stopped = F.when(F.contains("value", mark), F.raise_error(F.lit("more than the parser takes")).cast("string"))
        return super().parse(texts.withColumn("value", F.coalesce(stopped, "value")))


def failed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages but the one that the parse fails on are parsed; that one is set aside with its error."""
    config = _config(spark, "failing", file_types=("all",))
    messages = customer_messages(spark, sf_dir)
    pipeline = _StopsAtTheLast(spark, config, "all", keep_messages=False, key=messages.agg(F.max("message_key")).first()[0])
    _land_messages(messages, config, F.lit("all"))
    refresh(pipeline)
    name = F.col("file_metadata.file_name").alias("file_name")
    told = F.contains("error", F.lit("more than the parser takes"))
    failed = spark.table(pipeline.failed.name).select(name, F.when(told, "failed").otherwise("other").alias("outcome"), "value")
    parsed = spark.table(pipeline.variant.name).select(name, F.lit("parsed").alias("outcome"), F.lit(None).cast("string").alias("value"))
    return failed.unionAll(parsed)


def ingest_file_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six facts about each landed file."""
    meta = F.col("file_metadata")
    return _all_types(spark, _message_tables(spark, sf_dir), "bronze").select(
        F.substring_index(meta["file_path"], "/", -2).alias("path_end"),
        meta["file_name"].alias("file_name"),
        meta["file_size"].alias("file_size"),
        meta["file_block_start"].alias("block_start"),
        meta["file_block_length"].alias("block_length"),
        (F.col("ingest_time") >= meta["file_modification_time"]).alias("read_after_change"),
    )


@per_session
def _document_tables(spark: SparkSession, sf_dir: str) -> DocumentPipeline:
    """Every document landed as a file and streamed into the document table."""
    config = _config(spark, "documents")
    files = document_files(spark, sf_dir)
    land_files(files, config.landing_path(), F.substring_index("path", "/", -1), F.col("content"))
    pipeline = DocumentPipeline(spark, config)
    refresh(pipeline)
    return pipeline


def ingest_binary_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = spark.table(_document_tables(spark, sf_dir).documents.name)
    return stored.select(
        F.substring_index("path", "/", -1).alias("file_name"), "length", docs.utf8_text(F.col("content")).alias("text")
    )


def _specification_text(spark: SparkSession, sf_dir: str, limit: int | None) -> DataFrame:
    """Landed files, ingested, turned to texts, in a replaced table read by its name."""
    files = spark.table(_document_tables(spark, sf_dir).documents.name)
    name = f"{_scratch_schema(spark, 'specification')}.document_text"
    texts = documents_to_text(files, line_parser, limit=limit, buckets=BUCKETS, key=("spec_file_source_id",))
    replace_table(texts, name)
    rows = table_by_parameter(spark, name).withColumn("file_name", F.substring_index("path", "/", -1)).drop("path")
    return _json(rows, "raw_parsed")


def specification_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _specification_text(spark, sf_dir, None)


def specification_text_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _specification_text(spark, sf_dir, TOP_FILES)


@per_session
def _parsed_table(spark: SparkSession, sf_dir: str) -> str:
    """The streaming parsed view, read in SQL and appended to a table."""
    pipeline = _document_tables(spark, sf_dir)
    view = pipeline.parse_documents(line_parser)
    parsed = StreamTable(pipeline.config.table("parsed"), comment="Parsed documents.")
    parsed.append(stream_table_sql(spark, view), pipeline.config).awaitTermination()
    return parsed.name


def parsed_view_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.col("parsed")
    return spark.table(_parsed_table(spark, sf_dir)).select(
        F.substring_index("path", "/", -1).alias("file_name"),
        docs.join_contents(docs.part_contents(parsed)).alias("text"),
        docs.error_status(parsed).alias("error_status"),
    )


QUERIES = {
    query.__name__: query
    for query in (
        request_segments,
        response_segments,
        supplemental_fields,
        variant_batch,
        variant_path,
        variant_try_cast,
        variant_malformed,
        variant_long_exponents,
        typed_claims,
        typed_schema,
        claims_in_order,
        file_extension,
        docs_route_parsed,
        docs_route_raw,
        docs_route_sql,
        docs_errors,
        docs_elements,
        docs_elements_agg,
        docs_with_raw,
        docs_to_text,
        docs_to_text_table,
        docs_preview,
        docs_topn,
        docs_topn_sql,
        docs_topn_repeated,
        docs_texts_by_path,
        docs_buckets,
        docs_by_path,
        docs_by_bytes,
        docs_path_chunks,
        docs_by_reference,
        html_mixed_bytes,
        malformed_stream,
        failed_stream,
        ledger_refresh,
        repeated_keys_stream,
        docs_clustered,
        ingest_file_metadata,
        specification_text,
        specification_text_top,
        constraint_violations,
        html_parse_text,
        ingest_text_stream,
        ingest_binary_stream,
        variant_stream,
        requests_stream,
        responses_stream,
        supplemental_stream,
        parsed_view_stream,
        file_source_id,
        bronze_constraints,
        refresh_incremental,
        refresh_full,
        multi_type_counts,
    )
}
