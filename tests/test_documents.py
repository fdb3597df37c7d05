import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from segflow.functions.paths import declare_parse_extensions, file_extension, needs_parsing
from segflow.operators import documents as docs
from segflow.plans.document_text import documents_to_text, replace_table
from segflow.sources.tables import preview, table_by_parameter


def json_parser(path, content, options):
    """Test parser: the content already is the parse result as JSON."""
    return F.parse_json(content.cast("string"))


def parts(*contents):
    return "[" + ",".join("{}" if c is None else f'{{"content":{c}}}' for c in contents) + "]"


CASES = {
    # path: (content, expected (text, error_status) or None when the document is left out)
    "/v/two.pdf": (f'{{"metadata":{{"version":"2.0"}},"document":{{"elements":{parts(chr(34)+"a"+chr(34), chr(34)+"b"+chr(34))}}}}}', ("a\n\nb", None)),
    "/v/one.PDF": (f'{{"metadata":{{"version":"1.0"}},"document":{{"pages":{parts(chr(34)+"p"+chr(34))},"elements":{parts(chr(34)+"e"+chr(34))}}}}}', ("p", None)),
    "/v/nover.docx": (f'{{"document":{{"pages":{parts(chr(34)+"p"+chr(34))},"elements":{parts(chr(34)+"e"+chr(34))}}}}}', ("e", None)),
    "/v/err.png": ('{"error_status":"bad","document":{"elements":[{"content":"x"}]}}', (None, "bad")),
    "/v/errlist.png": ('{"error_status":[{"page":1}]}', (None, '[{"page":1}]')),
    "/v/errnull.png": ('{"error_status":null,"document":{"elements":[{"content":"x"}]}}', ("x", None)),
    "/v/empty.ppt": ('{"document":{"elements":[]}}', None),
    "/v/nodoc.ppt": ("{}", None),
    "/v/notalist.ppt": ('{"document":{"elements":{"content":"x"}}}', None),
    "/v/jsonnull.jpg": ('{"document":{"elements":[{"content":null}]}}', ("", None)),
    "/v/some.jpeg": ('{"document":{"elements":[{"content":"a"},{"type":"x"},{"content":null},{"content":"b"}]}}', ("a\n\nb", None)),
    "/v/nocontent.doc": ('{"document":{"elements":[{"type":"x"}]}}', None),
    "/v/number.pptx": ('{"document":{"elements":[{"content":5},{"content":{"k":1}}]}}', ('5\n\n{"k":1}', None)),
    "/v/null.pdf": (None, None),
    "/v/plain.txt": ("{just text", ("{just text", None)),
    "/v/noext": ("text", ("text", None)),
    "/v/dir.pdf/noext": ("text", ("text", None)),
    "/v/a.pdf.bak": ("text", ("text", None)),
    "/v/nothing.txt": (None, (None, None)),
    None: ("lost", None),
}


@pytest.fixture
def files(spark):
    rows = [(p, None if c is None else bytearray(c, "utf-8")) for p, (c, _) in CASES.items()]
    return spark.createDataFrame(rows, "path string, content binary")


def test_every_case_of_the_text_table(files):
    found = {r["path"]: (r["text"], r["error_status"]) for r in documents_to_text(files, json_parser).collect()}
    assert found == {p: e for p, (_, e) in CASES.items() if e is not None}


def test_columns_and_raw_parse(files):
    rows = documents_to_text(files, json_parser)
    assert rows.dtypes == [("path", "string"), ("raw_parsed", "variant"), ("text", "string"), ("error_status", "string")]
    raw = {r[0]: r[1] for r in rows.select("path", F.to_json("raw_parsed")).collect()}
    assert raw["/v/err.png"] and raw["/v/two.pdf"] and raw["/v/plain.txt"] is None


def test_steps_give_the_same_rows(files):
    """Parse, errors, grouping and join one by one against the single pass."""
    parsed = docs.parse_files(docs.parsable_files(files), json_parser)
    none = F.lit(None).cast("string")
    steps = (
        docs.with_raw(docs.texts_by_path(parsed), parsed).select("path", "text", none.alias("error_status"))
        .unionByName(docs.error_documents(parsed).select("path", none.alias("text"), "error_status"))
        .unionByName(
            docs.plain_files(files).select("path", docs.utf8_text(F.col("content")).alias("text"), none.alias("error_status"))
        )
    )
    whole = documents_to_text(files, json_parser).select("path", "text", "error_status")
    assert sorted(map(repr, steps.collect())) == sorted(map(repr, whole.collect()))


def test_document_parts_keep_order_and_absent_content(files):
    parsed = docs.parse_files(docs.parsable_files(files), json_parser)
    rows = docs.document_parts(parsed).filter("path = '/v/some.jpeg'").select("idx", F.to_json("content")).collect()
    assert [tuple(r) for r in rows] == [(0, '"a"'), (1, None), (2, "null"), (3, '"b"')]


def test_repeated_paths_merge_and_multiply(spark):
    one = '{"document":{"elements":[{"content":"a"},{"content":"b"}]}}'
    two = '{"document":{"elements":[{"content":"c"}]}}'
    null = '{"document":{"elements":[{"content":null}]}}'
    rows = spark.createDataFrame([("p.pdf", one), ("p.pdf", two), ("p.pdf", null)], "path string, raw string")
    parsed = rows.select("path", F.parse_json("raw").alias("parsed"))
    texts = docs.texts_by_path(parsed)
    assert [tuple(r) for r in texts.collect()] == [("p.pdf", "a\n\nb\n\nc")]
    assert docs.with_raw(texts, parsed).count() == 3


def test_extension_rules(spark):
    paths = ["/v/A.PDF", "x", "/v/dir.v1/noext", "a.tar.gz", "trailing.", None]
    rows = spark.createDataFrame([(p,) for p in paths], "path string")
    got = [tuple(r) for r in rows.select(file_extension(F.col("path")), needs_parsing(F.col("path"))).collect()]
    assert got == [(".pdf", True), ("", False), (".v1/noext", False), (".gz", False), ("", False), (None, None)]
    rows.createOrReplaceTempView("paths")
    name = declare_parse_extensions(spark)
    assert spark.sql(f"SELECT size({name}), array_contains({name}, '.docx')").first()[:] == (8, True)


def test_bytes_that_are_not_utf8_do_not_fail(spark):
    rows = spark.createDataFrame([(bytearray(b"a\xffb"),), (bytearray("é".encode()),), (None,)], "content binary")
    assert [r[0] for r in rows.select(docs.utf8_text(F.col("content"))).collect()] == ["a�b", "é", None]


def test_first_files_with_and_without_key(spark):
    rows = spark.createDataFrame([(i, f"p{i // 3}", bytearray(b"x")) for i in range(30)], "id int, path string, content binary")
    by_key = docs.first_files(rows, 4, ("id",))
    assert sorted(r["id"] for r in by_key.collect()) == [0, 1, 2, 3]
    assert sorted(r["path"] for r in docs.first_files(rows, 4, ()).collect()) == ["p0", "p0", "p0", "p1"]


def test_first_files_counts_a_missing_path(spark):
    rows = spark.createDataFrame([(i, f"p{i}" if i else None) for i in range(9)], "id int, path string")
    for key in (("id",), ("path",), ()):
        assert sorted(r["id"] for r in docs.first_files(rows, 3, key).collect()) == [0, 1, 2]


def test_first_files_sorts_no_content(spark, tmp_path):
    rows = spark.createDataFrame([(f"p{i}", bytearray(b"x")) for i in range(9)], "path string, content binary")
    rows.write.parquet(str(tmp_path / "f"))
    plan = plan_of(docs.first_files(spark.read.parquet(str(tmp_path / "f")), 3))
    assert "Sort" not in plan and "TakeOrdered" not in plan and "Join" not in plan


@pytest.mark.parametrize("n", [0, 1, 4, 5, 8, 100])
def test_first_files_never_returns_more_than_asked_for(spark, n):
    rows = spark.createDataFrame([(f"p{i % 2}", i) for i in range(8)], "path string, id int")
    found = [r["path"] for r in docs.first_files(rows, n).collect()]
    assert sorted(found) == sorted(["p0"] * 4 + ["p1"] * 4)[:n]


def test_spread_splits_a_path_that_many_rows_share(spark):
    path = F.when(F.col("id") % 3 == 0, "/v/hot").when(F.col("id") % 3 == 1, F.concat(F.lit("/v/"), "id"))
    rows = spark.range(9_000).select(path.alias("path"), "id")
    sizes = [r["count"] for r in docs.spread(rows, 16).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 6_000 and max(sizes) < 2 * 6_000 / 16


def test_texts_of_documents_that_share_a_path_stay_apart(spark):
    content = '{"document":{"elements":[{"content":"%s"}]}}'
    rows = spark.createDataFrame([(i, "/v/a.pdf", content % i) for i in range(50)], "id int, path string, content string")
    parsed = docs.parse_files(rows.withColumn("content", F.col("content").cast("binary")), json_parser, "id", "path")
    texts = docs.document_texts(parsed, "id", "path").select("id", "text").collect()
    assert {r["id"]: r["text"] for r in texts} == {i: str(i) for i in range(50)}


def test_extensions_can_be_chosen(spark, files):
    assert [r["path"] for r in docs.parsable_files(files, (".TXT",)).select("path").orderBy("path").collect()] == ["/v/nothing.txt", "/v/plain.txt"]
    plain = documents_to_text(files.filter("path = '/v/two.pdf'"), json_parser, extensions=(".html",)).first()
    assert plain["text"].startswith("{") and plain["raw_parsed"] is None
    name = declare_parse_extensions(spark, "own_extensions", (".HTML", ".o'x"))
    assert spark.sql(f"SELECT array_contains({name}, '.html'), array_contains({name}, ?)", args=[".o'x"]).first()[:] == (True, True)


def test_one_parse_one_scan_no_hidden_shuffle(spark, files, tmp_path):
    files.write.parquet(str(tmp_path / "files"))
    stored = spark.read.parquet(str(tmp_path / "files"))
    plan = plan_of(documents_to_text(stored, json_parser))
    assert plan.count("parse_json") + plan.count("parseJson") == 1
    assert plan.count("FileScan") == 1
    assert "Exchange" not in plan and "Join" not in plan and "Aggregate" not in plan
    spread = plan_of(documents_to_text(stored, json_parser, buckets=4))
    below = spread[spread.index("Exchange"):]
    assert "parseJson" not in below and "parse_json" not in below


def test_limit_and_buckets_keep_the_rows(spark, files):
    named = files.filter("path IS NOT NULL AND content IS NOT NULL")
    n = named.count()
    whole = documents_to_text(named, json_parser).count()
    assert documents_to_text(named, json_parser, limit=n, buckets=3).count() == whole
    assert documents_to_text(named, json_parser, limit=1).select("path").first()[0] == "/v/a.pdf.bak"


def test_table_is_created_and_replaced(spark, files, pipeline_config):
    name = pipeline_config.table("texts")
    for limit in (3, None):
        replace_table(documents_to_text(files.filter("path like '%txt'"), json_parser, limit=limit), name)
    rows = table_by_parameter(spark, name)
    assert sorted(r["path"] for r in rows.collect()) == ["/v/nothing.txt", "/v/plain.txt"]
    assert rows.schema["raw_parsed"].dataType.simpleString() == "variant"
    assert preview(spark, name, 1).count() == 1


def test_parser_options(spark):
    options = spark.range(1).select(docs.parse_options("/out").alias("o")).first()["o"]
    assert options == {"version": "2.0", "descriptionElementTypes": "*", "imageOutputPath": "/out"}
