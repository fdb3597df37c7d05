import json

import pytest
from pyspark.sql import functions as F

from segflow.functions.parsers import html_parser, html_result
from segflow.operators import documents as docs


def contents(html):
    return [e["content"] for e in json.loads(html_result(html.encode(), "2.0"))["document"]["elements"]]


def test_blocks_inline_entities_and_silent_elements():
    html = (
        "<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var x='<p>no</p>'</script></head>"
        "<body><!-- no --><h1>Head</h1><p>one <b>bold</b>\n text<br>next<p>unclosed<ul><li>a</li><li></li></ul>tail</body>"
    )
    assert contents(html) == ["T & t", "Head", "one bold text", "next", "unclosed", "a", "tail"]


def test_odd_input():
    assert html_result(None, "2.0") is None
    assert contents("") == []
    assert contents("plain") == ["plain"]
    broken = json.loads(html_result(b"\xff<p>x</p>", "2.0"))
    assert broken["error_status"] is None and broken["document"]["elements"][-1]["content"] == "x"


def test_failure_becomes_an_error_status(monkeypatch):
    from segflow.functions import parsers

    def explode(self, data):
        raise ValueError("boom")

    monkeypatch.setattr(parsers._Blocks, "feed", explode)
    assert json.loads(html_result(b"x", "2.0"))["error_status"] == "ValueError: boom"


def test_parser_in_a_plan(spark):
    rows = spark.createDataFrame(
        [("a.html", bytearray(b"<p>x</p><p>y</p>")), ("b.html", None)], "path string, content binary"
    )
    parsed = docs.parse_files(rows, html_parser)
    got = parsed.select(
        "path", docs.join_contents(docs.part_contents(F.col("parsed"))), F.col("parsed").isNull()
    ).collect()
    assert [tuple(r) for r in got] == [("a.html", "x\n\ny", False), ("b.html", None, True)]


@pytest.mark.parametrize("content", [b"%PDF-1.4 text", b"PK\x03\x04doc", b"\x89PNG\r\n", b"<p>a\x00b</p>"])
def test_bytes_of_another_kind_give_an_error(content):
    result = json.loads(html_result(content, "2.0"))
    assert result["document"]["elements"] == [] and "not HTML" in result["error_status"]


def test_byte_order_marks():
    for encoding in ("utf-16", "utf-8-sig"):
        result = json.loads(html_result("<p>é</p>".encode(encoding), "2.0"))
        assert [e["content"] for e in result["document"]["elements"]] == ["é"] and result["error_status"] is None
