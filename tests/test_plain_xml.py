import random

import pytest
from pyspark.sql import functions as F

from segflow.functions.plain_xml import BYTES_AT_MOST, NotPlain, PlainXml, plain_json, value_json
from segflow.functions.variants import _ENDLESS_NUMBER, _parsed_as_text, is_readable_xml, xml_to_variant

VALUES = [
    "", "", "x", "A", "007", "7", "-7", "-0", "0", "00", "+5", "--5", "-", ".", "5.", ".5", "0.5", "-0.50", "90.000", "007.5", "1,234", "1,2.5",
    "123456789012345678", "1234567890123456789", "9223372036854775807", "9223372036854775808", "12345678901234567890123456789.123456789012345678901",
    "0.123456789012345678", "1.1234567890123456789012345678901234567890", "true", "TRUE", "False", "false", "truth", "NaN", "Infinity", "1e3", "1E-3", "1e50",
    "e", "E5", "5E", "1d", "0x1F", "1_000", "1998-02-06", "1998-02-06T00:00:00", "12-", "1-2-3-4-5-6", "2-3", "x &amp; y", "&lt;b&gt;", "&quot;1&quot;", "&amp;amp;",
    "&apos;", "&#65;", "&foo;", "&", "a > b", "]]>", " x", "x ", " ", "\n", "\t5", "5 5", "a\nb", "a\rb", "\xa0", "\xa05", "é", "münchen", "٣", "٣.٥", "x٣", "漢字",
    " ", "\x85", "�", "\U0001f600", "ſ", "K", 'lot "7E1234567" held', "7E1234567", "'1e0012345678'", "[1E99999999]", "100%", "%s", "%d%", "back\\slash", 'quo"te', "/", "5" * 70, "word " * 30 + "end",
]
NAMES = ["a", "b", "S_07", "F_526_FQ.1", "c-d", "_e", "B", "x1", "é", "a:b", "1a", "a b='1'", "true", "a" * 210]


def random_xml(rng: random.Random) -> str:
    def value():
        return rng.choice(VALUES) if rng.random() < 0.1 else rng.choice(["x", "7", "D0", "QTY 5", "12.25", "1998-02-06", ""])

    def name():
        return rng.choice(NAMES[:6]) if rng.random() < 0.97 else rng.choice(NAMES)

    def space():
        return rng.choice(["", "", "", "", " ", "\n  ", "\t"]) if rng.random() < 0.98 else rng.choice(["t", "<!-- c -->", "\r\n", "<?p i?>", "\xa0", "<![CDATA[q]]>"])

    def element(depth):
        n = name()
        kind = rng.random()
        if kind < 0.08:
            return f"<{n}/>"
        if kind < 0.6 or depth > 4:
            return f"<{n}>{value()}</{n if rng.random() < 0.995 else name()}>"
        inside = space() + "".join(element(depth + 1) + space() for _ in range(rng.randint(1, 4)))
        return f"<{n}>{inside}</{n}>"

    start = rng.choice(["", "", '<?xml version="1.0" encoding="utf-8"?>', '<?xml version="1.0"?>\n', " \n", ' <?xml version="1.0"?>', "<!DOCTYPE M>", "﻿"])
    body = "".join(element(0) + space() for _ in range(rng.randint(1, 4)))
    return start + rng.choice([f"<M>{body}</M>", f"<M>{body}</M>", f"<M>{space()}{body}</M>\n", body, f"<M>{body}</M><M/>", f"<M>{body}</M>x"])


def test_the_same_values_as_by_sparks_parser(spark):
    """Of random texts, of which many are plain: JSON and types equal, and malformed ones are left alone."""
    rng = random.Random(11)
    texts = [f"<M><v>{v}</v><a>{v}</a></M>" for v in VALUES] + [random_xml(rng) for _ in range(6_000)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string").repartition(8)
    by_spark = F.transform(
        F.array("value"),
        lambda doc: F.when(is_readable_xml(doc), F.when(doc.rlike(_ENDLESS_NUMBER), _parsed_as_text(doc)).otherwise(F.from_xml(doc, "VARIANT"))),
    )[0]
    both = rows.select("i", "value", plain_json(F.col("value")).isNotNull().alias("plain"), by_spark.alias("a"), xml_to_variant(F.col("value")).alias("b"))
    seen = both.select("i", "value", "plain", *[f(c) for c in "ab" for f in (F.to_json, F.schema_of_variant)]).collect()
    assert [r for r in seen if tuple(r[3:5]) != tuple(r[5:7])] == []
    plain = [r for r in seen if r["plain"]]
    assert len(plain) > 1_000 and len(seen) - len(plain) > 1_000 and len(seen) == len(texts)
    assert all(r[3] is not None for r in plain)


@pytest.mark.parametrize("value, expected", [("", "null"), ("007", "7"), ("-0", "0"), ("90.000", "90.000"), ("x &amp; y", '"x & y"'), ("1998-02-06", '"1998-02-06"')])
def test_value_json(value, expected):
    assert value_json(value) == expected


@pytest.mark.parametrize("value", ["1e3", "+5", "007.5", "٣", " x", "TRUE", "&#65;", "&foo;", "&", "a>b", "<", "7E1234567", "x\r", "x\x85", "x\x00", "1" * 19])
def test_uncertain_values_are_left_to_spark(value):
    assert PlainXml().json("<M><a>x</a></M>") == '{"a":"x"}'
    with pytest.raises(NotPlain):
        PlainXml().json(f"<M><a>{value}</a></M>")


def test_messages_are_plain_and_read_without_sparks_parser(spark):
    from segflow.plans.workload import customer_messages, order_messages

    for messages in (order_messages, customer_messages):
        found = messages(spark, "/root/testdata/sf0.001").select(plain_json(F.col("value")).isNull().alias("slow"))
        assert found.filter("slow").count() == 0


def test_long_texts_and_bytes_that_are_no_text_are_left_to_spark(spark):
    long = f"<M><a>{'x' * BYTES_AT_MOST}</a></M>"
    rows = spark.createDataFrame([(bytearray(b"<M><a>\xff\xfe</a></M>"),), (bytearray(long.encode()),), (None,)], "value binary")
    found = rows.select(F.col("value").cast("string").alias("value"))
    assert [r[0] for r in found.select(plain_json(F.col("value"))).collect()] == [None, None, None]
    assert [r[0] for r in found.select(xml_to_variant(F.col("value")).isNull()).collect()] == [False, False, True]


def test_a_reader_forgets_shapes_and_values(monkeypatch):
    from segflow.functions import plain_xml

    monkeypatch.setattr(plain_xml, "_TAGS", 40)
    monkeypatch.setattr(plain_xml, "_VALUES", 3)
    reader = PlainXml()
    for i in range(200):
        tags = "".join(f"<t{j}>{i}{j}</t{j}>" for j in range(i % 7 + 1))
        inside = ",".join(f'"t{j}":{int(f"{i}{j}")}' for j in range(i % 7 + 1))
        assert reader.json(f"<M>{tags}</M>") == "{" + inside + "}"
        assert len(reader.values) <= 3 and reader.tags <= 40
