import random

import pytest
from pyspark.sql import functions as F

from samples import FILLED, SINGLE
from segflow.functions.variants import is_readable_xml, member, member_list, member_path, member_text, xml_to_variant
from segflow.operators.messages import malformed, to_variant


def as_json(spark, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    return [r[0] for r in rows.orderBy("i").select(F.to_json(xml_to_variant(F.col("value")))).collect()]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("<M><a>007</a></M>", '{"a":7}'),
        ("<M><a>90.000</a></M>", '{"a":90}'),
        ("<M><a>true</a></M>", '{"a":true}'),
        ("<M><a>2026-11-18</a></M>", '{"a":"2026-11-18"}'),
        ("<M><a/><b></b></M>", '{"a":null,"b":null}'),
        ("<M><a>x &amp; y</a></M>", '{"a":"x & y"}'),
        ('<M><a k="1">t</a></M>', '{"a":{"_VALUE":"t","_k":1}}'),
        ("<M><a>1</a><b>2</b><a>3</a></M>", '{"a":[1,3],"b":2}'),
        ("<M><F.1>x</F.1></M>", '{"F.1":"x"}'),
        ("<M><a>12345678901234567890</a></M>", '{"a":12345678901234567890}'),
        ("  <M><a>1</a></M>  ", '{"a":1}'),
        ("<M><a>1e3</a><b>1e50</b><c>AB1e12345678</c></M>", '{"a":1000,"b":"1e50","c":"AB1e12345678"}'),
        ("<M><a> -1.5E+200000000</a></M>", '{"a":"-1.5E+200000000"}'),
        ('<M><a k="1e200000000"/></M>', '{"a":{"_k":"1e200000000"}}'),
        ("<M><a><![CDATA[1e200000000]]></a></M>", '{"a":"1e200000000"}'),
        ('<M><a>batch "7E1234567" held</a><b>7E1234567</b></M>', '{"a":"batch \\"7E1234567\\" held","b":"7E1234567"}'),
        ("<M><a>1E0000012</a><b>1E00123456789</b></M>", '{"a":1000000000000,"b":"1E00123456789"}'),
        ("<M><a>7E1234567</a><b><c>1</a></M>", None),
        ("<M><a><b>1</a></M>", None),
        ("<M>", None),
        ("no markup", None),
        ("", None),
        ("   ", None),
        (None, None),
    ],
)
def test_xml_values(spark, text, expected):
    assert as_json(spark, text) == [expected]


def test_same_result_as_the_plain_parser(spark):
    rows = spark.createDataFrame([(SINGLE,), (FILLED,)], "value string")
    plain, guarded = F.to_json(F.from_xml("value", "VARIANT")), F.to_json(xml_to_variant(F.col("value")))
    assert rows.select(plain).collect() == [tuple(r) for r in rows.select(guarded).collect()]


def test_damaged_texts_never_fail_the_job(spark):
    """Random damage: the check must foresee every text the parser rejects."""
    rng = random.Random(7)
    pieces = ["<", ">", "/", "&", "&amp;", "&foo;", "&#0;", "&#65;", "<!--", "-->", "<![CDATA[", "]]>", '"', "'", "=",
              "<?x ?>", "<!DOCTYPE a [<!ENTITY e 'v'>]>", "&e;", "\x00", "\x1b", "￾", "é", "x", "1", "<!-- c -->", "<![CDATA[<q>]]>", "<z/>", "<a b='1' b='2'/>", "<a:b/>", " "]
    base = "<M k='v'><Supplemental><a>1</a><b>x &lt; y</b></Supplemental><NcpdpRequest><S_07><c/></S_07></NcpdpRequest></M>"
    texts = []
    for _ in range(4000):
        text = base
        for _ in range(rng.randint(1, 2)):
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(pieces) + text[at + rng.choice([0, 0, 0, 1]):]
        texts.append(text)
    rows = spark.createDataFrame([(t,) for t in texts], "value string").repartition(8)
    found = rows.select(
        xml_to_variant(F.col("value")).isNull().alias("failed"), is_readable_xml(F.col("value")).alias("ok")
    )
    counts = {(r[0], r[1]): r[2] for r in found.groupBy("failed", "ok").count().collect()}
    assert sum(counts.values()) == 4000
    assert counts.get((True, False), 0) > 400
    assert counts.get((False, True), 0) > 200
    assert set(counts) <= {(True, False), (False, True)}


def test_malformed_rows_are_the_ones_without_messages(spark):
    texts = spark.createDataFrame([("a", "<M><x>1</x></M>"), ("b", "<M>"), ("c", None), ("d", "")], "id string, value string")
    assert sorted(r["id"] for r in malformed(texts).collect()) == ["b", "d"]
    parsed = to_variant(texts)
    assert parsed.columns == ["id", "messages"]
    assert sorted(r["id"] for r in parsed.filter("messages IS NULL").select("id").collect()) == ["b", "c", "d"]


def test_member_access(spark):
    row = spark.sql("""SELECT parse_json('{"a":{"b.c":[1,"x"],"n":null,"o":{"k":1}}}') AS v""")
    v = F.col("v")
    got = row.select(
        member_text(v, "a", "b.c"),
        F.size(member_list(v, "a", "b.c")),
        member_list(v, "a", "o"),
        member_text(v, "a", "n"),
        member(v, "a", "n").isNotNull(),
        member(v, "a", "missing").isNull(),
        member_text(v, "A"),
    ).first()
    assert tuple(got) == ('[1,"x"]', 2, None, None, True, True, None)
    assert member_path("a", "b.c") == "$['a']['b.c']"
