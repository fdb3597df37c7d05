import json
import random
from collections import Counter
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import plan_of
from samples import FILLED, REPEATED, SINGLE
from test_plain_xml import VALUES, random_xml
from segflow.functions.variants import is_readable_xml
from segflow.operators import typed
from segflow.operators.claims import claim_segments
from segflow.operators.typed import learned_schema, merged_evidence, path_evidence, typed_message


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id long, value string").repartition(3)


def parsed(spark, *values, schema=None):
    rows = texts(spark, *values)
    schema = schema or learned_schema(path_evidence(rows))
    found = rows.select("id", F.to_json(typed_message(F.col("value"), schema)).alias("j")).orderBy("id").collect()
    return schema, [r["j"] and json.loads(r["j"]) for r in found]


def test_codes_keep_their_zeros_and_what_repeats_is_a_list(spark):
    schema, rows = parsed(
        spark,
        "<M><S><c>007</c><n>12</n><d>2.50</d></S><one><x>1</x></one></M>",
        "<M><S><c>12</c><n>-3</n><d>10.1</d></S><S><c>1</c><n>4</n></S></M>",
        None,
        "<M><S>",
        "",
    )
    assert schema.simpleString() == "struct<S:array<struct<c:string,d:decimal(4,2),n:bigint>>,one:struct<x:bigint>>"
    assert rows[0] == {"S": [{"c": "007", "d": 2.5, "n": 12}], "one": {"x": 1}}
    assert rows[1] == {"S": [{"c": "12", "d": 10.1, "n": -3}, {"c": "1", "n": 4}]}
    assert rows[2:] == [None, None, None]


@pytest.mark.parametrize(
    "values, wanted",
    [
        (["1", "20"], "bigint"),
        (["0", "5"], "bigint"),
        (["1", "x"], "string"),
        (["+1"], "string"),
        (["1e3"], "string"),
        (["true"], "string"),
        (["1" * 18], "bigint"),
        (["1" * 19], "string"),
        (["0.5", "12"], "decimal(3,1)"),
        (["00.5"], "string"),
        (["", " "], "string"),
        (["", "3"], "bigint"),
        ([" 7 "], "bigint"),
    ],
)
def test_types_come_from_all_values(spark, values, wanted):
    rows = texts(spark, *[f"<M><v>{v}</v></M>" for v in values])
    assert learned_schema(path_evidence(rows))["v"].dataType.simpleString() == wanted


def test_attributes_mixed_text_names_with_dots_and_empty_elements(spark):
    _, rows = parsed(spark, '<M a="01"><v b="x">t</v><F_526_FQ.1>QTY 1 &amp; 2</F_526_FQ.1><e/></M>', "<M><v b='y'/><e>5</e></M>")
    assert rows[0] == {"_a": "01", "v": {"_b": "x", "_VALUE": "t"}, "F_526_FQ.1": "QTY 1 & 2"}
    assert rows[1] == {"v": {"_b": "y"}, "e": 5}


def test_practical_messages_and_evidence_in_parts(spark):
    whole = learned_schema(path_evidence(texts(spark, SINGLE, REPEATED, FILLED)))
    parts = merged_evidence(*[path_evidence(texts(spark, t)) for t in (SINGLE, REPEATED, FILLED)])
    assert learned_schema(parts) == whole
    _, rows = parsed(spark, SINGLE, REPEATED, schema=whole)
    assert [len(r["NcpdpRequest"]["S_07"]) for r in rows] == [1, 4] and len(rows[0]["NcpdpRequest"]["S_07"][0]) == 14
    assert isinstance(rows[0]["NcpdpRequest"]["S_HD"], dict) and rows[0]["Supplemental"]["Drug"]["UnitPrice"] == 2.71828
    _, unknown = parsed(spark, "<M><new>1</new></M>", schema=whole)
    assert unknown == [{}]


def test_deep_messages_and_none_at_all(spark):
    deep = "<M>" + "<a>" * 300 + "1" + "</a>" * 300 + "</M>"
    assert path_evidence(texts(spark, deep)).count() == 300
    empty = path_evidence(texts(spark, None, "<broken"))
    assert empty.count() == 0 and learned_schema(empty).fields == []
    assert parsed(spark, "<M/>", schema=learned_schema(empty))[1] == [None]


def segments(spark, *values, **options):
    rows = claim_segments(texts(spark, *values), "id", **options)
    return Counter((r["id"], r["claim"], r["segment"], r["label"], r["value"] and json.dumps(json.loads(r["value"]))) for r in rows.withColumn("value", F.to_json("value")).collect())


def test_a_claim_without_a_segment_does_not_shift_the_next(spark):
    text = "<M><X/><NcpdpRequest><S_HD><h>1</h></S_HD><S_07><n>1</n></S_07><S_07><n>2</n></S_07><S_11><p>b</p></S_11> <S_07><n>3</n></S_07><S_11/></NcpdpRequest></M>"
    assert segments(spark, text) == Counter(
        [
            (0, 0, "S_HD", "2.1", '{"h": 1}'),
            (0, 1, "S_07", "2.2", '{"n": 1}'),
            (0, 2, "S_07", "2.3", '{"n": 2}'),
            (0, 2, "S_11", "2.4", '{"p": "b"}'),
            (0, 3, "S_07", "2.5", '{"n": 3}'),
            (0, 3, "S_11", "2.6", "null"),
        ]
    )


def test_segments_of_practical_and_odd_texts(spark):
    found = segments(spark, SINGLE, REPEATED, None, "", "<M><NcpdpRequest>", "<M/>", "<M><NcpdpRequest/></M>", SINGLE[:-3])
    assert {r[0] for r in found} == {0, 1}
    assert Counter(r[1] for r in found.elements() if r[0] == 1) == {0: 3, 1: 4, 2: 4, 3: 4, 4: 4}
    answers = segments(spark, REPEATED, section="NcpdpResponse", anchor="S_21")
    assert {r[1] for r in answers} == {0, 1, 2, 3, 4}
    assert "Exchange" not in plan_of(claim_segments(spark.range(1).select("id", F.lit(SINGLE).alias("value")), "id"))


def test_equal_texts_and_equal_families_are_looked_at_once(monkeypatch):
    """What a task looks at grows with the kinds of values and of parents, not with the elements (F24)."""
    looked = Counter()
    number = typed._NUMBER
    monkeypatch.setattr(typed, "_NUMBER", lambda text: looked.update([text]) or number(text))
    evidence = typed._Evidence()
    for _ in range(500):
        evidence.message(ElementTree.fromstring("<M><S><c>007</c><n> 12 </n></S><S a='5'><c>x</c>t</S><e/></M>"))
    evidence.count()
    found = {path.path: path.seen for path in evidence.paths}
    assert looked["007"] == looked["12"] == looked["x"] == 1
    assert found[("S",)] | {"occurrences": 1000, "parents": 1000, "most": 2, "texts": 0} == found[("S",)]
    assert found[("S", "c")] | {"occurrences": 1000, "texts": 1000, "not_numbers": 500, "codes": 500, "most": 1} == found[("S", "c")]
    assert found[("S", "_a")]["occurrences"] == found[("S", "_VALUE")]["not_numbers"] == found[("e",)]["occurrences"] == 500


def test_evidence_is_the_same_however_often_it_is_counted(monkeypatch):
    texts = ["<M>" + "<S><c>01</c><c>2.5</c></S>" * n + " t </M>" for n in range(6)]
    counted = []
    for waiting in (1, 5, 1_000_000):
        monkeypatch.setattr(typed, "_WAITING_AT_MOST", waiting)
        evidence = typed._Evidence()
        for text in texts:
            evidence.message(ElementTree.fromstring(text))
        evidence.count()
        counted.append({path.path: path.seen for path in evidence.paths})
    assert counted[0] == counted[1] == counted[2]
    assert counted[0][("S", "c")]["occurrences"] == 30 and counted[0][("S",)]["most"] == 5


def test_typed_claims_parse_each_message_once(spark):
    """The parse is not copied into the filter that Spark makes of posexplode, nor for each field that is read: F5."""
    plan = plan_of(registered_query("typed_claims")(spark, "/root/testdata/sf0.001"))
    parses = [line for line in plan.splitlines() if "from_xml(" in line]
    assert len(parses) == 1 and "Filter" not in parses[0] and parses[0].count("from_xml(StructField(Ncpdp") == 1


def registered_query(name):
    from segflow.plans.queries import QUERIES

    return QUERIES[name]


def test_evidence_of_plain_texts_is_that_of_their_elements():
    """Texts cut at their tags tell what parsed elements tell, whatever stands in them: F5."""
    rng = random.Random(3)
    told = [SINGLE, REPEATED, FILLED, *[f"<M><v>{v}</v><a><v>{v}</v></a></M>" for v in VALUES], *[random_xml(rng) for _ in range(800)]]
    by_text, by_element = typed._Evidence(), typed._Evidence()
    for text in told:
        by_text.text(text)
        try:
            by_element.message(ElementTree.fromstring(text))
        except (ElementTree.ParseError, ValueError):
            continue
    for evidence in (by_text, by_element):
        evidence.count()
    assert len(by_text.plain.shapes) > 100
    assert {p.path: p.seen for p in by_text.paths} == {p.path: p.seen for p in by_element.paths}
    assert by_text.top.seen == by_element.top.seen


def test_one_parse_finds_what_a_check_and_a_parse_find(spark):
    rng = random.Random(4)
    told = [f"<M><a>{v}</a><b><c-d>{v}</c-d></b></M>" for v in VALUES] + [random_xml(rng) for _ in range(500)] + [None, ""]
    schema = StructType.fromDDL("`a` BIGINT, `A` STRING, `b` STRUCT<`c-d`: DECIMAL(3,1), `F_526_FQ.1`: STRING>, `S_07` ARRAY<BIGINT>, `_e` STRING")
    checked = F.when(is_readable_xml(F.col("value")), F.from_xml("value", schema))
    both = texts(spark, *told).select("value", F.to_json(checked).alias("a"), F.to_json(typed_message(F.col("value"), schema)).alias("b")).collect()
    assert [r for r in both if r["a"] != r["b"]] == []
    assert len({r["a"] for r in both}) > 50 and sum(r["a"] is None for r in both) > 50
