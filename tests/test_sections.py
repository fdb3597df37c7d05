import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from samples import FILLED, REPEATED, SINGLE
from segflow.operators.messages import to_variant
from segflow.operators.sections import requests, responses, supplemental

ID = "transaction_file_source_id"


def variants(spark, *texts):
    rows = [(str(i), t) for i, t in enumerate(texts)]
    return to_variant(spark.createDataFrame(rows, f"{ID} string, value string"))


def section(inner, name="NcpdpRequest"):
    return f"<M><{name}>{inner}</{name}></M>"


@pytest.mark.parametrize(
    "text, expected",
    [(SINGLE, (44, 29, 7)), (REPEATED, (44, 34, 7)), (FILLED, (80, 38, 7))],
    ids=["single", "repeated", "filled"],
)
def test_row_counts_of_practical_shapes(spark, text, expected):
    v = variants(spark, text)
    assert (requests(v).count(), responses(v).count(), supplemental(v).count()) == expected


def test_rows_per_segment_follow_its_grain(spark):
    rows = requests(variants(spark, SINGLE, REPEATED)).groupBy(ID, "request_segment").count().collect()
    counts = {(r[0], r[1]): r[2] for r in rows}
    assert counts[("0", "S_07")] == 14
    assert counts[("1", "S_07")] == 4
    assert counts[("1", "S_01")] == 12


def test_columns(spark):
    v = variants(spark, SINGLE)
    assert requests(v).columns == [ID, "messages", "request_pos", "request_segment", "pos", "key", "value"]
    assert responses(v).columns == [ID, "messages", "response_pos", "response_segment", "pos", "key", "value"]
    assert supplemental(v).columns == [ID, "messages", "pos", "key", "value"]
    assert requests(v, keep_messages=False).columns == [ID, "request_pos", "request_segment", "pos", "key", "value"]


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns, F.to_json("value")).collect()]


def test_positions_are_in_name_order(spark):
    text = section("<S_HD><b>1</b><a>x</a></S_HD><S_01><z>2</z></S_01>")
    found = rows_of(requests(variants(spark, text)), "request_pos", "request_segment", "pos", "key")
    assert found == [(0, "S_01", 0, "z", "2"), (1, "S_HD", 0, "a", '"x"'), (1, "S_HD", 1, "b", "1")]


def test_repeated_segment_gives_occurrences_in_document_order(spark):
    text = section("<S_07><n>2</n></S_07><S_11><p>7</p></S_11><S_07><n>1</n></S_07>")
    found = rows_of(requests(variants(spark, text)), "request_segment", "pos", "key")
    assert found == [("S_07", 0, None, '{"n":2}'), ("S_07", 1, None, '{"n":1}'), ("S_11", 0, "p", "7")]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("<M><Other>1</Other></M>", [(None, None, None, None, None)]),
        (section("<S_05/>"), [(0, "S_05", None, None, None)]),
        (section("<S_05>x</S_05>"), [(0, "S_05", None, None, None)]),
        (section(""), [(None, None, None, None, None)]),
        ("<M>", [(None, None, None, None, None)]),
        ("", [(None, None, None, None, None)]),
        (None, [(None, None, None, None, None)]),
    ],
    ids=["no section", "empty segment", "scalar segment", "empty section", "malformed", "empty", "null"],
)
def test_outer_rows(spark, text, expected):
    found = rows_of(requests(variants(spark, text)), "request_pos", "request_segment", "pos", "key")
    assert found == expected


def test_dotted_field_names_and_nested_children(spark):
    text = "<M><Supplemental><Store><City>D</City></Store><F.1>a</F.1><F.2>b</F.2></Supplemental></M>"
    found = rows_of(supplemental(variants(spark, text)), "pos", "key")
    assert found == [(0, "F.1", '"a"'), (1, "F.2", '"b"'), (2, "Store", '{"City":"D"}')]


def test_flattening_does_not_shuffle_and_reads_one_section(spark, tmp_path):
    variants(spark, SINGLE, REPEATED).write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    plan = plan_of(requests(stored, keep_messages=False))
    assert "Exchange" not in plan
    assert plan.count("Generate variant_explode") == 2
    assert "variant_get(" not in plan.replace("AS variant_get(", "")
    assert "messages:struct<0:variant>" in plan


def test_random_messages_against_brute_force(spark):
    """Random segments, repeats and empties, flattened in plain Python and by Spark."""
    rng = random.Random(11)

    def random_message():
        names = rng.sample(["S_HD", "S_01", "S_07", "S_11", "S_23", "Z"], rng.randint(0, 6))
        segments = [
            (name, {f"F_{rng.randint(1, 30)}.{rng.randint(1, 2)}": rng.choice(["7", "ab", ""]) for _ in range(rng.randint(0, 4))})
            for name in names
            for _ in range(rng.choice([1, 1, 2, 5]))
        ]
        rng.shuffle(segments)
        return segments

    def xml(message):
        inner = "".join(f"<{s}>{''.join(f'<{k}>{v}</{k}>' for k, v in f.items())}</{s}>" for s, f in message)
        return section(inner)

    def scalar(text):
        return None if text == "" else int(text) if text.isdigit() else text

    def flat(message):
        if not message:
            return [(None, None, None, None, None)]
        rows, grouped = [], {}
        for name, found in message:
            grouped.setdefault(name, []).append({k: scalar(v) for k, v in found.items()} or None)
        for at, name in enumerate(sorted(grouped)):
            occurrences = grouped[name]
            if len(occurrences) > 1:
                rows += [(at, name, i, None, o) for i, o in enumerate(occurrences)]
            elif occurrences[0] is None:
                rows.append((at, name, None, None, None))
            else:
                rows += [(at, name, i, k, occurrences[0][k]) for i, k in enumerate(sorted(occurrences[0]))]
        return rows

    messages = [random_message() for _ in range(400)]
    found = requests(variants(spark, *map(xml, messages)), keep_messages=False).select("*", F.to_json("value").alias("json"))
    expected = Counter((str(i), *row[:4], json.dumps(row[4], sort_keys=True)) for i, m in enumerate(messages) for row in flat(m))
    got = Counter(
        (r[0], r[1], r[2], r[3], r[4], json.dumps(json.loads(r["json"] or "null"), sort_keys=True)) for r in found.collect()
    )
    assert got == expected


def test_response_rows_do_not_carry_whole_messages(spark):
    """The key is read once for a message, below the rows of its segments: F3."""
    from segflow.plans.queries import response_segments

    rows = response_segments(spark, "/root/testdata/sf0.001")
    assert rows.columns == [ID, "response_pos", "response_segment", "pos", "key", "value", "message_key"]
    generates = [line for line in plan_of(rows).splitlines() if "Generate" in line]
    assert len(generates) == 2 and not any("messages#" in line for line in generates)
