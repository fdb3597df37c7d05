"""Segments of a message in the order they were written, each with the claim it belongs to.

A VARIANT forgets the order of elements of different names: the second ``S_11``
may belong to the second, third or any later ``S_07``. Here the order of the
text's elements decides.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.functions.variants import evaluated_once, is_readable_xml, xml_to_variant
from segflow.operators.sections import REQUEST_SECTION

# What tasks run travels with the plan, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Fixed value: the request segment that begins a claim.
CLAIM_SEGMENT = "S_07"
#: Characters of segments that a task hands on at a time.
_CHARS = 8 << 20


def claim_segments(
    texts: DataFrame, *keys: str, section: str = REQUEST_SECTION, anchor: str = CLAIM_SEGMENT, value: str = "value"
) -> DataFrame:
    """`keys`, `claim`, `segment`, `label` and `value` of each segment of a section, one row for each occurrence.

    `claim` numbers the `anchor` segments: a segment belongs to the last anchor written before it, those
    before the first anchor to claim 0. So a claim without some segment does not shift those after it.
    `label` is the segment's order label, its place among the elements of each level down from the
    root ("2.14" is the 14th element of the root's second one), and `value` its content as a VARIANT.
    Each message is read once, where its row is: nothing is shuffled. Texts that are null or not well-formed, and
    sections that are absent, give no rows.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for i, text in enumerate(batch.column(batch.num_columns - 1)):
                if text.as_py() is None:
                    continue
                try:
                    root = ElementTree.fromstring(text.as_py())
                except (ElementTree.ParseError, ValueError):
                    continue
                claim = 0
                for at, part in enumerate(root, 1):
                    for place, segment in enumerate(part if part.tag == section else (), 1):
                        claim += segment.tag == anchor
                        segment.tail = None
                        rows.append((i, claim, segment.tag, f"{at}.{place}", ElementTree.tostring(segment, "unicode")))
                        held += len(rows[-1][-1])
                if held >= _CHARS:
                    yield with_rows(batch, rows)
                    rows, held = [], 0
            if rows:
                yield with_rows(batch, rows)

    def with_rows(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        index, *found = zip(*rows)
        taken = batch.take(pa.array(index))
        types = (pa.int32(), pa.string(), pa.string(), pa.string())
        columns = [*taken.columns[:-1], *(pa.array(c, t) for c, t in zip(found, types))]
        return pa.RecordBatch.from_arrays(columns, [*carried, "claim", "segment", "label", "xml"])

    # Only what Spark's own parser accepts counts as well-formed.
    text = F.when(is_readable_xml(F.col(value)), F.col(value)).alias("text")
    carried = [f"key{i}" for i in range(len(keys))]
    source = texts.select(*[F.col(k).alias(c) for k, c in zip(keys, carried)], text)
    columns = "".join(f"{c} {source.schema[c].dataType.simpleString()}, " for c in carried)
    rows = source.mapInArrow(cut, f"{columns}claim int, segment string, label string, xml string")
    content = evaluated_once(xml_to_variant(F.col("xml"))).alias("value")
    return rows.select(*[F.col(c).alias(k) for c, k in zip(carried, keys)], "claim", "segment", "label", content)
