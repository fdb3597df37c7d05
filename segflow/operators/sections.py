"""Flattening the sections of a message into rows.

``explode_members`` turns a VARIANT into rows: an object gives one row per
member in name order, an array one row per entry with a NULL key, and anything
else, also an absent section, one row of NULLs. A segment that occurs once
therefore yields field rows and a repeated one occurrence rows. All of it is a
narrow Generate; nothing is shuffled, in batch or in a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.functions.variants import member

# Section and id names in the message tables.
REQUEST_SECTION = "NcpdpRequest"
RESPONSE_SECTION = "NcpdpResponse"
SUPPLEMENTAL_SECTION = "Supplemental"
MESSAGE_ID = "transaction_file_source_id"


def explode_members(rows: DataFrame, column: str, pos: str, key: str, value: str) -> DataFrame:
    """Append the members of a VARIANT column as ``pos``, ``key`` and ``value`` columns, outer."""
    members = rows.sparkSession.tvf.variant_explode_outer(F.col(column).outer()).toDF(pos, key, value)
    return rows.lateralJoin(members)


def _one_section(variants: DataFrame, section: str, carried: list[str]) -> DataFrame:
    """The section beside the carried columns.

    Selected on its own, right above the scan, it can be extracted by the scan:
    the rest of a message is then neither decoded nor carried along.
    """
    return variants.select(*carried, member(F.col("messages"), section).alias("section"))


def section_fields(
    variants: DataFrame, section: str, *, keys: tuple[str, ...] = (MESSAGE_ID,), keep_messages: bool = True
) -> DataFrame:
    """One level: a row per child of the section; nested children stay VARIANT.

    ``keep_messages=False`` leaves the whole message out of every row, which at
    scale is most of the bytes written.
    """
    carried = [*keys, "messages"] if keep_messages else list(keys)
    found = _one_section(variants, section, carried)
    return explode_members(found, "section", "pos", "key", "value").select(*carried, "pos", "key", "value")


def section_segments(
    variants: DataFrame,
    section: str,
    prefix: str,
    *,
    keys: tuple[str, ...] = (MESSAGE_ID,),
    keep_messages: bool = True,
) -> DataFrame:
    """Two levels: segments of the section, then the fields or occurrences of each."""
    carried = [*keys, "messages"] if keep_messages else list(keys)
    pos, segment = f"{prefix}_pos", f"{prefix}_segment"
    found = _one_section(variants, section, carried)
    segments = explode_members(found, "section", pos, segment, "segment_value").drop("section")
    fields = explode_members(segments, "segment_value", "pos", "key", "value")
    return fields.select(*carried, pos, segment, "pos", "key", "value")


def requests(variants: DataFrame, **options) -> DataFrame:
    return section_segments(variants, REQUEST_SECTION, "request", **options)


def responses(variants: DataFrame, **options) -> DataFrame:
    return section_segments(variants, RESPONSE_SECTION, "response", **options)


def supplemental(variants: DataFrame, **options) -> DataFrame:
    return section_fields(variants, SUPPLEMENTAL_SECTION, **options)
