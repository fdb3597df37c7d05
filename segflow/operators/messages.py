"""Message text to VARIANT."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.functions.variants import evaluated_once, is_readable_xml, xml_to_variant

# Outcomes of a text: every text has a row among the parsed ones, one that is not well-formed is also set aside.
PARSED, MALFORMED = "parsed", "malformed"


def to_variant(texts: DataFrame, value: str = "value") -> DataFrame:
    """Replace the XML text column by ``messages``; malformed text gives NULL."""
    return texts.withColumn("messages", xml_to_variant(F.col(value))).drop(value)


def malformed(texts: DataFrame, value: str = "value") -> DataFrame:
    """Rows with text that cannot be parsed: the ones whose ``messages`` is NULL.

    The ingested table keeps every text, so this finds them there at any time.
    """
    return texts.filter(F.col(value).isNotNull() & ~is_readable_xml(F.col(value)))


def by_outcome(texts: DataFrame, value: str = "value", outcome: str = "_outcome") -> DataFrame:
    """The rows of both functions above from one parse, told apart by ``outcome``.

    A malformed text has a row of each kind: one with NULL ``messages``, one with its text.
    """
    text, messages = F.col(value), F.col("messages")
    kinds = F.when(text.isNotNull() & messages.isNull(), F.array(F.lit(PARSED), F.lit(MALFORMED))).otherwise(F.array(F.lit(PARSED)))
    parsed = texts.withColumn("messages", evaluated_once(xml_to_variant(text)))
    rows = parsed.withColumn(outcome, F.explode(kinds))
    return rows.withColumn(value, F.when(F.col(outcome) == MALFORMED, text))
