"""Building and reading VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from segflow.functions.plain_xml import plain_json

_CORRUPT = "_corrupt_record"


# A value with so large an exponent would be written out digit by digit before the
# parser falls back to text, which takes minutes or all memory. Seven exponent
# digits, after leading zeros, are more than any number that stays one.
_ENDLESS_NUMBER = r"""([>"'\[]\s*)([-+]?[0-9.,]+[eE][+]?0*[1-9][0-9]{6,}\s*[<"'\]])"""


def is_readable_xml(text: Column) -> Column:
    """True when the text is well-formed; only its tokens are read, no value is built."""
    return F.from_xml(text, f"{_CORRUPT} string")[_CORRUPT].isNull()


def _parsed_as_text(text: Column) -> Column:
    """The parse of a text with endless numbers: these stay text, as the parser would leave them in the end.

    A mark made of the text's own hash keeps each such number from being read as
    one, and is taken out of the result's JSON form. Decimals of the message may
    come back as integers of the same value.
    """
    mark = F.concat(F.lit("\u2060"), F.sha2(text.cast("binary"), 256), F.lit("\u2060"))
    marked = F.regexp_replace(text, F.lit(_ENDLESS_NUMBER), F.concat(F.lit("$1"), mark, F.lit("$2")))
    return F.parse_json(F.replace(F.to_json(F.from_xml(marked, "VARIANT")), mark, F.lit("")))


def xml_to_variant(text: Column) -> Column:
    """XML text as VARIANT; NULL for NULL and for text that is not well-formed.

    Spark's parser raises two exceptions for each value that is not a number and builds each
    element's VARIANT anew on every level above it, so plain texts come as JSON, with the same
    values, at a fraction of the cost. All others are parsed by it: it raises on malformed text
    in every mode, so each text is checked first, at about a tenth of the cost of
    the parse. These steps sit in a lambda over a one-element array: Spark 4.1 generates code for a
    VARIANT ``from_xml`` that does not compile, and lambdas are evaluated without it, so
    the rest of the stage keeps its generated code.
    """
    parsed = F.transform(
        F.array(F.struct(text.alias("text"), plain_json(text).alias("json"))),
        lambda doc: F.when(doc["json"].isNotNull(), F.parse_json(doc["json"])).when(
            is_readable_xml(doc["text"]),
            F.when(doc["text"].rlike(_ENDLESS_NUMBER), _parsed_as_text(doc["text"])).otherwise(
                F.from_xml(doc["text"], "VARIANT")
            ),
        ),
    )
    return parsed[0]


def member_path(*names: str) -> str:
    """JSON path to nested members; quoted, as member names may hold dots."""
    return "$" + "".join(f"['{name}']" for name in names)


def member(value: Column, *names: str) -> Column:
    """Nested member as VARIANT; SQL NULL when absent."""
    return F.variant_get(value, member_path(*names), "variant")


def member_text(value: Column, *names: str) -> Column:
    """Nested member as text; a JSON null is NULL, objects and arrays become JSON."""
    return F.try_variant_get(value, member_path(*names), "string")


def member_list(value: Column, *names: str) -> Column:
    """Nested member as an array of VARIANT; NULL for any other shape."""
    return F.try_variant_get(value, member_path(*names), "array<variant>")


def evaluated_once(value: Column) -> Column:
    """The same value, computed where it is selected and nowhere else.

    Spark copies a deterministic column into every filter that reads it and may
    move that filter, with the copied work, below an exchange. The always true
    but non-deterministic condition rules that out.
    """
    return F.when(F.spark_partition_id() >= 0, value)
