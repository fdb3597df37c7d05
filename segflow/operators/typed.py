"""Messages by a schema learned from all of them: codes keep their zeros, what repeats is always a list.

``xml_to_variant`` infers each value by itself, so a code of 007 becomes 7 and a
segment is an object or a list by how often it occurs in a message. Here one
aggregation over all messages gathers evidence for every path of elements; it
becomes a schema, by which messages are then parsed without inference.
"""

from __future__ import annotations

import gc
import re
import sys
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, LongType, StringType, StructField, StructType

from segflow.functions.plain_xml import NotPlain, PlainXml, Shape, elements
from segflow.functions.variants import is_readable_xml

# What tasks run travels with the plan, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Paths that messages of one kind have at most; more mean that element names are data.
PATHS_AT_MOST = 20_000
#: Numbers of more digits are codes.
MOST_DIGITS = 18
#: Elements of a task whose texts and places wait to be counted, about.
_WAITING_AT_MOST = 200_000
#: Fixed value: the most digits of Spark's DECIMAL.
_DECIMAL_DIGITS = 38
_COUNTS = ("occurrences", "parents", "texts", "not_numbers", "fractions", "codes")
_LARGEST = ("most", "whole_digits", "fraction_digits")
_NUMBER = re.compile(r"-?(\d+)(?:\.(\d+))?").fullmatch
#: Names that from_xml gives to attributes, and to the text of an element that also has attributes or children.
_ATTRIBUTE, _TEXT = "_", "_VALUE"
#: Where a typed parse puts the text if something is amiss; no element has such a name.
_AMISS = "/amiss"


class _Path:
    """What the messages of a task say about one path; texts and sets of children wait to be counted together."""

    __slots__ = ("path", "inside", "seen", "texts", "families")

    def __init__(self, path: tuple[str, ...]) -> None:
        self.path = path
        self.inside: dict[str, _Path] = {}
        self.seen = dict.fromkeys((*_COUNTS, *_LARGEST), 0)
        self.texts: list[str] = []
        self.families: dict[tuple[str, ...], int] = {}

    def value(self, text: str, times: int) -> None:
        seen = self.seen
        seen["texts"] += times
        number = _NUMBER(text)
        if number is None:
            seen["not_numbers"] += times
            return
        whole, fraction = number[1], number[2] or ""
        seen["fractions"] += bool(fraction) * times
        seen["codes"] += ((len(whole) > 1 and whole[0] == "0") or len(whole) + len(fraction) > MOST_DIGITS) * times
        seen["whole_digits"] = max(seen["whole_digits"], len(whole))
        seen["fraction_digits"] = max(seen["fraction_digits"], len(fraction))

    def occurs(self, times: int, side_by_side: int) -> None:
        self.seen["occurrences"] += times
        self.seen["most"] = max(self.seen["most"], side_by_side)

    def count(self) -> None:
        """Count what waits: equal texts, and parents with the same children, once each."""
        for text, times in Counter(self.texts).items():
            if text := text.strip():
                self.value(text, times)
        for family, times in self.families.items():
            for name, n in Counter(family).items():
                self.inside[name].occurs(n * times, n)
        self.texts.clear()
        self.families.clear()


class _Evidence:
    """What the messages of a task say about each path."""

    def __init__(self) -> None:
        self.top = _Path(())
        self.paths: list[_Path] = []
        self.waiting = 0
        self.plain = PlainXml()
        self.shapes: dict[Shape, _Places] = {}

    def below(self, here: _Path, name: str) -> _Path:
        if name not in here.inside:
            here.inside[name] = _Path((*here.path, name))
            self.paths.append(here.inside[name])
        return here.inside[name]

    def text(self, text: str) -> None:
        """A message by its text, which says nothing if it is not well-formed."""
        try:
            shape, behind = self.plain.cut(text)
        except NotPlain:
            try:
                root = ElementTree.fromstring(text)
            except (ElementTree.ParseError, ValueError):
                return
            self.message(root)
            return
        found = self.shapes.get(shape)
        if found is None:
            found = self.shapes[shape] = _Places(self, shape)
        found.times += 1
        for take, place in zip(found.takes, shape.places):
            take(behind[place])  # references stay: no number has one, resolved or not
        self.waiting += found.elements
        if self.waiting >= _WAITING_AT_MOST:
            self.count()

    def message(self, root: ElementTree.Element) -> None:
        """Takes elements from a list, not by recursion, so that deep messages do no harm."""
        waiting = [(self.top, root)]
        while waiting:
            here, element = waiting.pop()
            inside = here.inside
            written = [element.text] if element.text else []
            family = []
            for child in element:
                name = child.tag
                family.append(name)
                at = inside.get(name) or self.below(here, name)
                if len(child) or child.keys():
                    waiting.append((at, child))
                elif child.text:
                    at.texts.append(child.text)
                if child.tail:
                    written.append(child.tail)
            attributes = element.items()
            for name, value in attributes:
                at = self.below(here, _ATTRIBUTE + name)
                at.occurs(1, 1)
                at.value(value.strip(), 1)
            if family or attributes:
                here.seen["parents"] += 1
                if written and (text := "".join(written).strip()):
                    at = self.below(here, _TEXT)
                    at.occurs(1, 1)
                    at.value(text, 1)
            if family:
                family = tuple(family)
                here.families[family] = here.families.get(family, 0) + 1
                self.waiting += len(family)
                if self.waiting >= _WAITING_AT_MOST:
                    self.count()

    def count(self) -> None:
        for found in self.shapes.values():
            found.count()
        if len(self.shapes) > len(self.plain.shapes):
            self.shapes.clear()  # the reader has forgotten some
        for path in (self.top, *self.paths):
            path.count()
        self.waiting = 0


class _Places:
    """Where the values of a shape's texts go, and the parents it has, for as many texts as had it since the last count."""

    def __init__(self, evidence: _Evidence, shape: Shape) -> None:
        self.times = 0
        self.elements = 0
        self.takes: list[Callable[[str], None]] = []
        self.families: list[tuple[_Path, tuple[str, ...]]] = []
        root, _ = elements(shape.tags)
        takes = {}
        waiting = [(evidence.top, root)]
        while waiting:
            here, element = waiting.pop()
            family = tuple([child.name for child in element.children])
            self.families.append((here, family))
            self.elements += len(family)
            for child in element.children:
                at = evidence.below(here, child.name)
                if child.children:
                    waiting.append((at, child))
                elif child.text is not None:
                    takes[child.text] = at.texts.append
        self.takes = [takes[place] for place in shape.places]

    def count(self) -> None:
        if self.times:
            for here, family in self.families:
                here.seen["parents"] += self.times
                here.families[family] = here.families.get(family, 0) + self.times
            self.times = 0


def path_evidence(texts: DataFrame, value: str = "value") -> DataFrame:
    """A row for each path of element names below the root, with what the values on it look like.

    `occurrences`, how often it occurs; `parents`, with elements inside; `texts`, with a text; of these
    `not_numbers`, `fractions`, and `codes`, which have a leading zero or too many digits; `most` of them
    side by side in one parent, and the most digits. Tasks hold a row for each path. Texts that are
    null or not well-formed say nothing. Evidence of several sets of messages is combined by
    ``merged_evidence``.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = _Evidence()
        collects = gc.isenabled()
        gc.disable()  # elements refer to no one above them, so nothing is left for the collector to find
        try:
            for batch in batches:
                for text in batch.column(0):
                    if (text := text.as_py()) is not None:
                        evidence.text(text)
        finally:
            if collects:
                gc.enable()
        evidence.count()
        columns = [pa.array([list(p.path) for p in evidence.paths], pa.list_(pa.string()))]
        columns += [pa.array([p.seen[name] for p in evidence.paths], pa.int64()) for name in (*_COUNTS, *_LARGEST)]
        yield pa.RecordBatch.from_arrays(columns, ["path", *_COUNTS, *_LARGEST])

    names = ", ".join(f"{name} long" for name in (*_COUNTS, *_LARGEST))
    return merged_evidence(texts.select(F.col(value).cast("string")).mapInArrow(gather, f"path array<string>, {names}"))


def merged_evidence(*found: DataFrame) -> DataFrame:
    """One row for each path from evidence of any number of sets of messages."""
    rows = reduce(DataFrame.unionByName, found)
    return rows.groupBy("path").agg(*[F.sum(c).alias(c) for c in _COUNTS], *[F.max(c).alias(c) for c in _LARGEST])


def _leaf_type(seen) -> DataType:
    whole = seen["texts"] - seen["not_numbers"]
    if not whole or seen["not_numbers"] or seen["codes"]:
        return StringType()
    if not seen["fractions"]:
        return LongType()
    digits = seen["whole_digits"] + seen["fraction_digits"]
    return DecimalType(digits, seen["fraction_digits"]) if digits <= _DECIMAL_DIGITS else StringType()


def learned_schema(evidence: DataFrame) -> StructType:
    """The schema of messages: structs for elements with others inside, lists for what repeats in any message.

    Values are BIGINT or DECIMAL where all are numbers that come back as they were written, or else STRING:
    leading zeros or many digits make a code. Elements stand in name order. The rows of the
    evidence, one for each path, come to the driver: their number is that of the messages' element names,
    and more than PATHS_AT_MOST raise ValueError.
    """
    rows = {tuple(r["path"]): r for r in evidence.limit(PATHS_AT_MOST + 1).collect()}
    if len(rows) > PATHS_AT_MOST:
        raise ValueError(f"more than {PATHS_AT_MOST} paths of elements: these messages have no common schema")
    inside: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path in rows:
        inside[path[:-1]].append(path[-1])

    def struct(path: tuple[str, ...]) -> StructType:
        return StructType([StructField(name, of((*path, name))) for name in sorted(inside[path])])

    def of(path: tuple[str, ...]) -> DataType:
        found = struct(path) if path in inside else _leaf_type(rows[path])
        return ArrayType(found) if rows[path]["most"] > 1 else found

    return struct(())


def typed_message(text: Column, schema: StructType) -> Column:
    """XML text as a struct of the schema; NULL for NULL, for text that is not well-formed, and for a schema without fields.

    Elements the schema does not know are left out, values that are not of its type are NULL.
    A text is parsed once: only if the parse finds something amiss, which may be a value, is it checked apart.
    """
    if not schema.fields:
        return F.lit(None).cast("struct<>")
    told = StructType([*schema.fields, StructField(_AMISS, StringType())])
    options = {"columnNameOfCorruptRecord": _AMISS}
    found = F.transform(
        F.array(F.struct(text.alias("text"), F.from_xml(text, told, options).alias("parsed"))),
        lambda doc: F.when(
            doc["text"].isNotNull() & (doc["parsed"][_AMISS].isNull() | is_readable_xml(doc["text"])),
            doc["parsed"].dropFields(f"`{_AMISS}`"),
        ),
    )
    return found[0]
