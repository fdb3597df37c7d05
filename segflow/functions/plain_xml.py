"""Messages of plain XML as JSON, in one pass over the text.

Plain means elements with names of ASCII letters and texts, as messages are: no attributes, comments,
CDATA, declarations or prefixes, nothing beside child elements but white space. For such a text the JSON
holds what Spark's XML parser would put into a VARIANT, value by value. Any other text, also one that
is not well-formed, and any value of which it is not certain how Spark would read it, is left
to Spark's parser.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from json.encoder import encode_basestring

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# What tasks run travels with the plan, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a text that is sent to a task's Python, at most; few messages are longer.
BYTES_AT_MOST = 1 << 16
#: Elements inside each other, at most.
_DEPTH = 200
#: Tags of shapes, and values of so many characters, that a task remembers.
_TAGS, _VALUES, _CHARS = 1_000_000, 50_000, 64
_SPACE = " \t\n"

_COMMON = bytes({*b"\t\n", *range(0x20, 0x7F)} - set(b"<>&"))
_NO_MARKS = bytes(set(range(256)) - set(b"<>"))

_prolog = re.compile(r'\?xml version="1\.0"(?: encoding="[Uu][Tt][Ff]-8")?\?').fullmatch
_name = re.compile(r"[A-Za-z_][A-Za-z0-9_.\-]{0,200}").fullmatch
_integer = re.compile(r"-?[0-9]{1,18}").fullmatch
_decimal = re.compile(r"-?(?:0|[1-9][0-9]{0,17})\.[0-9]{1,18}").fullmatch
_dashed = re.compile(r"[0-9]{1,9}(?:-[0-9]{1,9}){1,4}").fullmatch
# An ASCII character that no number has; others may be digits of some script.
_no_number = re.compile(r"[!-*/:-DF-df-~ ]").search
# Characters that a text must not have, or that parsers may change, and references other than to one of five.
_uncertain = re.compile(r"[^\t\n -~\xa0-\ud7ff\ue000-\ufffd]").search
_reference = re.compile(r"&(?!(?:amp|lt|gt|quot|apos);)").search
# As `_ENDLESS_NUMBER` of ``variants``, with all that may stand around it.
_endless = re.compile(r"[0-9.,][eE][+]?0*[1-9][0-9]{6}").search


class NotPlain(ValueError):
    """A text that Spark's parser has to read."""


def value_json(text: str) -> str:
    """JSON of an element's text, which has certain characters alone, as Spark's parser infers its type."""
    if not text:
        return "null"
    if _integer(text):
        return str(int(text))
    if _decimal(text) or text in ("true", "false"):
        return text
    if text[0] <= " " or text[-1] <= " " or text.lower() in ("true", "false"):
        raise NotPlain
    if not _dashed(text) and not _no_number(text) or _endless(text):
        raise NotPlain
    if "&" in text:
        for written, meant in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
            text = text.replace(written, meant)
    return encode_basestring(text)


class Element:
    """An element of a shape: its children, or the place of its text behind a tag; neither if it is one tag."""

    __slots__ = ("name", "children", "text")

    def __init__(self, name: str) -> None:
        self.name = name
        self.children: list[Element] = []
        self.text: int | None = None


class Shape:
    """What texts with the same tags share: their elements, and which of the texts behind tags are values."""

    def __init__(self, tags: tuple[str, ...]) -> None:
        root, self.blanks = elements(tags)
        self.tags = tags
        self.places: list[int] = []
        self.template = self._template(root)

    def _template(self, element: Element) -> str:
        """JSON with a place for each value; ``places`` gets where that stands, in the order of the JSON."""
        if element.children:
            named: dict[str, list[Element]] = {}
            for child in element.children:
                named.setdefault(child.name, []).append(child)
            if len({name.lower() for name in named}) < len(named):
                raise NotPlain  # Spark takes names that differ by case for one
            members = []
            for name, children in named.items():
                inside = ",".join([self._template(child) for child in children])
                members.append(f'"{name}":[{inside}]' if len(children) > 1 else f'"{name}":{inside}')
            return "{" + ",".join(members) + "}"
        if element.text is None:
            return "null"
        self.places.append(element.text)
        return "%s"


def elements(tags: tuple[str, ...]) -> tuple[Element, list[int]]:
    """The root element, and the places of texts that must be white space."""
    above = Element("")
    stack, blanks, opened = [above], [], -1
    for place, tag in enumerate(tags):
        if tag.startswith("/"):
            element = stack.pop()
            if not stack or tag[1:] != element.name:
                raise NotPlain
            if opened == place - 1:
                element.text = blanks.pop()
        elif place or not _prolog(tag):
            element = Element(tag.removesuffix("/"))
            if not _name(element.name) or len(stack) > _DEPTH:
                raise NotPlain
            stack[-1].children.append(element)
            if not tag.endswith("/"):
                stack.append(element)
                opened = place
        blanks.append(place)
    if len(stack) > 1 or len(above.children) != 1 or not above.children[0].children:
        raise NotPlain
    return above.children[0], blanks


class PlainXml:
    """Cuts texts into a shape and the texts behind its tags. Remembers the shapes, and short values, that it has seen."""

    def __init__(self) -> None:
        self.shapes: dict[tuple[str, ...], Shape] = {}
        self.values: dict[str, str] = {}
        self.tags = 0

    def cut(self, text: str) -> tuple[Shape, list[str]]:
        """The shape, and what is written behind each tag; NotPlain if Spark's parser has to read the text."""
        marks = text.encode("utf-8").translate(None, _COMMON)
        if b"&" in marks:
            if _reference(text):
                raise NotPlain
            marks = marks.replace(b"&", b"")
        if marks != b"<>" * (len(marks) // 2):
            marks = marks.translate(None, _NO_MARKS)
            if marks != b"<>" * (len(marks) // 2) or _uncertain(text):
                raise NotPlain
        before, *parts = text.replace(">", "<").split("<")
        tags, behind = tuple(parts[::2]), parts[1::2]
        shape = self.shapes.get(tags) or self._shape(tags)
        if "".join([before, *[behind[i] for i in shape.blanks]]).strip(_SPACE) or (before and tags[0][0] == "?"):
            raise NotPlain
        return shape, behind

    def _shape(self, tags: tuple[str, ...]) -> Shape:
        shape = Shape(tuple([sys.intern(tag) for tag in tags]))
        self.tags += len(tags)
        if self.tags > _TAGS:
            self.shapes, self.tags = {}, len(tags)
        self.shapes[shape.tags] = shape
        return shape

    def value(self, written: str) -> str:
        """JSON of a text behind a tag, remembered."""
        found = value_json(written)
        if len(written) <= _CHARS:
            if len(self.values) >= _VALUES:
                self.values.clear()
            self.values[written] = found
        return found

    def json(self, text: str) -> str:
        """JSON of what the root element holds."""
        shape, behind = self.cut(text)
        known, value = self.values.get, self.value
        return shape.template % tuple([known(behind[i]) or value(behind[i]) for i in shape.places])


@F.arrow_udf(StringType())
def _plain_json(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    reader = PlainXml()

    def read(text: bytes | None) -> str | None:
        if text is None:
            return None
        try:
            return reader.json(text.decode("utf-8"))
        except (NotPlain, UnicodeDecodeError):
            return None

    for some in texts:
        yield pa.array([read(text.as_py()) for text in some], pa.string())


def plain_json(text: Column) -> Column:
    """JSON of the message in a text of plain XML; NULL for any other text, and for a long one."""
    return _plain_json(F.when(F.octet_length(text) <= BYTES_AT_MOST, text).cast("binary"))
