"""Document parsers: columns of path, bytes and options to a parse result VARIANT."""

from __future__ import annotations

import json
import sys
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The parser travels with the plan, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# HTML elements that start a new block, and those without text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote br body dd div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section table td th title tr ul".split()
)
SILENT_TAGS = frozenset(("script", "style", "template"))


class _Blocks(HTMLParser):
    """Collects the text of each block element, white space collapsed."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[dict[str, str]] = []
        self._kind = "body"
        self._text: list[str] = []
        self._silent = 0

    def _flush(self, kind: str) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            self.found.append({"type": self._kind, "content": text})
        self._text.clear()
        self._kind = kind

    def handle_starttag(self, tag, attrs):
        if tag in SILENT_TAGS:
            self._silent += 1
        if tag in BLOCK_TAGS:
            self._flush(tag)

    def handle_endtag(self, tag):
        if tag in SILENT_TAGS:
            self._silent = max(0, self._silent - 1)
        if tag in BLOCK_TAGS:
            self._flush("body")

    def handle_data(self, data):
        if not self._silent:
            self._text.append(data)

    def close(self):
        super().close()
        self._flush("body")


# First bytes of common files that are not HTML, and what they are.
SIGNATURES = {
    b"%PDF-": "PDF",
    b"PK\x03\x04": "ZIP or Office",
    b"\xd0\xcf\x11\xe0": "Office",
    b"\x89PNG": "PNG",
    b"\xff\xd8\xff": "JPEG",
    b"GIF8": "GIF",
    b"{\\rtf": "RTF",
}
_BYTE_ORDER_MARKS = {b"\xff\xfe": "utf-16", b"\xfe\xff": "utf-16", b"\xef\xbb\xbf": "utf-8-sig"}


def html_text(content: bytes) -> str:
    """Decoded HTML; raises ValueError for bytes of another kind."""
    for mark, encoding in _BYTE_ORDER_MARKS.items():
        if content.startswith(mark):
            return content.decode(encoding, errors="replace")
    for signature, kind in SIGNATURES.items():
        if content.lstrip()[: len(signature)] == signature:
            raise ValueError(f"not HTML but {kind}")
    if b"\0" in content:
        raise ValueError("not HTML: NUL bytes")
    return content.decode("utf-8", errors="replace")


def html_result(content: bytes | None, version: str) -> str | None:
    """Parse result of one HTML file as JSON text; NULL content gives None, bytes of another kind an error status."""
    if content is None:
        return None
    result: dict = {"metadata": {"version": version}, "document": {"pages": [], "elements": []}, "error_status": None}
    try:
        blocks = _Blocks()
        blocks.feed(html_text(bytes(content)))
        blocks.close()
        result["document"]["elements"] = blocks.found
    except Exception as failure:  # a bad file becomes an error row, not a failed job
        result["error_status"] = f"{type(failure).__name__}: {failure}"
    return json.dumps(result)


@F.pandas_udf(StringType())
def _html_results(contents: pd.Series, versions: pd.Series) -> pd.Series:
    return pd.Series([html_result(content, version) for content, version in zip(contents, versions)], dtype=object)


def html_parser(path: Column, content: Column, options: Column) -> Column:
    """Block texts of HTML bytes, parsed in Arrow batches."""
    return F.parse_json(_html_results(content, options["version"]))
