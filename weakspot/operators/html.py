"""Description block of an HTML page."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weakspot.functions.text import first_sentence

# fixed values: tags whose content is no description, and tags without content
DROPPED = {"script", "style", "h3", "h4", "table"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link",
        "meta", "param", "source", "track", "wbr"}
PAGES = 64  # pages whose text a task holds at once


class _Block(HTMLParser):
    """Text of ``div#Description``, else of the ``div`` next to the first
    heading that names a description."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.parts: dict[str, list[str]] = {}
        self.open_at: dict[str, int] = {}
        self.heading: list[str] | None = None
        self.heading_level = -1
        self.sibling_level = -1
        self.heading_seen = False

    def handle_starttag(self, tag, attrs):
        level = len(self.stack)
        if tag == "div":
            if "id" not in self.parts and dict(attrs).get("id") == "Description":
                self.parts["id"], self.open_at["id"] = [], level
            elif self.sibling_level == level and "next" not in self.parts:
                self.parts["next"], self.open_at["next"] = [], level
        if tag == "h2" and not self.heading_seen and self.heading is None:
            self.heading, self.heading_level = [], level
        if tag not in VOID:
            self.stack.append(tag)

    def handle_endtag(self, tag):
        if tag not in self.stack:
            return
        while self.stack.pop() != tag:
            pass
        level = len(self.stack)
        self.open_at = {k: at for k, at in self.open_at.items() if at < level}
        if self.heading is not None and level <= self.heading_level:
            if len(self.heading) == 1 and re.search("Description", self.heading[0], re.IGNORECASE):
                self.heading_seen, self.sibling_level = True, self.heading_level
            self.heading = None
        if level < self.sibling_level:
            self.sibling_level = -1

    def handle_data(self, data):
        if self.heading is not None:
            self.heading.append(data)
        for name, at in self.open_at.items():
            if not DROPPED.intersection(self.stack[at:]) and data.strip():
                self.parts[name].append(data.strip())


def block_text(html: str | None) -> str | None:
    if html is None:
        return None
    parser = _Block()
    parser.feed(html)
    parser.close()
    parts = parser.parts.get("id", parser.parts.get("next"))
    return " ".join(parts) if parts else None


def describe_pages(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, block, description): block text and its first sentence.

    Nested blocks need a tag stack, so parsing runs in Python by Arrow
    batches, a few pages at a time; everything after it is a built-in expression.
    """
    named = F.when(F.lower(html).contains("description"), F.col(html))  # other pages never reach Python
    kind = pages.schema[key].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PAGES):
                part = batch.slice(start, PAGES)
                made = pa.array([block_text(page.as_py()) for page in part.column(1)], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), made], names=[key, "block"])

    return (pages.select(key, named.alias("__html")).mapInArrow(blocks, f"`{key}` {kind}, block string")
            .withColumn("description", first_sentence("block")))
