"""HTML walk: one pass of the standard library's parser per page, inside tasks.

Only the fields asked for are collected and sent back to the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekloom import fixed_values as fv
from seekloom.functions.text import clean_text

_STRING = T.StringType()
_BLOCK = T.StructType([T.StructField("tag", _STRING), T.StructField("text", _STRING)])

FIELDS = {
    "title": _STRING,
    "description": _STRING,
    "lang": _STRING,
    "xml_lang": _STRING,
    "has_html": T.BooleanType(),
    "main_tag": _STRING,
    "main_text": _STRING,
    "blocks": T.ArrayType(_BLOCK),
    "alts": T.ArrayType(_STRING),
    "page_text": _STRING,
    "body_text": _STRING,
    "hrefs": T.ArrayType(_STRING),
}

_TEXTS = pa.list_(pa.string())
_ARROW = {
    "has_html": pa.bool_(),
    "blocks": pa.list_(pa.struct([("tag", pa.string()), ("text", pa.string())])),
    "alts": _TEXTS,
    "hrefs": _TEXTS,
}
#: Characters of pages whose fields are held at once.
SLICE_CHARS = 1024 * 1024

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_UNSEEN = frozenset(("script", "style", "template"))
# An opening tag that ends an open element of one of these kinds.
_BLOCK_TAGS = (
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
    "section table ul"
).split()
_ENDS = {tag: ("p",) for tag in _BLOCK_TAGS}
_ENDS.update({"li": ("li", "p"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "option": ("option",)})
_SCOPES = frozenset("html body table ul ol div article section main td th blockquote".split())


class _PageWalk(HTMLParser):
    """Collects text pieces with the span of pieces each element covers."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.open: list[list] = []
        self.elements: list[list] = []
        self.unseen = 0
        self.in_title = False
        self.title: str | None = None
        self.description: str | None = None
        self.html_attrs: dict | None = None
        self.alts: list[str] = []
        self.hrefs: list[str] = []

    def _close(self, position: int) -> None:
        for element in self.open[position:]:
            element[2] = len(self.pieces)
        del self.open[position:]

    def handle_starttag(self, tag, attrs):
        values = dict(attrs)
        if tag == "html":
            if self.html_attrs is None:
                self.html_attrs = values
        elif tag == "meta":
            if self.description is None and values.get("name") == "description":
                self.description = values.get("content") or ""
        elif tag == "img":
            if values.get("alt"):
                self.alts.append(values["alt"])
        elif tag == "a" and values.get("href") is not None:
            self.hrefs.append(values["href"])
        if tag in _UNSEEN:
            self.unseen += 1
            return
        if tag in _VOID:
            return
        ended = _ENDS.get(tag, ())
        for position in range(len(self.open) - 1, -1, -1):
            name = self.open[position][0]
            if name in ended:
                self._close(position)
                break
            if name in _SCOPES:
                break
        element = [tag, len(self.pieces), None]
        self.open.append(element)
        self.elements.append(element)
        self.in_title = tag == "title" and self.title is None

    def handle_endtag(self, tag):
        if tag in _UNSEEN:
            self.unseen = max(0, self.unseen - 1)
            return
        if tag == "title" and self.in_title:
            self.in_title = False
            self.title = self.title or ""
        for position in range(len(self.open) - 1, -1, -1):
            if self.open[position][0] == tag:
                self._close(position)
                break

    def handle_data(self, data):
        if self.unseen:
            return
        if self.in_title:
            self.title = (self.title or "") + data
        self.pieces.append(data)

    def finish(self):
        self.close()
        self._close(0)


def _normal(text: str) -> str:
    return re.sub(r"\s+", " ", text).strip()


def walk_page(html: str | None, fields: tuple[str, ...]) -> dict:
    """Values of the wanted fields for one page."""
    if html is None:
        return dict.fromkeys(fields)
    walk = _PageWalk()
    walk.feed(html)
    walk.finish()
    pieces = walk.pieces
    main = next((e for tag in fv.MAIN_TAGS for e in walk.elements if e[0] == tag), None)
    first, last = (main[1], main[2]) if main else (0, len(pieces))
    attrs = walk.html_attrs or {}
    found: dict = {
        "title": walk.title or "",
        "description": walk.description or "",
        "lang": attrs.get("lang"),
        "xml_lang": attrs.get("xml:lang"),
        "has_html": walk.html_attrs is not None,
        "main_tag": main[0] if main else None,
        "alts": [a for a in map(_normal, walk.alts) if a],
        "hrefs": walk.hrefs,
    }
    if "main_text" in fields:
        found["main_text"] = _normal(" ".join(pieces[first:last]))
    if "page_text" in fields:
        found["page_text"] = "".join(pieces)
    if "body_text" in fields:
        body = next((e for e in walk.elements if e[0] == "body"), None)
        found["body_text"] = "".join(p.strip() for p in pieces[body[1] : body[2]]) if body else walk.description or ""
    if "blocks" in fields:
        blocks = []
        start = next((i for i, e in enumerate(walk.elements) if e is main), -1) + 1
        for tag, begin, end in walk.elements[start:]:
            if main and begin >= last and end > last:
                break
            if tag in fv.TEXT_TAGS:
                text = _normal("".join(p.strip() for p in pieces[begin:end]))
                if text:
                    blocks.append((tag, text))
        found["blocks"] = blocks
    return {name: found[name] for name in fields}


def parse_pages(pages: DataFrame, *fields: str) -> DataFrame:
    """Add parsed fields to ``pages(link, html, ...)``; ``html`` is dropped.

    A narrow job: pages stay in the partitions they are read in. Fields leave a task as soon
    as those of a few pages are found.
    """
    kept = [f for f in pages.schema.fields if f.name != "html"]
    names = [f.name for f in kept]
    schema = T.StructType(kept + [T.StructField(name, FIELDS[name]) for name in fields])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held, parsed = 0, 0, []
            for row, value in enumerate(batch.column("html")):
                html = value.as_py()
                parsed.append(walk_page(html, fields))
                held += len(html or "")
                if held >= SLICE_CHARS or row + 1 == batch.num_rows:
                    done = batch.slice(start, len(parsed))
                    found = [pa.array([p[name] for p in parsed], _ARROW.get(name, pa.string())) for name in fields]
                    yield pa.RecordBatch.from_arrays([*map(done.column, names), *found], [*names, *fields])
                    start, held, parsed = row + 1, 0, []

    return pages.select(*names, "html").mapInArrow(walk, schema)


def searchable_text(mode: str = "leaf") -> Column:
    """Blocks, description, title and image texts of a parsed page as one text.

    ``leaf`` takes each piece of the main content once. ``blocks`` takes every
    listed element with all text inside it, so nested elements repeat it.
    """
    if mode == "leaf":
        content = F.array(F.col("main_text"))
    elif mode == "blocks":
        content = F.col("blocks.text")
    else:
        raise ValueError(f"unknown text mode {mode!r}")
    parts = F.concat(content, F.array(clean_text(F.col("description")), clean_text(F.col("title"))), F.col("alts"))
    return F.trim(F.array_join(parts, " "))


def text_fields(mode: str = "leaf") -> tuple[str, ...]:
    """Fields that :func:`searchable_text` needs."""
    return ("title", "description", "alts", "main_text" if mode == "leaf" else "blocks")


# Forms for well-formed pages that need no walk and stay in the JVM.


def title_of(html: Column) -> Column:
    return F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1)


def declared_language(html: Column) -> Column:
    return F.regexp_extract(html, r'<html[^>]*\slang="([^"]*)"', 1)


def anchor_links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'<a\s[^>]*?href="([^"]*)"'), F.lit(1))
