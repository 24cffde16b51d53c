"""Outline of a page: its elements and its text, as arrays that Spark can query.

An outline lists a page's elements in document order.  ``size`` counts an
element and all listed elements inside it, so the inside of the element at
position ``pos`` is one slice of the array, and every headline rule is a filter
over such a slice, written with Spark's array functions.  Only titles, links,
articles and elements with a class are listed.

The page's text is one list of pieces, each what stands between two tags or
comments, without surrounding space.  An element names its first piece and how
many it has, so a page takes memory in proportion to its size however many
elements are left open, and text is put together for the chosen elements only.
"""

from __future__ import annotations

import sys
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

from rotativa.fixed import EMPTY_TAGS, SILENT_TAGS, TITLE_TAGS

# Send this module's functions to the executors with the plan, so that a job
# needs no installed package there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTLINE = (
    "struct<pieces: array<string>, elements: array<struct<pos: int, size: int, tag: string, cls: string, "
    "href: string, piece: int, pieces: int, category: string, section: string, subsection: string>>>"
)
_ELEMENT = pa.struct(
    [("pos", pa.int32()), ("size", pa.int32())]
    + [(name, pa.string()) for name in ("tag", "cls", "href")]
    + [("piece", pa.int32()), ("pieces", pa.int32())]
    + [(name, pa.string()) for name in ("category", "section", "subsection")]
)
_OUTLINE_ARROW = pa.struct([("pieces", pa.list_(pa.string())), ("elements", pa.list_(_ELEMENT))])
PARSED_CHARACTERS = 1 << 20  # of pages that are Python's objects at a time
_KEPT_TAGS = frozenset((*TITLE_TAGS, "article"))


class _Outline(HTMLParser):
    """Collects the elements the headline rules look at: titles, links, blocks with a class."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.elements: list[dict] = []
        self.open: list[tuple[str, dict | None]] = []
        self.open_tags: Counter[str] = Counter()
        self.pieces: list[str] = []
        self.pending: list[str] = []  # text since the last tag or comment, in the parts the parser gives
        self.silent = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._end_piece()
        values = {name: value or "" for name, value in attrs}
        cls = " ".join(values["class"].split()) if "class" in values else None
        element = None
        if tag in _KEPT_TAGS or cls:
            element = {
                "pos": len(self.elements) + 1,
                "size": 1,
                "tag": tag,
                "cls": cls,
                "href": values.get("href"),
                "piece": len(self.pieces) + 1,
                "pieces": 0,
                "category": values.get("data-category"),
                "section": values.get("data-seccion"),
                "subsection": values.get("data-subseccion"),
            }
            self.elements.append(element)
        if tag not in EMPTY_TAGS:
            self.silent += tag in SILENT_TAGS
            self.open_tags[tag] += 1
            self.open.append((tag, element))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in EMPTY_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._end_piece()
        if self.open_tags[tag]:  # a stray end tag closes nothing
            while self._close_last() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.pending.append(data)

    def handle_comment(self, data: str) -> None:
        self._end_piece()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def finish(self) -> dict:
        self.close()
        self._end_piece()
        while self.open:
            self._close_last()
        return {"pieces": self.pieces, "elements": self.elements}

    def _end_piece(self) -> None:
        piece = "".join(self.pending).strip()
        self.pending.clear()
        if piece:
            self.pieces.append(piece)

    def _close_last(self) -> str:
        tag, element = self.open.pop()
        self.open_tags[tag] -= 1
        self.silent -= tag in SILENT_TAGS
        if element:
            element["size"] = len(self.elements) - element["pos"] + 1
            element["pieces"] = len(self.pieces) - element["piece"] + 1
        return tag


def _outline(html: str | None) -> dict | None:
    if html is None:
        return None
    try:
        parser = _Outline()
        parser.feed(html)
        return parser.finish()
    except Exception:  # a damaged page is rejected alone, never the job
        return None


def _outlines(html: pa.Array) -> pa.Array:
    """Outlines of a batch of pages, which leave Python's objects for Arrow's after every ``PARSED_CHARACTERS``.

    As Python's objects an outline takes many times its page, and a batch may hold
    all pages of a task.
    """
    done, parsed, characters = [], [], 0
    for page in html:
        text = page.as_py()
        parsed.append(_outline(text))
        characters += len(text or "")
        if characters >= PARSED_CHARACTERS:
            done.append(pa.array(parsed, type=_OUTLINE_ARROW))
            parsed, characters = [], 0
    return pa.concat_arrays([*done, pa.array(parsed, type=_OUTLINE_ARROW)])


def page_outline(html: Column) -> Column:
    """Outline of a page, NULL when there is no page or it cannot be parsed."""
    return F.arrow_udf(_outlines, OUTLINE)(html)


def element_text(pieces: Column, element: Column) -> Column:
    """The text of an element, NULL when there is no element."""
    return F.array_join(F.slice(pieces, element["piece"], element["pieces"]), "")


def page_text(outline: Column) -> Column:
    """All text of a page."""
    return F.array_join(outline["pieces"], "")
