"""One pass over a page's HTML: the only place where pages need Python.

A lenient tree is built with the standard library's tokenizer: void elements close at
once, an end tag closes up to the nearest open element of its name, and nothing else is
implied, so unclosed paragraphs nest. Everything later works on the returned arrays.
Pages come to a worker in batches of bounded bytes, and go back in slices of bounded
characters, so what a worker holds follows its longest page, not the table's size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.functions.batches import bound, give_back

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr basefont bgsound command frame image isindex nextid spacer keygen".split())
#: Elements whose text nobody sees.
_HIDDEN = frozenset(("script", "style", "noscript", "svg"))
_RAW = frozenset(("script", "style", "template"))
_BLOCKS = frozenset(("div", "h3", "p", "li"))
#: Characters of pages that are parsed before their results go back; a longer page goes alone.
SLICE_CHARS = 1 << 20


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_S, _I = T.StringType(), T.IntegerType()
#: What a page becomes. Built without a session, for workers import this module.
SCHEMA = _struct(visible_text=_S, email_text=_S, anchors=T.ArrayType(_struct(pos=_I, href=_S, rel=_S, aria=_S, text=_S)))


class Node:
    __slots__ = ("tag", "attrs", "strings", "begin", "end", "hidden", "leaf", "raw")

    def __init__(self, tag: str, attrs: dict[str, str], begin: int, hidden: bool, raw: bool) -> None:
        self.tag, self.attrs, self.begin, self.end, self.hidden, self.leaf, self.raw = tag, attrs, begin, begin, hidden, True, raw


class Page(HTMLParser):
    """Elements in document order; strings are shared, each element has a range of them."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[Node] = []
        self.open: list[Node] = []
        self.strings: list[tuple[str, bool, bool]] = []  # text, hidden, raw
        self.data: list[str] = []
        self.feed(html)
        self.close()
        self._flush()
        for node in self.open:
            node.end = len(self.strings)

    def _flush(self) -> None:
        if self.data:
            top = self.open[-1] if self.open else None
            self.strings.append(("".join(self.data), bool(top and top.hidden), bool(top and top.raw)))
            self.data = []

    def handle_data(self, data: str) -> None:
        self.data.append(data)

    def unknown_decl(self, data: str) -> None:
        if data.startswith("CDATA["):
            self._flush()
            self.data.append(data[6:])
            self._flush()

    def handle_comment(self, data: str) -> None:
        self._flush()

    handle_decl = handle_pi = handle_comment

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._flush()
        top = self.open[-1] if self.open else None
        if tag in _BLOCKS:
            for node in self.open:
                node.leaf = False
        node = Node(tag, {k: v or "" for k, v in attrs}, len(self.strings), bool(top and top.hidden) or tag in _HIDDEN, tag in _RAW)
        self.nodes.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._flush()
        if not any(n.tag == tag for n in self.open):
            return
        while True:
            node = self.open.pop()
            node.end = len(self.strings)
            if node.tag == tag:
                return

    def text(self, node: Node | None = None, visible: bool = False) -> str:
        some = self.strings if node is None else self.strings[node.begin : node.end]
        raw = node is not None and node.raw
        parts = (s.strip() for s, hidden, r in some if (not r or raw) and not (visible and hidden))
        return " ".join(p for p in parts if p)


def clean(text: str) -> str:
    return " ".join(text.split())


def _anchors(page: Page) -> list[dict]:
    links = [(pos, n) for pos, n in enumerate(page.nodes) if n.tag == "a" and "href" in n.attrs]
    return [{"pos": pos, "href": n.attrs["href"], "rel": n.attrs.get("rel", ""), "aria": n.attrs.get("aria-label", ""), "text": clean(page.text(n))} for pos, n in links]


def parse(html: str | None) -> dict:
    """What shows of a page, with white space collapsed; the same as it stands, unescaped once more; its links."""
    page = Page(html or "")
    visible = page.text(visible=True)
    return {"visible_text": re.sub(r"\s+", " ", visible), "email_text": unescape(visible), "anchors": _anchors(page)}


def slices(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The batches in pieces of SLICE_CHARS characters, or one page; freed memory goes back between batches."""
    for htmls in batches:
        begin, held = 0, 0
        for at, html in enumerate(htmls):
            held += len(html) if isinstance(html, str) else 0
            if held >= SLICE_CHARS:
                yield htmls.iloc[begin : at + 1]
                begin, held = at + 1, 0
        if begin < len(htmls):
            yield htmls.iloc[begin:]
        give_back()


@F.pandas_udf(SCHEMA)
def _parse_html(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for htmls in slices(batches):
        yield pd.DataFrame([parse(h) for h in htmls], columns=SCHEMA.names)


@F.pandas_udf(SCHEMA["anchors"].dataType)
def _parse_anchors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for htmls in slices(batches):
        yield pd.Series([_anchors(Page(h or "")) for h in htmls], dtype="object")


def parse_html(html: Column | str) -> Column:
    """struct of SCHEMA; call it once a page and take its fields from the result."""
    bound(SparkSession.active())
    return _parse_html(html)


def parse_anchors(html: Column | str) -> Column:
    """The links alone."""
    bound(SparkSession.active())
    return _parse_anchors(html)
