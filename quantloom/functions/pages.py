"""Text of web pages by a list of selectors: bytes to characters, characters to a tree, the first container that holds an article."""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Neutral containers of articles, tried in this order; a deployment passes its own.
CONTAINERS: tuple[str, ...] = ("article", "[role=main]", "main", "#content", "#article", "#main", ".content", ".post", ".article", ".text", "div.entry", "section .body", "td.story")
#: Elements that are no part of a text.
DROPPED = frozenset(("script", "style", "nav", "header", "footer", "aside", "iframe", "noscript", "template"))
#: Fixed values of the HTML standard: elements without content, and elements that end an open one of their own kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_OWN = frozenset("p li dt dd tr td th option".split())
SCOPES = frozenset("table ul ol dl select div section article main body".split())

#: Ampersands that begin no reference that a semicolon closes.
_OPEN = re.compile(r"&(?!(?:[A-Za-z][A-Za-z0-9]*|#[0-9]+|#[Xx][0-9A-Fa-f]+);)")

_BOMS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF32_LE, "utf-32"), (codecs.BOM_UTF32_BE, "utf-32"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16"))
_DECLARED = re.compile(rb"<meta[^>]{1,500}?charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:-]+)", re.IGNORECASE)


def charset(data: bytes) -> str:
    """By the byte order mark, the declaration in the first 1,024 bytes if the bytes keep to it, else the first of UTF-8, GB 18030 and Latin-1 that they keep to."""
    for mark, name in _BOMS:
        if data.startswith(mark):
            return name
    declared = _DECLARED.search(data[:1024])
    for name in ([declared.group(1).decode("ascii")] if declared else []) + ["utf-8", "gb18030"]:
        try:
            data.decode(name)
            return codecs.lookup(name).name
        except (LookupError, UnicodeDecodeError):
            continue
    return "latin-1"


def decode(data: bytes) -> tuple[str, str]:
    """The characters, without a byte order mark, and the charset."""
    name = charset(data)
    return data.decode(name).removeprefix("\ufeff"), name


class Element:
    __slots__ = ("tag", "attrs", "parts", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None) -> None:
        self.tag, self.attrs, self.parent, self.parts = tag, attrs, parent, []

    def walk(self) -> Iterator[Element]:
        """Itself and what is below it, in page order."""
        todo = [self]
        while todo:
            e = todo.pop()
            yield e
            todo.extend(p for p in reversed(e.parts) if isinstance(p, Element))

    def text(self, dropped: frozenset[str] = DROPPED) -> str:
        """Its strings, trimmed, one a line, without those of ``dropped`` elements."""
        todo, out = [self], []
        while todo:
            e = todo.pop()
            if isinstance(e, str):
                if e := e.strip():
                    out.append(e)
            elif e.tag not in dropped:
                todo.extend(reversed(e.parts))
        return "\n".join(out)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ENDS_OWN:
            e = self.at
            while e.parent is not None and e.tag not in SCOPES and e.tag != tag:
                e = e.parent
            if e.tag == tag:
                self.at = e.parent
        e = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.parts.append(e)
        if tag not in VOID:
            self.at = e

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # a slash ends void elements only

    def handle_endtag(self, tag: str) -> None:
        e = self.at
        while e.parent is not None and e.tag != tag:
            e = e.parent
        if e.parent is not None:
            self.at = e.parent

    def handle_data(self, data: str) -> None:
        self.at.parts.append(data)


def tree(html: str) -> Element:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


class Selector:
    """``tag``, ``.class``, ``#id``, ``[attr]`` and ``[attr=value]``, joined or, with blanks, nested."""

    _PIECE = re.compile(r"([.#]?)([\w-]+)|\[([\w-]+)(?:=[\"']?([^\]\"']*)[\"']?)?\]")

    def __init__(self, text: str) -> None:
        self.text = text
        self.steps = []
        for part in text.split():
            tests = [(m[1], m[2], m[3], m[4]) for m in self._PIECE.finditer(part)]
            if not tests or "".join(m[0] for m in self._PIECE.finditer(part)) != part:
                raise ValueError(f"not a selector: {text}")
            self.steps.append(tests)
        if not self.steps:
            raise ValueError("an empty selector")

    @staticmethod
    def _is(e: Element, tests: list) -> bool:
        for sign, name, attr, value in tests:
            if attr is not None:
                if attr not in e.attrs or (value is not None and e.attrs[attr] != value):
                    return False
            elif sign == "." and name not in e.attrs.get("class", "").split():
                return False
            elif sign == "#" and e.attrs.get("id") != name:
                return False
            elif sign == "" and e.tag != name.lower():
                return False
        return True

    def matches(self, e: Element) -> bool:
        if not self._is(e, self.steps[-1]):
            return False
        left = len(self.steps) - 2
        while left >= 0:
            e = e.parent
            if e is None:
                return False
            if self._is(e, self.steps[left]):
                left -= 1
        return True

    def first(self, root: Element) -> Element | None:
        return next((e for e in root.walk() if self.matches(e)), None)


def main_text(html: str, selectors: Sequence[Selector], least: int = 100, open_references: bool = True) -> tuple[str, str | None]:
    """Text of the first selector's first element if it has over ``least`` characters, and the selector; else the body's (or the whole page's), and None.

    By the HTML standard ``&amp`` without a semicolon is a reference too; without ``open_references`` it is text.
    """
    if not open_references:
        mark = next(c for c in map(chr, range(0xE000, 0x110000)) if c not in html)
        text, selector = main_text(_OPEN.sub(mark, html), selectors, least)
        return text.replace(mark, "&"), selector
    root = tree(html)
    for s in selectors:
        found = s.first(root)
        if found is not None:
            text = found.text()
            if len(text.replace("\n", "")) > least:
                return text, s.text
    body = next((e for e in root.walk() if e.tag == "body"), root)
    return body.text(), None


def page_text(data: Column | str, selectors: Sequence[str] = CONTAINERS, least: int = 100, open_references: bool = True) -> Column:
    """Struct of text, selector and charset of a page's bytes; nulls for a null page."""
    selectors = tuple(selectors)

    def work(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ladder = [Selector(s) for s in selectors]
        for pages in batches:
            rows = []
            for data in pages:
                if data is None:
                    rows.append((None, None, None))
                    continue
                html, name = decode(bytes(data))
                rows.append((*main_text(html, ladder, least, open_references), name))
            yield pd.DataFrame(rows, columns=["text", "selector", "charset"])

    return F.pandas_udf(work, "text string, selector string, charset string")(data)
