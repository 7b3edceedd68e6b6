"""Stored HTML pages to cell rows and selected texts, page by page in parallel."""
from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = {"br", "img", "hr", "meta", "link", "input", "source", "wbr", "col", "area", "base", "embed", "track"}
# fixed values: elements whose end tag may be left out, by the tags that end them, and what keeps them open
_BLOCKS = ("p", "div", "ul", "ol", "dl", "table", "section", "h1", "h2", "h3", "h4", "h5", "h6")
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), **{b: ("p",) for b in _BLOCKS}}
FENCES = {"ul", "ol", "dl", "select", "table", "td", "th", "div", "section", "body", "li", "dd", "blockquote"}
BREAKS = {"br", "p", "div", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "table", "section"}
# a comment, a script or style with its content, a declaration, or one tag
ATTRIBUTES = r"""(?:[^>"']++|"[^"]*"|'[^']*')*+"""
CUT = re.compile(
    rf"""(<!--.*?-->|<(?i:script)\b.*?</(?i:script)\s*>|<(?i:style)\b.*?</(?i:style)\s*>|<[!?][^>]*>"""
    rf"""|</?[a-zA-Z][a-zA-Z0-9]*{ATTRIBUTES}>)""", re.DOTALL)
TAG = re.compile(rf"""<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9]*)(?P<attributes>{ATTRIBUTES})>""")
SILENT = re.compile(r"<(script|style)\b.*</\1\s*>", re.DOTALL | re.IGNORECASE)


def _tidy(parts: list[str]) -> str:
    text = "".join(parts).strip("\n")
    if "\n" not in text:
        return " ".join(text.split())
    lines = text.split("\n")
    return "\n".join(t for t in (" ".join(line.split()) for line in lines) if t)


TAGS: dict[str, tuple[str, str, str]] = {}  # plain, so that they go to the tasks with the functions
CLASSES: dict[str, tuple[str, ...]] = {}


def _kept(cache: dict, text: str, read):
    """What was read off a text; long ones (comments, scripts) are not met again and not kept."""
    found = cache.get(text)
    if found is None:
        found = read(text)
        if len(text) <= 200:
            if len(cache) >= 10_000:
                cache.clear()
            cache[text] = found
    return found


def _tag(text: str) -> tuple[str, str, str]:
    """("/" when closing, tag name, attributes) of one tag; pages use the same few again and again."""
    found = None if SILENT.match(text) else TAG.fullmatch(text)
    return (found["close"], found["name"].lower(), found["attributes"]) if found else ("", "", "")


def _tags(html: str) -> Iterator[tuple[str, str, str, str]]:
    """(text before, "/" when closing, tag name, attributes) for each tag, then the rest."""
    pieces = CUT.split(html)
    for text, tag in zip(pieces[::2], pieces[1::2]):
        yield text, *_kept(TAGS, tag, _tag)
    yield pieces[-1], "", "", ""


def _attribute(attributes: str, name: str) -> str:
    found = re.search(rf"""\b{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", attributes, re.IGNORECASE)
    return next((g for g in found.groups() if g is not None), "") if found else ""


def _classes(attributes: str) -> tuple[str, ...]:
    return tuple(_attribute(attributes, "class").split())


def _span(attributes: str, name: str) -> int:
    if name not in attributes.lower():
        return 1
    text = _attribute(attributes, name).strip()
    return max(1, int(text)) if text.isdigit() else 1


def _cell_text(parts: list[str]) -> str:
    text = "".join(parts)
    return " ".join((unescape(text) if "&" in text else text).split())


class _Open:
    """A table being read: finished rows, the open row and cell, cells spanning down."""

    def __init__(self, rows: list):
        self.rows, self.row, self.cell = rows, None, None
        self.across = self.deep = 1
        self.pending: dict[int, tuple[str, int]] = {}
        self.later: dict[int, tuple[str, int]] = {}

    def _carry(self):
        while len(self.row) in self.pending:
            text, left = self.pending.pop(len(self.row))
            if left > 1:
                self.later[len(self.row)] = (text, left - 1)
            self.row.append(text)

    def end_cell(self):
        if self.cell is None:
            return
        text, self.cell = _cell_text(self.cell), None
        self._carry()
        for _ in range(self.across):
            if self.deep > 1:
                self.later[len(self.row)] = (text, self.deep - 1)
            self.row.append(text)

    def end_row(self):
        self.end_cell()
        if self.row is None:
            return
        self._carry()
        self.rows.append(self.row)
        self.row = None
        self.pending, self.later = {**self.pending, **self.later}, {}

    def start_cell(self, attributes: str):
        self.end_cell()
        if self.row is None:
            self.row = []
        self.across, self.deep = _span(attributes, "colspan"), _span(attributes, "rowspan")
        self.cell = []


def _read_tables(html: str) -> list[list[list[str]]]:
    """Cell texts per table and row; ``colspan`` repeats a cell, ``rowspan`` carries it down."""
    tables: list[list[list[str]]] = []
    stack: list[_Open] = []
    for text, closing, name, attributes in _tags(html):
        if text and stack and stack[-1].cell is not None:
            stack[-1].cell.append(text)
        if name == "table":
            if not closing:
                tables.append([])
                stack.append(_Open(tables[-1]))
            elif stack:
                stack.pop().end_row()
        elif not stack:
            continue
        elif name == "tr":
            stack[-1].end_row()
            if not closing:
                stack[-1].row = []
        elif name in ("td", "th"):
            if closing:
                stack[-1].end_cell()
            else:
                stack[-1].start_cell(attributes)
        elif name in BREAKS and stack[-1].cell is not None:
            stack[-1].cell.append(" ")
    while stack:
        stack.pop().end_row()
    return tables


def _read_texts(html: str, selectors: Sequence[str]) -> dict[str, list[str]]:
    """Texts of elements that match simple selectors (``tag``, ``.class``, ``tag.class``).

    Texts are kept once; an element is the stretch of them between its tags. Items of lists and
    options end where the next one begins, paragraphs at the next block, if their end tag is left out.
    """
    wanted = [(s, *s.partition(".")[::2]) for s in selectors]
    plain = {tag for _, tag, label in wanted if not label}  # a tag without attributes can match these only; "" is any
    parts: list[str] = []
    found: dict[str, list[list[int]]] = {s: [] for s in selectors}
    stack: list[tuple[str, list[list[int]]]] = []
    opened: defaultdict[str, int] = defaultdict(int)

    def close(name: str) -> None:
        last = None
        while last != name:
            last, spans = stack.pop()
            opened[last] -= 1
            for span in spans:
                span[1] = len(parts)

    for text, closing, name, attributes in _tags(html):
        if text:
            parts.append((unescape(text) if "&" in text else text).replace("\n", " "))
        if closing:
            if name in BREAKS:
                parts.append("\n")
            if opened[name]:
                close(name)
        elif name:
            for ended in ENDS.get(name, ()):
                if opened[ended] and not _fenced(stack, ended):
                    close(ended)
            if name in BREAKS:
                parts.append("\n")
            spans = []
            if attributes or name in plain or "" in plain:
                classes = _kept(CLASSES, attributes, _classes) if attributes else ()
                for selector, tag, label in wanted:
                    if (not tag or tag == name) and (not label or label in classes):
                        spans.append([len(parts), -1])
                        found[selector].append(spans[-1])
            if name in VOID or attributes.endswith("/"):
                for span in spans:
                    span[1] = span[0]
            else:
                stack.append((name, spans))
                opened[name] += 1
    return {s: [_tidy(parts[a:b if b >= 0 else len(parts)]) for a, b in spans] for s, spans in found.items()}


def _fenced(stack: list[tuple[str, list[list[int]]]], name: str) -> bool:
    """Whether the innermost open ``name`` lies outside a list, table or block that is open too. The search ends at
    the first of them, so it is as long as the inline tags in between."""
    for opened, _ in reversed(stack):
        if opened == name:
            return False
        if opened in FENCES:
            return True
    return True


def table_rows(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """All table rows of all pages: (page_id, table_no, row_no, cells)."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text in zip(batch["page_id"], batch["html"]):
                for t, table in enumerate(_read_tables(text or ""), 1):
                    rows += [(key, t, r, cells) for r, cells in enumerate(table, 1)]
            yield pd.DataFrame(rows, columns=["page_id", "table_no", "row_no", "cells"])

    kind = pages.schema[page_id].dataType.simpleString()
    return pages.select(F.col(page_id).alias("page_id"), F.col(html).alias("html")).mapInPandas(
        parse, f"page_id {kind}, table_no int, row_no int, cells array<string>"
    )


def table_columns(rows: DataFrame, table_no: int, width: int) -> DataFrame:
    """One table per page as columns ``X1 .. Xwidth``; cells beyond a row's end are missing."""
    cells = [F.get("cells", F.lit(i)).alias(f"X{i + 1}") for i in range(width)]
    return rows.where(F.col("table_no") == table_no).select("page_id", "row_no", *cells)


def selected_texts(pages: DataFrame, page_id: str, html: str, selectors: Sequence[str], whole: bool = False) -> DataFrame:
    """Texts by selector in page order: (page_id, selector, pos, text), pos from 0.

    ``whole`` keeps the texts of a page and selector together: (page_id, selector, texts), for what is done page by page.
    """
    selectors = list(selectors)
    columns = ["page_id", "selector", "texts"] if whole else ["page_id", "selector", "pos", "text"]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text in zip(batch["page_id"], batch["html"]):
                for selector, texts in _read_texts(text or "", selectors).items():
                    if whole:
                        rows += [(key, selector, texts)] if texts else []
                    else:
                        rows += [(key, selector, i, found) for i, found in enumerate(texts)]
            yield pd.DataFrame(rows, columns=columns)

    kind = pages.schema[page_id].dataType.simpleString()
    return pages.select(F.col(page_id).alias("page_id"), F.col(html).alias("html")).mapInPandas(
        parse, f"page_id {kind}, selector string, " + ("texts array<string>" if whole else "pos int, text string")
    )


def parallel_vectors(texts: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Equal-length selector vectors side by side, ``{selector: column}``."""
    spread = [F.max(F.when(F.col("selector") == s, F.col("text"))).alias(c) for s, c in columns.items()]
    return texts.groupBy("page_id", "pos").agg(*spread)
