"""Web pages. Python touches a page once, to close its tags; searching it is native XPath."""

from __future__ import annotations

import re
from bisect import bisect_right, insort
from collections.abc import Iterator
from html import escape, unescape
from html.parser import HTMLParser
from itertools import islice
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from statloom.operators.keys import spread

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# An element that may stay open, and the tags that end it.
_BLOCKS = frozenset("address article aside blockquote div dl footer form h1 h2 h3 h4 h5 h6 header hr main "
                    "nav ol p pre section table ul".split())
_CLOSED_BY = {
    "p": _BLOCKS,
    "li": frozenset(["li"]),
    "option": frozenset(["option"]),
    "td": frozenset(["td", "th", "tr", "tbody"]),
    "th": frozenset(["td", "th", "tr", "tbody"]),
    "tr": frozenset(["tr", "tbody"]),
}
_NOT_XML = re.compile("[^\t\n\r\x20-\ud7ff\ue000-\ufffd\U00010000-\U0010ffff]")
_NAME = re.compile(r"[A-Za-z_][\w.-]*\Z")


class PageReader(HTMLParser):
    """Reads the tags of a page and closes what is left open: ``on_start``, ``on_end`` and ``on_text`` come in
    well-formed order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.counts: dict[str, int] = {}

    def on_start(self, tag: str, attributes: dict[str, str], void: bool) -> None:
        raise NotImplementedError

    def on_end(self, tag: str) -> None:
        raise NotImplementedError

    def on_text(self, data: str) -> None:
        raise NotImplementedError

    def _end_last(self):
        tag = self.open.pop()
        self.counts[tag] -= 1
        self.on_end(tag)

    def handle_starttag(self, tag, attrs):
        if not _NAME.match(tag):
            return
        while self.open and tag in _CLOSED_BY.get(self.open[-1], ()):
            self._end_last()
        self.on_start(tag, {name: value or "" for name, value in reversed(attrs) if _NAME.match(name)}, tag in _VOID)
        if tag not in _VOID:
            self.open.append(tag)
            self.counts[tag] = self.counts.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.counts.get(tag):
            while self.open[-1] != tag:
                self._end_last()
            self._end_last()

    def handle_data(self, data):
        self.on_text(data)


class _Closer(PageReader):
    """Collects a page as well-formed XML."""

    def __init__(self):
        super().__init__()
        self.out: list[str] = []

    def on_start(self, tag, attributes, void):
        text = "".join(f' {name}="{escape(value)}"' for name, value in attributes.items())
        self.out.append(f"<{tag}{text}/>" if void else f"<{tag}{text}>")

    def on_end(self, tag):
        self.out.append(f"</{tag}>")

    def on_text(self, data):
        self.out.append(escape(data, quote=False))

    def document(self) -> str:
        self.close()
        tail = "".join(f"</{tag}>" for tag in reversed(self.open))
        return _NOT_XML.sub("", f"<page>{''.join(self.out)}{tail}</page>")


def _closed(html: str | None) -> str | None:
    if html is None:
        return None
    closer = _Closer()
    closer.feed(html)
    return closer.document()


@F.pandas_udf(StringType())
def page_xml(html: pd.Series) -> pd.Series:
    """A page as well-formed XML under a ``<page>`` root."""
    return html.map(_closed)


def has_element(xml: Column, path: str) -> Column:
    return F.xpath_boolean(xml, F.lit(f"boolean({path})"))


def element_text(xml: Column, path: str) -> Column:
    """Text of the first element on the path."""
    return F.xpath_string(xml, F.lit(path))


_CSS_PART = re.compile(r"""
    (?P<kind>[#.])(?P<name>[\w-]+)
    | \[\s*(?P<key>[\w-]+)\s*(?:(?P<how>[~|^$*]?=)\s*(?P<value>"[^"]*"|'[^']*'|[\w-]+)\s*)?\]
    | :(?P<place>first-child|last-child|nth-child\(\s*(?P<nth>\d+)\s*\))
""", re.X)
_CSS_TAG = re.compile(r"[A-Za-z][\w-]*|\*")
_CSS_STEP = re.compile(r"\s*(?P<step>[>+~,])\s*|\s+")
_CSS_AXES = {None: "//", ">": "/", "~": "/following-sibling::", "+": "/following-sibling::*[1]/self::"}


def _listed(key: str, word: str) -> str:
    return f"contains(concat(' ', normalize-space(@{key}), ' '), {word})"


def _css_test(part: re.Match) -> str:
    """The XPath predicate of one part of a compound selector."""
    if part["kind"] == "#":
        return f"[@id='{part['name']}']"
    if part["kind"] == ".":
        return f"[{_listed('class', repr(' ' + part['name'] + ' '))}]"
    if part["place"]:
        if part["place"] == "last-child":
            return "[not(following-sibling::*)]"
        return f"[count(preceding-sibling::*)={int(part['nth'] or 1) - 1}]"
    key = part["key"].lower()
    if not part["how"]:
        return f"[@{key}]"
    value = part["value"] if part["value"][0] in "\"'" else f"'{part['value']}'"
    plain = value[1:-1]
    if part["how"] == "=":
        return f"[@{key}={value}]"
    if part["how"] == "|=":
        return f"[@{key}={value} or starts-with(@{key}, {value[0]}{plain}-{value[0]})]"
    if not plain or part["how"] == "~=" and " " in plain:
        return "[false()]"  # by the rules of CSS such a test holds nowhere
    return {
        "~=": f"[{_listed(key, f'{value[0]} {plain} {value[0]}')}]",
        "^=": f"[starts-with(@{key}, {value})]",
        "*=": f"[contains(@{key}, {value})]",
        "$=": f"[substring(@{key}, string-length(@{key}) - {len(plain) - 1})={value}]",
    }[part["how"]]


def css_path(selector: str) -> str:
    """XPath of a CSS selector: tags, ``#id``, ``.class``, attribute tests, first, last and nth child,
    joined by blanks, ``>``, ``+``, ``~`` and commas. Anything else is an error."""
    paths, axis, at, text = [""], "//", 0, selector.strip()
    while True:
        tag = _CSS_TAG.match(text, at)
        begin, at = at, tag.end() if tag else at
        tests, places = [], []
        while part := _CSS_PART.match(text, at):
            # Among the children of an element a place is a position, told without looking at the others.
            if part["place"] and axis in ("//", "/"):
                places.append("[last()]" if part["place"] == "last-child" else f"[{int(part['nth'] or 1)}]")
            else:
                tests.append(_css_test(part))
            at = part.end()
        step = _CSS_STEP.match(text, at)
        if at == begin or not step and at < len(text):
            raise ValueError(f"not a supported CSS selector: {selector}")
        name = tag[0].lower() if tag else "*"
        if len(places) > 1:
            tests += [_css_test(part) for part in _CSS_PART.finditer(text, begin, at) if part["place"]]
            places = []
        paths[-1] += axis + (f"*{places[0]}" + f"[self::{name}]" * (name != "*") if places else name) + "".join(tests)
        if not step:
            return " | ".join(paths)
        at = step.end()
        if step["step"] == ",":
            paths.append("")
        axis = "//" if step["step"] == "," else _CSS_AXES[step["step"]]


def links(html: Column) -> Column:
    """``array<struct<href, text>>`` of the plain links of a page, in page order, without Python."""
    pattern = F.lit(r"""<a\s[^>]*?href="([^"]*)"[^>]*>([^<]*)</a>""")
    return F.arrays_zip(
        F.regexp_extract_all(html, pattern, F.lit(1)).alias("href"),
        F.regexp_extract_all(html, pattern, F.lit(2)).alias("text"),
    )


# Comments and scripts are passed over; the star is possessive, so that an open tag costs one look.
_ATTRIBUTES = r"""(?:[^>"'=]++|=\s*(?>"[^"]*"|'[^']*')|["'=])*+"""
_TOKEN = re.compile(
    rf"""<!--.*?-->|<(?P<raw>script|style)\b.*?</(?P=raw)\s*>
    |<(?P<end>/?)(?P<tag>table|tr|td|th|br)\b(?P<attrs>{_ATTRIBUTES})>
    |</?[a-z!?]{_ATTRIBUTES}>|(?P<text>[^<]+|<)""",
    re.S | re.I | re.X,
)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|rowspan|colspan)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


#: The most rows or columns that a cell may span, as browsers have it.
MOST_SPAN = 65_534
#: Cells that are handed on together.
CELLS_AT_ONCE = 10_000


class _Span(NamedTuple):
    """Columns of a row that a cell takes, and how many more rows it takes them in."""

    first: int
    end: int
    rows: int
    text: str


def _apart(spans: list[_Span]) -> list[_Span]:
    """Spans in the order of their columns; where some overlap, the column goes to the one given first."""
    found = sorted(spans, key=lambda s: s.first)
    if all(a.end <= b.first for a, b in zip(found, found[1:])):
        return found
    made: list[_Span] = []
    for span in spans:
        at = span.first
        for other in made[bisect_right(made, span.first, key=lambda s: s.end):]:
            if other.first >= span.end:
                break
            if at < other.first:
                insort(made, span._replace(first=at, end=other.first), key=lambda s: s.first)
            at = max(at, other.end)
        if at < span.end:
            insort(made, span._replace(first=at), key=lambda s: s.first)
    return made


class _Table:
    """A table that is being read; a spanned cell is repeated over its span, row by row as the rows come.

    Kept are the spans that go on below the row, not the cells they will make.
    """

    def __init__(self, number: int | None):
        self.number = number
        self.row = -1
        self.text: list[str] | None = None
        self.span = (1, 1)
        self.spans: list[_Span] = []  # that go on below, in the order they were opened
        self.taken: list[_Span] = []  # columns of this row that spans from above take
        self.at = self.column = 0

    def _cells(self, first: int, end: int, text: str) -> Iterator[tuple[int, int, int, str]]:
        return ((self.number, self.row, column, text) for column in range(first, end))

    def open_row(self) -> Iterator[tuple[int, int, int, str]]:
        yield from self.end_cell()
        self.row += 1
        self.taken, self.at, self.column = _apart(self.spans), 0, 0
        self.spans = [s._replace(rows=s.rows - 1) for s in self.spans if s.rows > 1]
        for span in self.taken:
            yield from self._cells(span.first, span.end, span.text)

    def open_cell(self, attributes: dict[str, str]) -> Iterator[tuple[int, int, int, str]]:
        yield from self.end_cell()
        if self.row < 0:
            yield from self.open_row()
        self.text = []
        sizes = (attributes.get(name, "") for name in ("rowspan", "colspan"))
        self.span = tuple(min(max(int(size), 1), MOST_SPAN) if size.isdecimal() and len(size) < 20 else 1 for size in sizes)

    def end_cell(self) -> Iterator[tuple[int, int, int, str]]:
        if self.text is None:
            return
        text = " ".join(unescape("".join(self.text)).split())
        self.text = None
        rows, columns = self.span
        while self.at < len(self.taken) and self.taken[self.at].first <= self.column:
            self.column = max(self.column, self.taken[self.at].end)
            self.at += 1
        first, end = self.column, self.column + columns
        if rows > 1:
            self.spans.append(_Span(first, end, rows - 1, text))
        while self.at < len(self.taken) and self.taken[self.at].first < end:
            yield from self._cells(first, self.taken[self.at].first, text)
            first = max(first, self.taken[self.at].end)
            self.at += 1
        yield from self._cells(first, end, text)
        self.column = max(first, end)

    def end(self) -> Iterator[tuple[int, int, int, str]]:
        """What is left: cells may span rows that are not there."""
        yield from self.end_cell()
        while self.spans:
            yield from self.open_row()


def _table_cells(html: str, class_name: str | None) -> Iterator[tuple[int, int, int, str]]:
    """``table_no, row, col, text`` of all tables of a class, numbered in page order."""
    count, stack = 0, []
    for token in _TOKEN.finditer(html):
        tag, text = token["tag"], token["text"]
        if text is not None:
            if stack and stack[-1].text is not None:
                stack[-1].text.append(text)
            continue
        if tag is None:
            continue
        tag, made = tag.lower(), ()
        if tag == "table" and not token["end"]:
            attributes = _attributes(token["attrs"])
            wanted = class_name is None or attributes.get("class") == class_name
            stack.append(_Table(count if wanted else None))
            count += wanted
        elif not stack:
            continue
        elif tag == "table":
            made = stack[-1].end()
        elif tag == "br":
            if stack[-1].text is not None:
                stack[-1].text.append(" ")
        elif token["end"]:
            made = stack[-1].end_cell()
        elif tag == "tr":
            made = stack[-1].open_row()
        else:
            made = stack[-1].open_cell(_attributes(token["attrs"]))
        if stack[-1].number is not None:
            yield from made
        else:
            stack[-1].text = [] if stack[-1].text is not None else None  # a table nobody asked for is not built
        if tag == "table" and token["end"]:
            stack.pop()
    for table in reversed(stack):
        if table.number is not None:
            yield from table.end()


def _attributes(text: str) -> dict[str, str]:
    if not text or "=" not in text:
        return {}
    return {name.lower(): a or b or c for name, a, b, c in _ATTRIBUTE.findall(text)}


def html_tables(pages: DataFrame, key: str, html: str, class_name: str | None = None) -> DataFrame:
    """``key, table_no, row, col, text`` for every table cell, optionally of tables of one class.

    A spanned cell is repeated over its span, of ``MOST_SPAN`` rows and columns at most, and in no column that an
    earlier cell takes. Cells leave the task as they are made.
    """
    key_type = pages.schema[key].dataType.simpleString()

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [key, "table_no", "row", "col", "text"]
        for batch in batches:
            found = ((page, *cell) for page, text in zip(batch[key], batch[html]) for cell in _table_cells(text or "", class_name))
            while part := list(islice(found, CELLS_AT_ONCE)):
                yield pd.DataFrame(part, columns=names)

    return spread(pages.select(key, html), key).mapInPandas(
        cells, f"`{key}` {key_type}, table_no int, row int, col int, text string"
    )
