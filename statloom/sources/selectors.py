"""Finding elements of a page by many selectors in one reading of its tags.

A selector is a path of steps, so the selectors of a page form a tree by their common beginnings: each
beginning is followed once, however many selectors share it. Selectors are data here, other than those of
Spark's XPath functions, which have to be constants of the plan.

Supported are paths of XPath 1.0 over elements: all axes but namespace, tests by name and ``*``, predicates
with positions, ``and``, ``or``, comparisons, attributes, ``text()``, inner paths and the usual functions of
strings, numbers and sets, joined by ``|``; and CSS as in ``html.css_path``. Anything else is an error of that
selector alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from statloom.sources.html import PageReader, css_path


class Element:
    __slots__ = ("tag", "attributes", "parent", "children", "at", "end", "first", "last", "own", "broken", "place")

    def __init__(self, tag, attributes, parent, at, first):
        self.tag, self.attributes, self.parent, self.children = tag, attributes, parent, []
        self.place = len(parent.children) if parent else 0  # among its siblings
        self.at = at  # place in the page, and of what comes behind it
        self.end = at + 1
        self.first = self.last = first  # its texts
        self.own: list[str] = []  # runs of text directly below it
        self.broken = True


class Page(PageReader):
    """The elements of a page in their order, below a root without a tag."""

    def __init__(self, html: str):
        super().__init__()
        self.texts: list[str] = []
        self.elements = [Element("", {}, None, 0, 0)]
        self.path = [self.elements[0]]
        self.found: dict[tuple, list[Element]] = {}
        self.attributes: dict[tuple[str, str], list[Element]] = {}
        self.feed(html)
        self.close()
        for element in self.path:
            element.end, element.last = len(self.elements), len(self.texts)
        self.by_tag: dict[str, list[Element]] = {}
        for element in self.elements[1:]:
            self.by_tag.setdefault(element.tag, []).append(element)

    def on_start(self, tag, attributes, void):
        parent = self.path[-1]
        parent.broken = True
        element = Element(tag, attributes, parent, len(self.elements), len(self.texts))
        parent.children.append(element)
        self.elements.append(element)
        if not void:
            self.path.append(element)

    def on_end(self, tag):
        element = self.path.pop()
        element.end, element.last = len(self.elements), len(self.texts)

    def on_text(self, data):
        self.texts.append(data)
        parent = self.path[-1]
        if parent.broken:
            parent.own.append(data)
            parent.broken = False
        else:
            parent.own[-1] += data

    def by_attribute(self) -> dict[tuple[str, str], list[Element]]:
        if not self.attributes:
            for element in self.elements:
                for item in element.attributes.items():
                    self.attributes.setdefault(item, []).append(element)
        return self.attributes

    def text(self, element: Element) -> str:
        return "".join(self.texts[element.first:element.last])

    def first(self, selector: Selector) -> Element | None:
        """The first element of the page that the selector finds."""
        found = (e for path in selector for e in path.nodes(self, self.elements[0])[:2] if e.tag)
        return min(found, key=lambda e: e.at, default=None)


# ---- axes

def _siblings(element: Element) -> list[Element]:
    return element.parent.children if element.parent else [element]


def _ancestors(element: Element) -> list[Element]:
    found = []
    while element.parent:
        element = element.parent
        found.append(element)
    return found


# Nodes of an axis in its own order: those that look back give the nearest first.
_AXES: dict[str, Callable[[Page, Element], list[Element]]] = {
    "child": lambda page, e: e.children,
    "self": lambda page, e: [e],
    "parent": lambda page, e: [e.parent] if e.parent else [],
    "descendant": lambda page, e: page.elements[e.at + 1:e.end],
    "descendant-or-self": lambda page, e: page.elements[e.at:e.end],
    "ancestor": lambda page, e: _ancestors(e),
    "ancestor-or-self": lambda page, e: [e, *_ancestors(e)],
    "following-sibling": lambda page, e: _siblings(e)[e.place + 1:],
    "preceding-sibling": lambda page, e: _siblings(e)[:e.place][::-1],
    "following": lambda page, e: page.elements[e.end:],
    "preceding": lambda page, e: [x for x in page.elements[1:e.at] if x.end <= e.at][::-1],
}


class Step:
    """``equal``: the attribute and its value that the first predicate asks for, if it asks for one."""

    def __init__(self, axis: str, test: str, tests: list, source: str, equal: tuple[str, str] | None):
        self.axis, self.test, self.tests, self.source, self.equal = axis, test, tests, source, equal

    def _kept(self, page: Page, nodes: list) -> list:
        for wanted in self.tests:
            size, kept = len(nodes), []
            for place, node in enumerate(nodes, 1):
                value = wanted(page, node, place, size)
                if value == place if isinstance(value, float) else _truth(value):
                    kept.append(node)
            nodes = kept
        return nodes

    def nodes(self, page: Page, context: Element) -> list:
        if self.axis == "attribute":
            return [context.attributes[self.test]] if self.test in context.attributes else []
        if self.test == "text()":
            return self._kept(page, context.own) if self.axis == "child" else []
        found = _AXES[self.axis](page, context)
        if self.test != "node()":  # the root is a node, but no element
            found = [e for e in found if e.tag and self.test in ("*", e.tag)]
        return self._kept(page, found)

    def below(self, page: Page, contexts: list[Element]) -> list[Element]:
        """The step from all that is below the contexts, when its axis is ``child``: places count by parent."""
        groups: dict[int, list[Element]] = {}
        every = page.elements[1:] if self.test == "*" else page.by_tag.get(self.test, [])
        if self.equal:
            every = [e for e in page.by_attribute().get(self.equal, ()) if self.test in ("*", e.tag)]
        end = -1
        spans = [(e.at, end := e.end) for e in contexts if e.at >= end]  # contexts inside others add nothing
        span = 0
        for element in every:
            while span < len(spans) and spans[span][1] <= element.at:
                span += 1
            if span < len(spans) and spans[span][0] < element.at:
                groups.setdefault(element.parent.at, []).append(element)
        return [e for group in groups.values() for e in self._kept(page, group)]


class Path:
    def __init__(self, absolute: bool, steps: list[Step | None]):
        self.absolute, self.steps = absolute, steps  # None stands for //

    def nodes(self, page: Page, context: Element) -> list:
        """Elements in page order, or strings of attributes and texts."""
        shared = self.absolute or context.parent is None
        nodes, deep, begun = [page.elements[0] if self.absolute else context], False, []
        for step in self.steps:
            begun.append(step.source if step else "//")
            if step is None:
                deep = True
                continue
            key = tuple(begun)
            if shared and key in page.found:
                nodes, deep = page.found[key], False
                continue
            if deep and step.axis == "child" and step.test not in ("text()", "node()"):
                found = step.below(page, nodes)
            else:
                if deep:
                    nodes = _ordered([x for n in nodes for x in page.elements[n.at:n.end]])
                found = [x for n in nodes for x in step.nodes(page, n)]
            nodes, deep = _ordered(found), False
            if shared:
                page.found[key] = nodes
        return nodes


#: The paths that a selector joins by ``|``.
Selector = list[Path]


def _ordered(nodes: list) -> list:
    if not nodes or isinstance(nodes[0], str):
        return nodes
    return [e for _, e in sorted({e.at: e for e in nodes}.items())]


# ---- values

def _truth(value) -> bool:
    return bool(value) and value == value if isinstance(value, float) else bool(value)


def _string(page: Page, value) -> str:
    if isinstance(value, list):
        return _string(page, value[0]) if value else ""
    if isinstance(value, Element):
        return page.text(value)
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return str(int(value)) if value == value and value == int(value) else str(value)
    return value


def _number(page: Page, value) -> float:
    if isinstance(value, (bool, float)):
        return float(value)
    text = _string(page, value).strip()
    return float(text) if re.fullmatch(r"-?(\d+(\.\d*)?|\.\d+)", text) else float("nan")


def _compared(page: Page, how: str, a, b) -> bool:
    if isinstance(a, list) and not isinstance(b, bool):
        return any(_compared(page, how, _string(page, x), b) for x in a)
    if isinstance(b, list) and not isinstance(a, bool):
        return any(_compared(page, how, a, _string(page, x)) for x in b)
    if how in ("=", "!="):
        if isinstance(a, bool) or isinstance(b, bool):
            same = _truth(a) == _truth(b)
        elif isinstance(a, float) or isinstance(b, float):
            same = _number(page, a) == _number(page, b)
        else:
            same = a == b
        return same == (how == "=")
    a, b = _number(page, a), _number(page, b)
    return {"<": a < b, ">": a > b, "<=": a <= b, ">=": a >= b}[how]


def _part(text: str, start: float, size: float | None = None) -> str:
    """``substring``: places from 1, ends rounded."""
    first = int(start + 0.5)
    last = len(text) if size is None else int(start + 0.5) + int(size + 0.5) - 1
    return text[max(0, first - 1):max(0, last)]


def _size(nodes) -> float:
    if not isinstance(nodes, list):
        raise TypeError("count of what is no set")
    return float(len(nodes))


# Least and most arguments, and the function of the page, the node and the arguments.
_FUNCTIONS: dict[str, tuple[int, int, Callable]] = {
    "not": (1, 1, lambda page, node, a: not _truth(a)),
    "true": (0, 0, lambda page, node: True),
    "false": (0, 0, lambda page, node: False),
    "boolean": (1, 1, lambda page, node, a: _truth(a)),
    "count": (1, 1, lambda page, node, a: _size(a)),
    "string": (0, 1, lambda page, node, a=None: _string(page, node if a is None else a)),
    "number": (0, 1, lambda page, node, a=None: _number(page, node if a is None else a)),
    "concat": (2, 99, lambda page, node, *a: "".join(_string(page, x) for x in a)),
    "contains": (2, 2, lambda page, node, a, b: _string(page, b) in _string(page, a)),
    "starts-with": (2, 2, lambda page, node, a, b: _string(page, a).startswith(_string(page, b))),
    "normalize-space": (0, 1, lambda page, node, a=None: " ".join(
        re.findall(r"[^ \t\r\n]+", _string(page, node if a is None else a)))),
    "string-length": (0, 1, lambda page, node, a=None: float(len(_string(page, node if a is None else a)))),
    "substring": (2, 3, lambda page, node, a, *b: _part(_string(page, a), *(_number(page, x) for x in b))),
    "substring-before": (2, 2, lambda page, node, a, b: (
        lambda t, x: t[:t.index(x)] if x in t else "")(_string(page, a), _string(page, b))),
    "substring-after": (2, 2, lambda page, node, a, b: (
        lambda t, x: t[t.index(x) + len(x):] if x in t else "")(_string(page, a), _string(page, b))),
    "translate": (3, 3, lambda page, node, a, b, c: _string(page, a).translate(
        {ord(x): (_string(page, c)[k:k + 1] or None) for k, x in reversed(list(enumerate(_string(page, b))))})),
    "name": (0, 0, lambda page, node: node.tag),
}


# ---- reading a selector

_TOKENS = re.compile(r"""\s*(?:(?P<text>"[^"]*"|'[^']*')|(?P<number>\d+(?:\.\d*)?)|(?P<name>[A-Za-z_][\w.-]*)
    |(?P<sign>//|::|\.\.|!=|<=|>=|[/.@\[\]()|=<>+*,-]))""", re.X)


class _Reader:
    def __init__(self, source: str):
        self.source, self.tokens, at = source, [], 0
        end = len(source.rstrip())
        while at < end:
            token = _TOKENS.match(source, at)
            if not token:
                raise ValueError(source)
            at = token.end()
            self.tokens.append((token.lastgroup, token[token.lastgroup]))
        self.at = 0

    def peek(self, ahead: int = 0) -> tuple[str, str]:
        return self.tokens[self.at + ahead] if self.at + ahead < len(self.tokens) else ("end", "")

    def taken(self, *signs: str) -> str:
        """The sign or word, if it is one of these."""
        if self.peek()[0] in ("sign", "name") and self.peek()[1] in signs:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return ""

    def need(self, sign: str):
        if not self.taken(sign):
            raise ValueError(self.source)

    def selector(self) -> Selector:
        paths = [self.path()]
        while self.taken("|"):
            paths.append(self.path())
        if self.peek()[0] != "end":
            raise ValueError(self.source)
        for path in paths:
            if path.steps and path.steps[-1].axis == "attribute" or path.steps[-1].test == "text()":
                raise ValueError(self.source)
        return paths

    def path(self) -> Path:
        steps, absolute = [], False
        if lead := self.taken("//", "/"):
            absolute = True
            steps += [None] if lead == "//" else []
        while True:
            steps.append(self.step())
            lead = self.taken("//", "/")
            if not lead:
                return Path(absolute, steps)
            steps += [None] if lead == "//" else []

    def step(self) -> Step:
        begin = self.at
        if self.taken(".."):
            axis, test = "parent", "node()"
        elif self.taken("."):
            axis, test = "self", "node()"
        else:
            axis = "attribute" if self.taken("@") else "child"
            if self.peek(1) == ("sign", "::"):
                axis = self.peek()[1]
                self.at += 2
                if axis not in _AXES and axis != "attribute":
                    raise ValueError(self.source)
            kind, test = self.peek()
            if kind != "name" and test != "*" or axis == "attribute" and test == "*":
                raise ValueError(self.source)
            self.at += 1
            if test in ("text", "node") and self.taken("("):
                self.need(")")
                test += "()"
            else:
                test = test.lower()
        tests, first = [], self.at
        while self.taken("["):
            tests.append(self.either())
            self.need("]")
        signs, texts = zip(*self.tokens[first:first + 6]) if tests else ((), ())
        plain = signs == ("sign", "sign", "name", "sign", "text", "sign") and texts[1] == "@" and (texts[3], texts[5]) == ("=", "]")
        return Step(axis, test, tests, repr(self.tokens[begin:self.at]), (texts[2].lower(), texts[4][1:-1]) if plain else None)

    def _joined(self, below: Callable, signs: tuple, made: Callable) -> Callable:
        left = below()
        while sign := self.taken(*signs):
            left = made(sign, left, below())
        return left

    def either(self) -> Callable:
        return self._joined(self.all, ("or",), lambda _, a, b: lambda *at: _truth(a(*at)) or _truth(b(*at)))

    def all(self) -> Callable:
        return self._joined(self.equal, ("and",), lambda _, a, b: lambda *at: _truth(a(*at)) and _truth(b(*at)))

    def equal(self) -> Callable:
        return self._joined(self.sum, ("=", "!=", "<", ">", "<=", ">="),
                            lambda how, a, b: lambda *at: _compared(at[0], how, a(*at), b(*at)))

    def sum(self) -> Callable:
        return self._joined(self.value, ("+", "-"), lambda sign, a, b: lambda *at: (
            _number(at[0], a(*at)) + (1 if sign == "+" else -1) * _number(at[0], b(*at))))

    def value(self) -> Callable:
        kind, text = self.peek()
        if kind in ("text", "number"):
            self.at += 1
            constant = text[1:-1] if kind == "text" else float(text)
            return lambda *at: constant
        if self.taken("("):
            inner = self.either()
            self.need(")")
            return inner
        if kind == "name" and self.peek(1) == ("sign", "(") and text not in ("text", "node"):
            self.at += 2
            return self.function(text)
        path = self.path()
        return lambda page, node, place, size: path.nodes(page, node) if isinstance(node, Element) else (
            [node] if path.steps[0].axis == "self" else [])

    def function(self, name: str) -> Callable:
        inner = []
        while not self.taken(")"):
            if inner:
                self.need(",")
            inner.append(self.either())
        if name in ("position", "last") and not inner:
            return lambda page, node, place, size: float(place if name == "position" else size)
        least, most, work = _FUNCTIONS.get(name, (1, 0, None))
        if not least <= len(inner) <= most:
            raise ValueError(self.source)
        return lambda *at: work(at[0], at[1], *(part(*at) for part in inner))


def selector(kind: str, text: str) -> Selector | None:
    """The paths of a selector; None if it is not supported."""
    try:
        return _Reader(css_path(text) if kind == "css" else text).selector()
    except (ValueError, RecursionError):
        return None


#: Selectors of which ``find_all`` keeps the paths between pages.
KEPT = 20_000


def find_all(html: str | None, asked: Iterable[tuple[str, str]],
             known: dict[tuple[str, str], Selector | None] | None = None) -> list[tuple[bool | None, str | None]]:
    """Per selector (kind, text) whether the page has such an element (None: not supported), and its text.

    ``known`` keeps the paths of selectors from page to page.
    """
    page, found, known = Page(html or ""), [], {} if known is None else known
    for kind, text in asked:
        if (kind, text) not in known:
            if len(known) >= KEPT:
                known.clear()
            known[kind, text] = selector(kind, text)
        paths = known[kind, text]
        try:
            element = None if paths is None else page.first(paths)
        except (TypeError, AttributeError):  # a function of a set got something else
            paths, element = None, None
        found.append((None if paths is None else element is not None, page.text(element) if element else None))
    return found
