"""The main text of a web page, by a minimum cut between content and boilerplate.

A page is read into blocks of text. A classifier gives each block a cost for either label: the capacity
of its edge to the source (content) or the sink (boilerplate). Blocks that follow each other, and blocks
that share a parent, are tied by edges that cost more the closer the blocks are in the page's tree. The
cut of least cost labels all blocks of a page at once.

What stands around a block is known when the page is read: a form, or an element whose class or id has a
word of boilerplate ("has-sidebar"), says nothing when it is a wrapper, that is when it holds the page's
root. Elsewhere such words weigh little enough for the ties of a block to outweigh them.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.shared import map_pieces

# Element names of the HTML standard, by what they mean for a page's text.
UNSEEN = frozenset("script style noscript template head title textarea svg math iframe object select option "
                   "button canvas audio video datalist".split())
RAW = frozenset("script style title textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
                   "p pre search section summary table tbody td tfoot th thead tr ul".split())
ENDS_P = BREAKS - frozenset("caption td th tr tbody thead tfoot body html".split())
#: What the name of an element around a block says for content (+) or boilerplate (-), in log odds.
ELEMENT_ODDS = {"article": 4.0, "main": 3.0, "nav": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "menu": -9.0,
                "dialog": -9.0, "fieldset": -6.0, "search": -9.0}
#: Of these, the ones that may stand around a whole page.
FORMS = frozenset(("form", "fieldset"))
#: Words of classes, ids and roles that name boilerplate: wherever they stand, or less surely, since inside an
#: article such a part can hold some of its text.
BAD_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navigation "
                      "navbar menu sidebar masthead topbar comment comments reply replies disqus respond cookie cookies "
                      "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
                      "subscription signup login breadcrumb breadcrumbs pagination pager toolbar toc skip complementary "
                      "contentinfo".split())
LESS_BAD_WORDS = frozenset("banner footer foot header share sharing social related recommended widget widgets tags "
                           "copyright legal disclaimer".split())
#: Words that leave the meaning of the others in a name as it is: "related-posts", but not "related-art".
NEUTRAL_WORDS = frozenset("a all area article articles aside bar block body bottom box btn button buttons center col column "
                          "container content desktop div entry fixed global group holder icon icons id inner item items left "
                          "link links list main mobile module outer page pages panel post posts primary reader reading region "
                          "right role row secondary section site sticky story text title top ul user wrap wrapper".split())
GOOD_WORDS = frozenset("article content main post entry story body text".split())
#: What they say: a bad one no more than the length of a block and its ties can outweigh.
BAD_ODDS, LESS_BAD_ODDS, GOOD_ODDS = -3.5, -1.0, 2.0
#: Elements that the end tag of an inline element outside of them does not close.
BARRIERS = frozenset("td th article body".split())
#: Weight of the ties between blocks.
TIE_NEXT, TIE_PARENT = 1.2, 0.8

# As the standard reads them: a quote opens a value behind "=" only, any other value ends at white space or ">";
# "<!-->" is a whole comment, and "--!>" ends one too.
_VALUE = r"""(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)"""
_MARKUP = re.compile(
    rf"""<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?:[!?]|/(?=[^a-zA-Z]))[^>]*>?
    |<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+{_VALUE}?+)?+|=)*+)(?:>|\Z)""", re.S | re.X)
_ATTRIBUTE = re.compile(rf"(=?[^\s/>=]++)(?:\s*+=\s*+({_VALUE}?+))?+")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


@dataclass
class Block:
    text: str
    parent: int
    odds: float
    links: float
    tag: str


@dataclass
class Element:
    name: str
    parent: int
    depth: int
    hidden: bool
    words: frozenset[str] = frozenset()  # of class and id
    role: frozenset[str] = frozenset()
    bad: frozenset[str] = frozenset()  # the bad words of all three
    odds: float = 0.0
    size: int = 0  # characters of its own text


def attributes_of(source: str) -> dict[str, str]:
    """The attributes of a tag by name, the first of a name; without a value they are empty."""
    made: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(source):
        if value[:1] in ("'", '"'):
            value = value[1:].removesuffix(value[0])
        made.setdefault(name.lower(), entities.unescape(value) if "&" in value else value)
    return made


def _bad_words(names: str) -> frozenset[str]:
    """The bad words among class names: those that are a name, or the whole meaning of one."""
    found = set()
    for name in names.split():
        parts = {p.lower() for p in _PART.findall(name)}
        bad = parts & (BAD_WORDS | LESS_BAD_WORDS)
        if bad and parts <= bad | NEUTRAL_WORDS:
            found |= bad
    return frozenset(found)


def _element(name: str, source: str, parent: int, elements: list[Element]) -> Element:
    above = elements[parent]
    made = Element(name, parent, above.depth + 1, above.hidden or name in UNSEEN)
    if source and not source.isspace():
        given = attributes_of(source)
        names = f"{given.get('class', '')} {given.get('id', '')}"
        made.words = frozenset(p.lower() for p in _PART.findall(names))
        made.role = frozenset(p.lower() for p in _PART.findall(given.get("role", "")))
        made.bad = _bad_words(f"{names} {given.get('role', '')}")
        made.hidden |= ("hidden" in given or given.get("aria-hidden", "").strip().lower() == "true"
                        or bool(_NO_DISPLAY.search(given.get("style", ""))))
    return made


def _bad(element: Element) -> bool:
    return element.name not in ("body", "html", "article", "main") and bool(element.bad)


def _wrappers(elements: list[Element]) -> set[int]:
    """Forms, and elements with bad words, that hold the page's root and so say nothing about it.

    Roots are the <main> and the outermost <article> with most text; without these, the element with most
    text of those named by a good word. Without any, and for forms always, an element is a wrapper that
    holds more than half of the text. Text in elements of boilerplate does not count. What has the name and
    the words of a wrapper, such as the next post of a list, is one too.
    """
    soft = [k for k, e in enumerate(elements) if e.name in FORMS or _bad(e)]
    if not soft:
        return set()
    aside, inner, size = [False], [False], [e.size for e in elements]
    for e in elements[1:]:
        aside.append(aside[e.parent] or e.name not in FORMS and ELEMENT_ODDS.get(e.name, 0.0) < 0)
        inner.append(inner[e.parent] or elements[e.parent].name == "article")
    for k in range(len(elements) - 1, 0, -1):
        if aside[k] and not aside[elements[k].parent]:
            size[k] = 0
        size[elements[k].parent] += size[k]
    roots: dict[str, int] = {}
    for k, e in enumerate(elements):
        if aside[k] or e.hidden or not size[k]:
            continue
        if e.name == "main" or "main" in e.role:
            kind = "main"
        elif e.name == "article":
            kind = "article" if not inner[k] and not e.bad else ""
        else:
            kind = "word" if e.name in BREAKS and not _bad(e) and not GOOD_WORDS.isdisjoint(e.words) else ""
        if kind and size[k] > size[roots.get(kind, 0)] * (kind in roots):
            roots[kind] = k
    if len(roots) > 1:
        roots.pop("word", None)
    made, held = set(), set()
    for k in roots.values():
        while k > 0:
            held.add(k)
            k = elements[k].parent
    for k in soft:
        if k in held or (not roots or elements[k].name in FORMS) and not aside[k] and 2 * size[k] > size[0]:
            made.add(k)
    alike = {(elements[k].name, elements[k].words) for k in made if elements[k].words}
    return made | {k for k in soft if (elements[k].name, elements[k].words) in alike}


def weigh(elements: list[Element]) -> None:
    """The odds of every element: the nearest one around it that says anything counts, but nothing inside
    boilerplate becomes content again."""
    wrappers = _wrappers(elements)
    for k, e in enumerate(elements[1:], 1):
        above = elements[e.parent]
        odds, inside = ELEMENT_ODDS.get(e.name, 0.0), above.odds > 0
        if e.name == "header":
            odds = 0.0 if inside else -9.0  # the header of an article holds its title
        if k in wrappers:
            odds = max(odds, 0.0) if e.name in FORMS else odds
        elif _bad(e) and not (inside and (e.words | e.role) & {"header", "body"}):
            odds = min(odds, LESS_BAD_ODDS if inside and BAD_WORDS.isdisjoint(e.bad) else BAD_ODDS)
        if e.name not in ("body", "html", "article", "main") and odds == 0.0 and (
                not GOOD_WORDS.isdisjoint(e.words) and (k in wrappers or not _bad(e)) or "main" in e.role):
            odds = GOOD_ODDS
        e.odds = above.odds if above.odds < -1 or odds == 0.0 else odds


def blocks(page: str) -> tuple[list[Block], list[Element]]:
    """The text blocks of a page in order, and its elements. Never recursive; one pass.

    Elements may be nested as deep as they like: where the open ones of a name, the open blocks and the
    open barriers stand on the stack is kept, so that no tag searches it.
    """
    elements = [Element("", -1, 0, False)]
    made: list[Block] = []
    around: list[int] = []  # the element that each block stands in
    stack, parts = [0], []  # parts: (text, is a link)
    named: dict[str, list[int]] = {}
    open_blocks, open_barriers = [], []
    links, breaks, pos = 0, 0, 0

    def close_block():
        nonlocal parts, breaks
        breaks = 0
        if not parts:
            return
        text = " ".join("".join(p for p, _ in parts).split())
        if text:
            linked = sum(len(p.strip()) for p, a in parts if a)
            holder = stack[open_blocks[-1]] if open_blocks else 0
            made.append(Block(text, holder, 0.0, linked / max(1, len(text)), elements[holder].name))
            around.append(stack[-1])
            elements[stack[-1]].size += len(text)
        parts = []

    def say(text: str):
        nonlocal breaks
        if not elements[stack[-1]].hidden and text:
            if "&" in text:
                text = entities.unescape(text)
            if not text.isspace():
                breaks = 0
            parts.append((text, links > 0))

    def leave(until: int):
        nonlocal links
        while len(stack) > until:
            name = elements[stack.pop()].name
            named[name].pop()
            if name in BREAKS:
                open_blocks.pop()
            if name in BARRIERS:
                open_barriers.pop()
            links -= name == "a"

    while pos < len(page):
        match = _MARKUP.search(page, pos)
        if not match:
            say(page[pos:])
            break
        if match.start() > pos:
            say(page[pos:match.start()])
        pos = match.end()
        name = (match[2] or "").lower()
        if not name:
            if match[0].startswith("<![CDATA["):
                say(match[0][9:].removesuffix("]]>"))
            continue
        if match[1]:
            at = named[name][-1] if named.get(name) else 0
            if at and not (name not in BREAKS and open_barriers and open_barriers[-1] > at):
                if open_blocks and open_blocks[-1] >= at:
                    close_block()
                leave(at)
            continue
        if name == "br":
            breaks += 1
            if breaks > 1:
                close_block()
            else:
                say(" ")
                breaks = 1
            continue
        if name in VOID:
            if name == "hr":
                close_block()
            continue
        if name in BREAKS:
            close_block()
            if name in ENDS_P:  # an open paragraph ends here, with the inline elements in it
                at = open_blocks[-1] if open_blocks else 0
                if at and elements[stack[at]].name == "p":
                    leave(at)
            if name in ("li", "dd", "dt", "tr", "td", "th", "option"):
                at = open_blocks[-1] if open_blocks else 0
                if at and elements[stack[at]].name == name:
                    leave(at)
        elements.append(_element(name, match[3], stack[-1], elements))
        if match[3].endswith("/") and name in ("svg", "math", "path"):
            continue
        named.setdefault(name, []).append(len(stack))
        if name in BREAKS:
            open_blocks.append(len(stack))
        if name in BARRIERS:
            open_barriers.append(len(stack))
        stack.append(len(elements) - 1)
        links += name == "a"
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, pos)
            leave(len(stack) - 1)
            pos = end.end() if end else len(page)
    close_block()
    weigh(elements)
    _share_links(made, elements)
    for block, k in zip(made, around):
        block.odds = elements[k].odds
    return made, elements


def cost(block: Block) -> float:
    """Log odds that the block is content: what stands around it, its length, its links, its sentences."""
    n = len(block.text)
    odds = block.odds - 0.6
    odds += min(n, 200) / 100 - 2.5 * (block.links > 0.5) - 1.0 * (block.links > 0.2)
    odds += 0.5 * (block.text[-1] in ".!?…”\"" and n > 20) + 0.8 * (block.tag in ("h1", "p"))
    odds += 0.3 * (block.tag in ("h2", "h3", "blockquote", "pre"))
    if re.match(r"(?:©|\(c\)|copyright\b|all rights reserved)", block.text, re.I) and n < 200:
        odds -= 3.0
    return odds


def _distance(a: int, b: int, elements: list[Element]) -> int:
    """Steps between two elements in the tree; from 60 on, where a tie is next to nothing, 60."""
    steps = 0
    while a != b and steps < 60:
        if elements[a].depth >= elements[b].depth:
            a = elements[a].parent
        else:
            b = elements[b].parent
        steps += 1
    return steps


def _share_links(found: list[Block], elements: list[Element]) -> None:
    """The items of a list have the links of the list: one linked item among plain ones is none of a menu."""
    lists: dict[int, list[Block]] = {}
    for block in found:
        if block.tag in ("li", "dd", "dt"):
            lists.setdefault(elements[block.parent].parent, []).append(block)
    for items in lists.values():
        share = sum(b.links * len(b.text) for b in items) / sum(len(b.text) for b in items)
        for block in items:
            block.links = min(block.links, share)


def ties(found: list[Block], elements: list[Element]) -> list[tuple[int, int, float]]:
    """Edges between blocks that follow each other, and between neighbours below one parent."""
    made, last = [], {}
    for k, block in enumerate(found):
        if k:
            made.append((k - 1, k, TIE_NEXT / (1 + _distance(found[k - 1].parent, block.parent, elements))))
        above = elements[block.parent].parent
        if above in last and last[above] != k - 1:
            made.append((last[above], k, TIE_PARENT))
        last[above] = k
    return made


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the source's side of a cut of least cost.

    ``odds`` are capacities to the source (above 0) or the sink (below), ``edges`` capacities both ways.
    Nodes whose own capacity is more than all their edges keep their label in every least cut; they are
    settled first, and the flow runs over what is left. A node no flow decides goes to the sink.
    """
    n = len(odds)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, w in edges:
        near[a].append((b, w))
        near[b].append((a, w))
    left, pull, label = [sum(w for _, w in x) for x in near], list(odds), [None] * n
    waiting = deque(range(n))
    while waiting:
        k = waiting.popleft()
        if label[k] is None and abs(pull[k]) > left[k]:
            label[k] = pull[k] > 0
            for b, w in near[k]:
                if label[b] is None:
                    pull[b] += w if label[k] else -w
                    left[b] -= w
                    waiting.append(b)
    core = [k for k in range(n) if label[k] is None]
    if core:
        side = _max_flow({k: pull[k] for k in core}, [(a, b, w) for a, b, w in edges if label[a] is None and label[b] is None])
        for k in core:
            label[k] = k in side
    return label


def _max_flow(pull: dict[int, float], edges: list[tuple[int, int, float]]) -> set[int]:
    """Nodes the source still reaches under a largest flow, by blocking flows along shortest paths."""
    place = {k: i for i, k in enumerate(pull)}
    source, sink = len(place), len(place) + 1
    out: list[list[int]] = [[] for _ in range(len(place) + 2)]  # numbers of arcs; arc ^ 1 goes back
    head: list[int] = []
    room: list[float] = []

    def arc(a: int, b: int, there: float, back: float):
        out[a].append(len(head))
        out[b].append(len(head) + 1)
        head.extend((b, a))
        room.extend((there, back))

    for k, p in pull.items():
        if p > 0:
            arc(source, place[k], p, 0.0)
        elif p < 0:
            arc(place[k], sink, -p, 0.0)
    for a, b, w in edges:
        arc(place[a], place[b], w, w)
    while True:
        level = [-1] * len(out)
        level[source], queue = 0, deque([source])
        while queue:
            at = queue.popleft()
            for e in out[at]:
                if room[e] > 1e-9 and level[head[e]] < 0:
                    level[head[e]] = level[at] + 1
                    queue.append(head[e])
        if level[sink] < 0:
            return {k for k, i in place.items() if level[i] >= 0}
        following, path, at = [0] * len(out), [], source
        while True:  # every arc is given up at most once
            if at == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                first = next(k for k, e in enumerate(path) if room[e] <= 1e-9)
                at = head[path[first] ^ 1]
                del path[first:]
                continue
            while following[at] < len(out[at]):
                e = out[at][following[at]]
                if room[e] > 1e-9 and level[head[e]] == level[at] + 1:
                    break
                following[at] += 1
            if following[at] < len(out[at]):
                path.append(e)
                at = head[e]
            elif path:
                level[at] = -1
                at = head[path.pop() ^ 1]
            else:
                break


def main_text(page: str | None) -> str:
    found, elements = blocks(page or "")
    labels = minimum_cut([cost(b) for b in found], ties(found, elements))
    return "\n".join(b.text for b, content in zip(found, labels) if content)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(``id_col``, ``url_col``, text) per row. Null and empty pages have an empty text, as have pages of
    boilerplate alone. Pages are read whole, in one task; repeated rows are read each; where cuts cost the
    same, the one with least content is taken; other columns are left out.
    """
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def work(columns: dict[str, list]) -> dict:
        return {"id": columns["id"], "url": columns["url"], "text": [main_text(p) for p in columns["html"]]}

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    made = map_pieces(rows, f"id {kinds[0]}, url {kinds[1]}, text string", work)
    return made.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")
