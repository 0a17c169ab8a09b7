"""Personal data: fixed patterns, and spans that boosted trees add.

Generators propose every span that might be an address or a number, overlapping ones too. Boosted trees,
one forest per kind, judge each by its format and by the characters and words around it. They learn from a
bounded sample of candidates. Spans of the fixed patterns are positives; each is also rewritten into forms
that the patterns miss and the generators propose (spelled or spaced addresses, letters beyond ASCII, other
separators, national numbers), and into near misses, which are negatives. A candidate that the patterns do
not match is a negative only if it has none of those forms: else nothing is known about it and it is left
out. The threshold of a kind is the lowest that keeps the wanted precision on examples held out of training.
"""

from __future__ import annotations

import bisect
import random
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.shared import map_pieces, pieces, sample_of, written

KINDS = ("email", "ip", "card", "phone")
#: Documents whose candidates the trees learn from, and the precision their threshold keeps.
SAMPLE_ROWS, PRECISION = 20_000, 0.995
ROUNDS, DEPTH, RATE = 30, 3, 0.3

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number starts where a run of digits starts: a later start in the run cannot match if that one doesn't.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_ANY_MAIL = re.compile(r"[\w.%+-]{1,64}\s?(?:@|\(at\)|\[at\])\s?[\w-]{1,64}(?:\s?(?:\.|\(dot\)|\[dot\])\s?[\w-]{1,32}){1,4}")
# The same without white space at a plain dot: where a sentence ends after the address.
_TIGHT_MAIL = re.compile(r"[\w.%+-]{1,64}\s?(?:@|\(at\)|\[at\])\s?[\w-]{1,64}(?:(?:\.|\s?\(dot\)\s?|\s?\[dot\]\s?)[\w-]{1,32}){1,4}")
_ANY_NUMBER = re.compile(r"(?<![0-9])[+(]?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,20}(?![0-9])")
CUES = {
    "email": ("mail", "email", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "fax", "cell", "telefon", "teléfono", "téléphone"),
}
_SENTENCE = re.compile(r"\.\s")
_LAST_LABEL = re.compile(r"(?<![\w])[^\W\d_]{2,}$")
_DATE = re.compile(r"(?<![0-9])(?:(?:1[89]|2[01])[0-9]{2}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:1[89]|2[01])[0-9]{2})(?![0-9])"
                   r"|^(?:1[89]|2[01])[0-9]{2}\s?[-/]\s?(?:1[89]|2[01])[0-9]{2}$")
_CUE_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses: from each @ back over the local part, and on over the domain."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        match = _DOMAIN.match(text, at) if at >= end else None
        if match:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                end = match.end()
                found.append((start, end))
        at = text.find("@", at + 1)
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the fixed patterns, by kind and start."""
    spans = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        spans += [("ip", *m.span()) for m in _IP.finditer(text)
                  if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
        if "+" in text:
            spans += [("phone", *m.span()) for m in _PHONE.finditer(text)
                      if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return spans


def candidates(text: str) -> list[tuple[str, int, int]]:
    """High-recall proposals; a number is proposed for every kind it might be, so spans overlap."""
    made = []
    if "@" in text or "(at)" in text or "[at]" in text:
        # Only around the sign, so that long runs of letters cost nothing.
        for sign in re.finditer(r"@|\(at\)|\[at\]", text):
            low = max(0, sign.start() - 66)
            made += [("email", low + m.start(), low + m.end())
                     for form in (_TIGHT_MAIL, _ANY_MAIL) for m in form.finditer(text[low:sign.end() + 260])
                     if low + m.start() <= sign.start() < low + m.end()]
    if _DIGIT.search(text):
        for m in _ANY_NUMBER.finditer(text):
            digits = sum("0" <= c <= "9" for c in m[0])
            if m[0].count(".") == 3:
                made.append(("ip", *m.span()))
            if 12 <= digits:
                made.append(("card", *m.span()))
            if 7 <= digits <= 15:
                made.append(("phone", *m.span()))
    return list(dict.fromkeys(made))


#: Names of the features, in order.
_FEATURES = ("kind", "length", "digits", "groups", "longest group", "last group", "marks", "dots", "hyphens", "parentheses", "spaces",
             "sign", "luhn", "octets", "joined before", "joined after", "cue", "digits around", "first group", "+first", "(first",
             "0first", "slashes", "sentences", "label", "letters", "spelled", "date")
_OF_MAIL = frozenset(("spaces", "sign", "joined before", "joined after", "cue", "sentences", "label", "letters", "spelled"))


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the span, and what stands around it."""
    span = text[start:end]
    digits = re.sub("[^0-9]", "", span)
    groups = re.findall("[0-9]+", span)
    before, after = text[max(0, start - 40):start], text[end:end + 20]
    cues = set(w.lower() for w in _CUE_WORD.findall(before)[-4:])
    inside = lambda c: float(c.isalnum() or c in "_=/#")
    made = [
        float(KINDS.index(kind)), float(end - start), float(len(digits)), float(len(groups)),
        float(max(map(len, groups), default=0)), float(len(groups[-1]) if groups else 0),
        float(sum(not c.isalnum() for c in span)), float(span.count(".")), float(span.count("-")),
        float("(" in span and ")" in span), float(span.count(" ")), float("@" in span),
        float(bool(13 <= len(digits) <= 19 and luhn(digits))),
        float(len(groups) == 4 and all(int(g[-4:]) <= 255 and len(g) <= 3 for g in groups)),
        inside(before[-1]) if before else 0.0, inside(after[0]) if after else 0.0,
        float(any(c in cues for c in CUES[kind])), float(len(_DIGIT.findall(before + after))),
        float(len(groups[0]) if groups else 0), float(span[0] == "+"), float(span[0] == "("), float(span[0] == "0"),
        float(span.count("/")), float(len(_SENTENCE.findall(span))), float(bool(_LAST_LABEL.search(span))),
        float(not span.isascii()), float("at)" in span or "at]" in span), float(bool(_DATE.search(span))),
    ]
    # How long an address is and which numbers stand in it says nothing.
    return [v if n in _OF_MAIL else 0.0 for n, v in zip(_FEATURES, made)] if kind == "email" else made


class Trees:
    """Boosted trees of logistic loss; each is arrays of feature, bound, left, right and value."""

    def __init__(self):
        self.trees: list[list[tuple]] = []
        self.bias = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.bias = float(np.log(rate / (1 - rate)))
        score = np.full(len(y), self.bias)
        bounds = [np.unique(np.quantile(x[:, k], np.linspace(0.02, 0.98, 25))) for k in range(x.shape[1])]
        for _ in range(ROUNDS):
            chance = 1 / (1 + np.exp(-score))
            slope, curve = y - chance, chance * (1 - chance)
            tree: list[tuple] = []
            self._grow(tree, x, slope, curve, np.arange(len(y)), bounds, DEPTH)
            self.trees.append(tree)
            score += self._one(tree, x)
        return self

    def _grow(self, tree, x, slope, curve, rows, bounds, depth) -> int:
        at = len(tree)
        g, h = slope[rows].sum(), curve[rows].sum()
        tree.append((-1, 0.0, 0, 0, RATE * g / (h + 1.0)))
        best = (1e-6, -1, 0.0)
        for k in range(x.shape[1] if depth else 0):
            column = x[rows, k]
            for bound in bounds[k]:
                low = column <= bound
                gl, hl = slope[rows][low].sum(), curve[rows][low].sum()
                gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                if low.any() and not low.all() and gain > best[0]:
                    best = (gain, k, bound)
        if best[1] >= 0:
            low = x[rows, best[1]] <= best[2]
            left = self._grow(tree, x, slope, curve, rows[low], bounds, depth - 1)
            right = self._grow(tree, x, slope, curve, rows[~low], bounds, depth - 1)
            tree[at] = (best[1], best[2], left, right, 0.0)
        return at

    @staticmethod
    def _one(tree, x) -> np.ndarray:
        feature, bound, left, right, value = (np.array(c) for c in zip(*tree))
        node = np.zeros(len(x), int)
        for _ in range(DEPTH):
            k = feature[node]
            low = x[np.arange(len(x)), np.maximum(k, 0)] <= bound[node]
            node = np.where(k < 0, node, np.where(low, left[node], right[node]))
        return value[node]

    def chance(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.bias)
        for tree in self.trees:
            score += self._one(tree, x)
        return 1 / (1 + np.exp(-score))


def _grouped(digits: str, mark: str) -> str:
    return mark.join(digits[k:k + 4] for k in range(0, len(digits), 4))


def variants(kind: str, span: str) -> list[tuple[str, bool]]:
    """A span of the patterns in forms they miss; the second item: whether only a word before it tells."""
    if kind == "email":
        local, domain = span.split("@")
        made = [f"{local} @ {domain}", f"{local}@ {domain}"]
        for at, dot in (("(at)", "(dot)"), ("[at]", "[dot]")):
            made += [f"{local} {at} {domain}", f"{local}{at}{domain}", f"{local} {at} {domain.replace('.', f' {dot} ')}",
                     f"{local}{at}{domain.replace('.', dot)}"]
        made += [f"{local}\u00e9@{domain}", f"{local[:1]}\u00fc{local[1:]}@{domain}", f"{local}@{domain[:1]}\u00f6{domain[1:]}"]
        return [(m, False) for m in made]
    if kind == "ip":
        return [(span.replace(".", mark), False) for mark in (". ", " .")]
    digits = re.sub("[^0-9]", "", span)
    if kind == "card":
        return [(_grouped(digits, mark), False) for mark in ("/", ".", "  ", "--", ". ", "/ ")]
    made = [("00" + span[1:], False)]
    short = re.match(r"\+[0-9]{1,3}[\x20.-]", span)
    rest = span[short.end():] if short else ""
    groups = re.findall("[0-9]+", rest)
    if sum(map(len, groups)) >= 7:
        if "(" in rest:
            made.append((rest[rest.index("("):], False))
        made += [("0" + mark.join(groups), False) for mark in "/-"] if len(groups) > 1 else []
        made += [(mark.join(groups), False) for mark in "-./"] if len(groups) > 2 else []
        made += [(" ".join(groups), True), ("".join(groups), True)]
    return made


def misses(kind: str, span: str, chosen: random.Random) -> list[str]:
    """What looks like a span of the kind and is none."""
    digits = re.sub("[^0-9]", "", span)
    year, month, day, n = chosen.randint(1900, 2099), chosen.randint(1, 12), chosen.randint(1, 28), chosen.randint
    if kind == "email":
        local = span.split("@")[0]
        return [f"{local} @ {n(1, 99)}.{n(10, 99)}", f"{local} @ {n(1, 12)}.{n(10, 59)}pm", f"{span}. {local}", f"{local} @ {local}. {local}"]
    if kind == "ip":
        wrong = span.split(".")
        wrong[n(0, 3)] = str(n(256, 999))
        return [mark.join(wrong) for mark in (".", ". ", " .")]
    if kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + n(1, 9)) % 10)
        return [_grouped(wrong, mark) for mark in ("", "/", ".", "  ", "--", " ", "-")]
    return [f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{day:02}/{month:02}/{year}", f"{year}-{year + n(1, 9)}",
            f"{year}/{year + n(1, 9)}", f"{year}-{month:02}-{day:02} {n(10, 23)}", f"978-{n(0, 9)}-{n(10, 99)}-{n(100000, 999999)}-{n(0, 9)}",
            f"{n(1, 9)}.{n(10**7, 10**9)}", f"10.{n(1000, 9999)}/{n(1000, 9999999)}", f"{n(1, 99)}.{n(100, 999)}.{n(100, 999)}", f"{n(1, 99)} {n(100, 999)} {n(100, 999)}", f"{n(100, 999)} {n(100, 999)} {n(1000, 9999)}",
            f"{n(10, 99)}-{n(10, 99)} {n(1000, 9999)}", str(n(10**7, 10**11)), f"{n(1, 9)}.{n(1, 99)}.{n(1000, 99999)}.{n(0, 999)}"]


def open_form(text: str, kind: str, start: int, end: int) -> bool:
    """Whether a candidate that the patterns do not match has a form that one of the kind may have."""
    x = dict(zip(_FEATURES, features(text, kind, start, end)))
    if kind == "email":
        return bool(x["label"] and not x["sentences"])
    if kind == "card":
        return bool(x["luhn"])
    if kind == "ip":
        return bool(x["octets"])
    if x["joined before"] or x["joined after"] or x["date"]:
        return False
    return bool(x["cue"] or x["(first"] or x["+first"] or x["0first"] and x["groups"] > 1
                or x["groups"] > 2 and x["last group"] > 2 and x["digits"] >= 9)


#: Rewritten forms and near misses of a span that the trees see.
FORMS = 3


def _labelled(text: str) -> list[tuple[str, list[float], float, int]]:
    """Kind, features, label and a hash of a text's candidates, and of its spans rewritten."""
    spans = base_spans(text)
    base, made = set(spans), []

    def add(near: str, one: tuple[str, int, int], label: float):
        made.append((one[0], features(near, *one), label, zlib.crc32(near[one[1]:one[2]].encode())))

    for one in candidates(text):
        if one in base:
            add(text, one, 1.0)
        elif any(k != one[0] and a < one[2] and one[1] < b for k, a, b in spans) or not open_form(text, *one):
            add(text, one, 0.0)
    for kind, start, end in spans:
        span = text[start:end]
        chosen = random.Random(zlib.crc32(span.encode()))
        forms, wrong = variants(kind, span), misses(kind, span, chosen)
        planted = [(*f, True) for f in chosen.sample(forms, min(FORMS, len(forms)))]
        planted += [(m, False, False) for m in chosen.sample(wrong, min(FORMS, len(wrong)))]
        for form, cued, good in planted:
            before = text[max(0, start - 60):start]
            if cued or chosen.random() < 0.3:
                before += chosen.choice(CUES[kind]) + " " if good else ""
            after = text[end:end + 40]
            if after[:1].isspace() and chosen.random() < 0.5:
                after = "." + after  # the sentence ends here
            near, low, high = before + form + after, len(before), len(before) + len(form)
            matched = set(base_spans(near))
            for one in candidates(near):
                if one[1] < high and low < one[2]:
                    label = one in matched or good and one == (kind, low, high)
                    if label or one[0] != "card" or not luhn(re.sub("[^0-9]", "", near[one[1]:one[2]])):
                        add(near, one, float(label))
    return made


class Judges:
    """The trees of each kind, and the least chance at which they add a span of it."""

    def __init__(self):
        self.by_kind: dict[str, tuple[Trees, float]] = {}

    @property
    def trees(self) -> list:
        return [tree for trees, _ in self.by_kind.values() for tree in trees.trees]


def _judge(x: np.ndarray, y: np.ndarray) -> tuple[Trees, float] | None:
    """Trees from three quarters of the examples, and the threshold that the others set."""
    held = np.arange(len(y)) % 4 == 3
    if not held.any() or y[~held].min() == y[~held].max():
        return None
    trees = Trees().fit(x[~held], y[~held])
    chance = trees.chance(x[held])
    order = np.argsort(-chance, kind="stable")
    good = np.cumsum(y[held][order]) / np.arange(1, held.sum() + 1)
    # Only where the next chance is lower: examples of one chance are taken or left together.
    fine = np.flatnonzero((good >= PRECISION) & np.append(np.diff(chance[order]) < 0, True))
    if not len(fine):
        return None
    # Halfway to the next chance below, so that kinds the examples part well have room on both sides.
    least, below = chance[order][fine[-1]], np.append(chance[order], 0.0)[fine[-1] + 1]
    return trees, max(0.5, float(least + below) / 2)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Judges:
    """Trees from the candidates of a bounded sample; three quarters train, the rest sets the thresholds.

    Each kind has an equal part of the sample of candidates. Nothing is added of a kind without examples of
    both labels, or for which no threshold keeps the precision.
    """
    seen = docs.where(F.col(text_col).rlike("[0-9@]"))
    some = sample_of(seen, F.struct(id_col, text_col), sample_rows).select(F.col(text_col).alias("text"))

    def work(columns: dict[str, list]) -> dict:
        # At most 20 examples of a document and kind, spread over it: a list of numbers must not rule the sample.
        rows = []
        for text in columns["text"]:
            made = _labelled(text)
            for kind in KINDS:
                own = [r for r in made if r[0] == kind]
                rows += own[:: -(-len(own) // 20) or 1]
        return dict(zip(("kind", "x", "y", "of"), map(list, zip(*rows)))) if rows else {"kind": [], "x": [], "y": [], "of": []}

    made = map_pieces(some, "kind string, x array<double>, y double, of long", work)
    # Equal examples count once, so that one number in many copies does not rule the sample either.
    examples = written(made.distinct(), "candidates")
    counts = {r["kind"]: r["count"] for r in examples.groupBy("kind").count().collect()}
    judges = Judges()
    for kind in KINDS:
        if not counts.get(kind):
            continue
        own = sample_of(examples.where(F.col("kind") == kind), F.struct("x", "of"), sample_rows // len(KINDS), counts[kind])
        rows = sorted((zlib.crc32(repr((r["x"], r["of"])).encode()), r["x"], r["y"]) for r in own.collect())
        judge = _judge(np.array([r[1] for r in rows]), np.array([r[2] for r in rows])) if rows else None
        if judge:
            judges.by_kind[kind] = judge
    return judges


def find(text: str, judges: Judges) -> list[tuple[str, int, int, bool]]:
    """All spans: those of the patterns, and those the trees add beside them. The last item: of the patterns.

    An added address may enclose one of the patterns, which end at a letter beyond ASCII.
    """
    base = base_spans(text)
    spans, known = [(*s, True) for s in base], set(base)
    more: dict[str, list] = {}
    for c in candidates(text) if judges.by_kind else []:
        if c not in known and c[0] in judges.by_kind:
            more.setdefault(c[0], []).append(c)
    judged = []
    for kind, some in more.items():
        trees, least = judges.by_kind[kind]
        chance = trees.chance(np.array([features(text, *c) for c in some]))
        judged += [(p, c) for p, c in zip(chance, some) if p >= least]
    # Places that are taken, and the addresses of the patterns, in order and apart from each other.
    mails = sorted((a, b) for kind, a, b in base if kind == "email")
    ends, taken = [b for _, b in mails], bytearray(len(text)) if judged else b""
    for kind, a, b in base:
        if kind != "email" and judged:
            taken[a:b] = b"\x01" * (b - a)
    for _, (kind, start, end) in sorted(judged, key=lambda r: (-r[0], r[1][1], -r[1][2], r[1][0])):
        at, free = bisect.bisect_right(ends, start), 1 not in taken[start:end]
        while free and at < len(mails) and mails[at][0] < end:
            free = kind == "email" and start <= mails[at][0] and mails[at][1] <= end
            at += 1
        if free:
            taken[start:end] = b"\x01" * (end - start)
            spans.append((kind, start, end, False))
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def scan(docs: DataFrame, trees: Judges, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, spans) per row; spans hold kind, start, end (code points, end exclusive), base.

    Null and empty texts have no spans. Overlapping spans of different kinds are all listed when they
    come from the patterns; added ones overlap none, but for an address that goes on beyond the pattern's. Long
    texts are read whole; the work grows with the text and its candidates;
    repeated rows are read each; other columns are left out.
    """
    held = docs.sparkSession.sparkContext.broadcast(trees)
    kind = docs.schema[id_col].dataType.simpleString()

    def work(columns: dict[str, list]) -> dict:
        names = ("kind", "start", "end", "base")
        return {"id": columns["id"],
                "spans": [[dict(zip(names, s)) for s in find(t or "", held.value)] for t in columns["text"]]}

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind}, spans array<struct<kind:string,start:long,end:long,base:boolean>>"
    return map_pieces(rows, schema, work).withColumnRenamed("id", id_col)


def redacted(text: str, spans: list[tuple]) -> str:
    """The text with each span as ``[KIND]``; spans that overlap go together under the first one's kind."""
    made, end = [], 0
    for kind, a, b, *_ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            made += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join(made) + text[end:]


def redact(docs: DataFrame, trees: Judges, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """The rows, with all their columns, with spans replaced; ``size_col``, if it is there and holds whole
    numbers, then tells the new length.

    Null and empty texts stay as they are, as do texts without spans. Texts of any length are read whole; repeated
    rows are treated alike; spans that overlap go together. Other columns may have any names and kinds. An empty
    table stays one.
    """
    held = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        import pyarrow as pa

        for piece in (p for batch in batches for p in pieces(batch)):
            at = piece.schema.get_field_index(text_col)
            texts = piece.column(at).to_pylist()
            made = [t if t is None or not (s := find(t, held.value)) else redacted(t, s) for t in texts]
            columns = list(piece.columns)
            columns[at] = pa.array(made, piece.schema.field(at).type)
            size = piece.schema.get_field_index(size_col) if size_col else -1
            if size >= 0 and pa.types.is_integer(piece.schema.field(size).type):
                sizes = [n if t is m else len(m) for n, t, m in zip(columns[size].to_pylist(), texts, made)]
                columns[size] = pa.array(sizes, piece.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(columns, schema=piece.schema)

    return docs.mapInArrow(run, docs.schema)
