"""Plain versions of what the operators compute, for small tables."""

import hashlib
import re
from itertools import combinations

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def grams(text, size=5):
    held = words(text)
    return {tuple(held[k:k + size]) for k in range(max(1, len(held) - size + 1))} if held else {("text", text or "")}


def near(rows, threshold=0.8):
    """class_id and n_links per (id, text), by comparing all pairs."""
    sets = [grams(t) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for x, y in combinations(range(len(rows)), 2):
        shared = len(sets[x] & sets[y])
        if shared >= threshold * (len(sets[x]) + len(sets[y]) - shared) - 1e-9 and shared:
            links[x] += 1
            links[y] += 1
            root[top(y)] = top(x)
    ids = {}
    for k, (name, _) in enumerate(rows):
        if name is not None:
            ids[top(k)] = min(name, ids.get(top(k), name))
    return [(name, ids.get(top(k)), links[k]) for k, (name, _) in enumerate(rows)]


def contaminated(text, items, size=10):
    """Words hit, and the items whose windows stand in the text."""
    held, hit, found = words(text), set(), set()
    for name, item in items:
        own = words(item)
        k = min(size, len(own))
        for at in range(len(own) - k + 1 if own else 0):
            for place in range(len(held) - k + 1):
                if held[place:place + k] == own[at:at + k]:
                    hit.update(range(place, place + k))
                    found.add(str(name))
    return len(held), len(hit), sorted(found)


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    ]
    return [(kind, *m.span()) for kind, rule, good in rules for m in re.finditer(rule, text) if good(m[0])]


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def forest(rows, size=4, percent=80):
    """(id, shingles, component, kept) per (id, text), by comparing all pairs of different sets."""
    sets = []
    for _, text in rows:
        held = [w.translate({c: c + 32 for c in range(65, 91)}) for w in plain_words(text)]
        sets.append(frozenset(tuple(held[k:k + size]) for k in range(max(1, len(held) - size + 1))) if held else frozenset())
    root = {s: s for s in sets}

    def top(s):
        while root[s] != s:
            s = root[s]
        return s

    for x, y in combinations([s for s in root if s], 2):
        if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
            shared = len(x & y)
            if 100 * shared >= percent * (len(x) + len(y) - shared):
                root[top(y)] = top(x)
    least = {}
    for (name, _), s in zip(rows, sets):
        if s and name is not None:
            least[top(s)] = min(name, least.get(top(s), name))
    made = []
    for (name, _), s in zip(rows, sets):
        component = least.get(top(s)) if s else name
        made.append((name, len(s), component, name == component))
    return made


def runs(words):
    """(start, length, period) of every run, by walking along every lag."""
    found = {}
    for lag in range(1, len(words) // 3 + 1):
        at = lag
        while at < len(words):
            if words[at] != words[at - lag]:
                at += 1
                continue
            first = at
            while at < len(words) and words[at] == words[at - lag]:
                at += 1
            if at - first + lag >= max(24, 3 * lag):
                found.setdefault((first - lag, at), lag)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def collapsed(words, found):
    dropped = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in dropped)


def repaired(rows):
    """The report of one conversation of (turn, role, text), by a search over all edits."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (
        r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    turns = [t for t, _, _ in rows if t is not None]
    faults, seen, symbols = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}, set(), []
    for _, role, text in rows:
        filled = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not filled else "duplicate" if (role, text) in seen else "truncated" if filled[-1] not in ".!?" else ""
        seen.add((role, text))
        faults[fault] += 1
        symbols.append((role, text, fault in ("blank", "duplicate"), 3 * (fault == "truncated")))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    follows = {"": "s u", "s": "u", "u": "a", "a": "u"}
    paths = {"": (0, "", [])}

    def offer(to, state, cost, letter, line):
        before, end = paths[state], line[0][:1] if line else state
        new = (before[0] + cost, before[1] + letter, before[2] + line)
        if end not in to or new[:2] < to[end][:2]:
            to[end] = new

    def insertions():
        for _ in range(4):
            for state in list(paths):
                for name in ("user", "assistant"):
                    if name[0] in follows[state].split():
                        offer(paths, state, 3, "I", [name + ":"])

    for role, text, must, extra in symbols:
        insertions()
        after = {}
        for state in paths:
            offer(after, state, 4, "D", [])
            if not must:
                if role[:1] and role[:1] in follows[state].split():
                    offer(after, state, extra, "K", [f"{role}:{text}"])
                for name in ("user", "assistant"):
                    if name[0] in follows[state].split():
                        offer(after, state, 3 + extra, "R", [f"{name}:{text}"])
        paths = after
    insertions()
    cost, audit, lines = min((v for s, v in paths.items() if s in ("", "a")), key=lambda v: v[:2])
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())
