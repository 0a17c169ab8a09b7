"""Repair of conversations by cheapest edits, with block tables in the manner of the Four Russians.

A conversation shall read ``(system? (user assistant)+)?`` by the initials of its roles. A row becomes a
symbol: it has to go, or its initial and whether its text is cut off. For the four states of that pattern
the costs to the end are a vector; less its least entry it is one of few. So the step over every block of
``BLOCK`` symbols is precomputed for every such vector: a table of the vector before the block and the cost
that comes off. Blocks are processed by lookup, from the end; then they are expanded one by one, in the
order opposite to that, and edits are read off from the start, always the least letter that still costs
least. That is what makes ties safe: a cheapest edit list is chosen by its own order and not by the table's.

Rows are sorted by ranges of conversation and turn, so a conversation with most of the rows lies in many
partitions. What lies inside a partition is repaired there. What may go on in another one is cut into
segments: each gives its costs between all pairs of states, these are put together along the conversation
(some numbers per segment), and with the vector behind it and the state before it each segment is traced on
its own. Only the digest of a long conversation's text has to see its pieces one after the other.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.llm.shared import kept_in_worker, written

#: Symbols of a block.
BLOCK = 3
#: Rows and bytes of text of one segment.
SEGMENT_ROWS, SEGMENT_BYTES = 16_384, 16 << 20
RETYPE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3

_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = [_USER, _USER, _ASSISTANT, _USER]
_KEEP = {(_START, 0): _SYSTEM, (_START, 1): _USER, (_SYSTEM, 1): _USER, (_USER, 2): _ASSISTANT, (_ASSISTANT, 1): _USER}
_NAME = {_USER: "user", _ASSISTANT: "assistant"}
_KIND = {"s": 0, "u": 1, "a": 2}
#: 0: the row has to go; 1 + 2 * (s, u, a, other) + (1 if the text is cut off).
_SYMBOLS = 9
_FAR = 1 << 20
_FINAL = (0, 2 * INSERT, INSERT, 0)

_FILLED = re.compile(r"[^\x20\x09-\x0D]")
_SPACE = " \t\n\x0b\x0c\r"


def _before(after: tuple, symbol: int) -> list[int]:
    """Costs to the end from each state before a row, from those behind it."""
    kind, extra = (symbol - 1) >> 1, CUT_OFF * ((symbol - 1) & 1)
    costs = []
    for state in range(4):
        ways = [DELETE + after[state]]
        if symbol:
            ways.append(RETYPE + extra + after[_NEXT[state]])
            if (state, kind) in _KEEP:
                ways.append(extra + after[_KEEP[state, kind]])
        costs.append(min(*ways, _FAR))
    for _ in range(3):  # rows put in before this one
        costs = [min(c, INSERT + costs[_NEXT[s]]) for s, c in enumerate(costs)]
    return costs


class Tables:
    """Every vector that can come up, and the steps over one symbol and over a block."""

    def __init__(self):
        basis = [tuple(0 if s == t else _FAR for s in range(4)) for t in range(4)]
        self.vectors = [_FINAL, *basis]
        self.index = {v: k for k, v in enumerate(self.vectors)}
        self.next, self.cost = [], []
        for vector in self.vectors:  # grows while it is read
            steps = []
            for symbol in range(_SYMBOLS):
                raw = _before(vector, symbol)
                least = min(raw)
                steps.append((self.number([_FAR if c >= _FAR else c - least for c in raw]), least))
            self.next.append([s[0] for s in steps])
            self.cost.append([s[1] for s in steps])
        one, price = np.array(self.next), np.array(self.cost)
        at, total = np.arange(len(one))[:, None], np.zeros((len(one), 1), np.int64)
        for _ in range(BLOCK):  # the last symbol of a block comes first
            total = (total[:, None, :] + price[at].transpose(0, 2, 1)).reshape(len(one), -1)
            at = one[at].transpose(0, 2, 1).reshape(len(one), -1)
        self.block_next, self.block_cost = at.tolist(), total.tolist()
        self.weights = _SYMBOLS ** np.arange(BLOCK - 1, -1, -1)

    def number(self, vector) -> int:
        vector = tuple(vector)
        if vector not in self.index:
            self.index[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.index[vector]

    def passed(self, symbols: bytes, behind: int) -> tuple[list[int], int, int]:
        """The vectors behind each whole block, the one before all symbols, and the cost that came off."""
        whole, cost, vector = len(symbols) // BLOCK * BLOCK, 0, behind
        for symbol in reversed(symbols[whole:]):
            cost += self.cost[vector][symbol]
            vector = self.next[vector][symbol]
        blocks = np.frombuffer(symbols[:whole], np.uint8).reshape(-1, BLOCK) @ self.weights
        ends = []
        for block in reversed(blocks.tolist()):
            ends.append(vector)
            cost += self.block_cost[vector][block]
            vector = self.block_next[vector][block]
        return ends[::-1], vector, cost

    def matrix(self, symbols: bytes) -> list[int]:
        """The least cost from each state before the symbols to each state behind them, row by row."""
        columns = []
        for state in range(4):
            _, vector, cost = self.passed(symbols, 1 + state)
            columns.append([min(_FAR, c + cost) for c in self.vectors[vector]])
        return [columns[t][s] for s in range(4) for t in range(4)]

    def trace(self, symbols: bytes, behind: int, state: int) -> tuple[str, int, int]:
        """The least of the cheapest edit lists, its cost, and the state it leads to."""
        ends, _, _ = self.passed(symbols, behind)
        whole, letters, cost = len(ends) * BLOCK, [], 0
        for at, end in zip(range(0, whole + 1, BLOCK), [*ends, behind]):
            group = symbols[at:at + BLOCK] if at < whole else symbols[whole:]
            vectors = [end]
            for symbol in reversed(group):
                vectors.append(self.next[vectors[-1]][symbol])
            for symbol, (after, before) in zip(group, itertools.pairwise(reversed(vectors))):
                here, there = self.vectors[after], self.vectors[before]
                least, kind, extra = self.cost[before][symbol], (symbol - 1) >> 1, CUT_OFF * ((symbol - 1) & 1)
                while True:
                    now = here[state] + least
                    if now == DELETE + there[state]:
                        letters.append("D")
                        cost += DELETE
                        break
                    if now == INSERT + here[_NEXT[state]] + least:
                        letters.append("I")
                        cost += INSERT
                        state = _NEXT[state]
                        continue
                    to = _KEEP.get((state, kind))
                    if to is not None and now == extra + there[to]:
                        letters.append("K")
                        cost += extra
                    else:
                        letters.append("R")
                        cost += RETYPE + extra
                        to = _NEXT[state]
                    state = to
                    break
        return "".join(letters), cost, state


def ending(state: int) -> str:
    """The rows that have to be put in behind the last one."""
    return "I" * (_FINAL[state] // INSERT)


def tables() -> Tables:
    return kept_in_worker(("conversation tables", BLOCK), Tables)


def symbol_of(role: str, text: str, seen: bool) -> tuple[int, str]:
    """The symbol of a row, and its first fault: blank, duplicate, truncated or none."""
    if not _FILLED.search(text):
        return 0, "blank"
    if seen:
        return 0, "duplicate"
    cut = text.rstrip(_SPACE)[-1] not in ".!?"
    return 1 + 2 * _KIND.get(role[:1], 3) + cut, "truncated" if cut else ""


def applied(letters: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """The roles and texts after the edits."""
    rows, made_roles, made_texts = zip(roles, texts), [], []
    for letter in letters:
        if letter == "I":
            role, text = _NAME[_NEXT[state]], ""
        else:
            role, text = next(rows)
            if letter == "D":
                continue
            if letter == "R":
                role = _NAME[_NEXT[state]]
        state = _KEEP[state, _KIND[role[:1]]]
        made_roles.append(role)
        made_texts.append(text)
    return made_roles, made_texts


def _illegal(before: str | None, after: str) -> int:
    return int(before is not None and before + after not in ("su", "ua", "au"))


class _Segment:
    """Consecutive rows of one conversation, and what is counted of them."""

    def __init__(self, conversation, part: int, number: int):
        self.key = conversation, part, number
        self.roles, self.texts, self.symbols, self.bytes = [], [], bytearray(), 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.first, self.last = 0, None, None
        self.low, self.high, self.turns = None, None, 0

    def add(self, turn, role: str, text: str, seen: bool):
        symbol, fault = symbol_of(role, text, seen)
        if fault:
            self.faults[fault] += 1
        initial = role[:1]
        self.illegal += _illegal(self.last, initial)
        self.first = initial if self.first is None else self.first
        self.last = initial
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        self.symbols.append(symbol)
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(text)

    def row(self, whole: bool) -> dict:
        held = tables()
        symbols, roles, texts, matrix, audit, cost = bytes(self.symbols), self.roles, self.texts, None, None, None
        if whole:
            audit, cost, state = held.trace(symbols, 0, _START)
            audit, cost = audit + ending(state), cost + _FINAL[state]
            roles, texts = applied(audit, _START, roles, texts)
            symbols = None
        else:
            matrix = held.matrix(symbols)
        return {
            "conversation": self.key[0], "part": self.key[1], "number": self.key[2], "whole": whole, **self.faults,
            "illegal": self.illegal, "first": self.first, "last": self.last, "low": self.low, "high": self.high,
            "turns": self.turns, "symbols": symbols, "matrix": matrix, "cost": cost, "audit": audit, "roles": roles,
            "texts": texts}


_STATS = "blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, turns long"
_PIECE = "cost long, audit string, roles array<string>, texts array<string>"


def _schema(columns: str) -> T.StructType:
    return T._parse_datatype_string(columns)


def _rows_out(rows: Iterator[dict], kinds: T.StructType) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema, held, size = to_arrow_schema(kinds), [], 0
    for row in rows:
        held.append(row)
        size += 200 + sum(map(len, row.get("texts") or ()))
        if size > 8 << 20:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _rows_in(batches) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 512).columns))


def _segments(batches) -> Iterator[dict]:
    """Sorted rows (conversation, turn, role, mark, text, later) to segments; whole conversations are repaired.

    The first and the last conversation of a partition may go on outside it, a very long one does so anyway.
    """
    part, segment, before, opened = TaskContext.get().partitionId(), None, None, True
    for conversation, turn, role, mark, text, later in _rows_in(batches):
        if segment is None:
            segment = _Segment(conversation, part, 0)
        elif conversation != segment.key[0]:
            yield segment.row(not opened)
            opened, before = False, None
            segment = _Segment(conversation, part, segment.key[2] + 1)
        elif len(segment.roles) >= SEGMENT_ROWS or segment.bytes >= SEGMENT_BYTES:
            yield segment.row(False)
            opened = True
            segment = _Segment(conversation, part, segment.key[2] + 1)
        segment.add(turn, role, text, later or (turn, role, mark) == before)
        before = turn, role, mark
    if segment is not None:
        yield segment.row(False)


def _vectors_behind(batches) -> Iterator[dict]:
    """Segments (conversation, part, number, matrix) in descending order: the costs to the end behind each."""
    now, vector, some = None, None, False
    for conversation, part, number, matrix in _rows_in(batches):
        last = not some or conversation != now
        if last:
            now, vector, some = conversation, list(_FINAL), True
        yield {"part": part, "number": number, "final": last, "behind": vector}
        vector = [min(_FAR, *(matrix[4 * s + t] + vector[t] for t in range(4))) for s in range(4)]
        vector = [c if c >= _FAR else c - min(vector) for c in vector]


def _states_behind(batches) -> Iterator[dict]:
    """Segments with the vector behind them: the state each state before leads to."""
    held = tables()
    for conversation, part, number, symbols, behind in _rows_in(batches):
        vector = held.index[tuple(behind)]
        yield {"conversation": conversation, "part": part, "number": number,
               "states": [held.trace(symbols, vector, s)[2] for s in range(4)]}


def _states_before(batches) -> Iterator[dict]:
    """Segments (conversation, part, number, states) in order: the state before each."""
    now, state, some = None, _START, False
    for conversation, part, number, states in _rows_in(batches):
        if not some or conversation != now:
            now, state, some = conversation, _START, True
        yield {"part": part, "number": number, "before": state}
        state = states[state]


def _traced(rows: Iterator[dict]) -> Iterator[dict]:
    held = tables()
    for row in rows:
        audit, cost, state = held.trace(row["symbols"], held.index[tuple(row["behind"])], row["before"])
        if row["final"]:
            audit, cost = audit + ending(state), cost + _FINAL[state]
        row["roles"], row["texts"] = applied(audit, row["before"], row["roles"], row["texts"])
        yield {**row, "audit": audit, "cost": cost}


def repair(rows: DataFrame, conversation_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Pieces of repaired conversations: (conversation, part, number, whole, counts, cost, audit, roles, texts).

    A conversation's pieces in the order of part and number are the conversation: ``audit`` the letters of
    the edits, ``roles`` and ``texts`` the rows that are left or put in. Nearly all have one piece (``whole``).
    ``messages`` gives one row per message, ``report`` one per conversation.

    Rows are read in the order of turn, nulls first; rows of one turn by role, then by the MD5 of the text. A
    row without anything but white space is blank, one whose role and text came before a duplicate, one whose
    text does not end in ``. ! ?`` truncated; its first fault counts. Null roles and texts are one space, so
    such texts are blank; a null conversation is one of its own. Texts of any length are read whole, and
    repeated rows are duplicates. Other columns, whatever their names, are left out. An empty table gives no
    rows.
    """
    kind = dict(rows.dtypes)[conversation_col]
    rows = rows.select(
        F.col(conversation_col).alias("conversation"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))
    rows = rows.withColumn("mark", F.md5("text"))
    first = rows.groupBy("conversation", "role", "mark").agg(
        F.min(F.struct("turn")).alias("first"), F.max(F.struct("turn")).alias("last")).where("not (first <=> last)")
    first = first.select(F.col("conversation").alias("c"), F.col("role").alias("r"), F.col("mark").alias("m"),
                         F.col("first.turn").alias("first_turn"), F.lit(True).alias("again"))
    same = F.col("conversation").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("mark") == F.col("m"))
    later = F.coalesce(F.col("again"), F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    order = ["conversation", "turn", "role", "mark"]
    rows = rows.join(first, same, "left").select(*order, "text", later.alias("later"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    key = f"conversation {kind}, part int, number long"
    cut = _schema(f"{key}, whole boolean, {_STATS}, symbols binary, matrix array<int>, {_PIECE}")
    segments = written(rows.mapInArrow(lambda b: _rows_out(_segments(b), cut), cut), "segments")
    opened = segments.where("not whole")

    def along(frame, work, columns, *by):
        schema = _schema(columns)
        dealt = frame.repartition("conversation").sortWithinPartitions("conversation", *by)
        return written(dealt.mapInArrow(lambda b: _rows_out(work(b), schema), schema), "along")

    behind = along(opened.select("conversation", "part", "number", "matrix"), _vectors_behind,
                   "part int, number long, final boolean, behind array<int>", F.desc("part"), F.desc("number"))
    states = _schema(f"{key}, states array<int>")
    found = opened.select("conversation", "part", "number", "symbols").join(behind.drop("final"), ["part", "number"])
    found = found.select("conversation", "part", "number", "symbols", "behind").mapInArrow(
        lambda b: _rows_out(_states_behind(b), states), states)
    before = along(found, _states_before, "part int, number long, before int", "part", "number")
    traced = opened.drop("matrix", "cost", "audit").join(behind, ["part", "number"]).join(before, ["part", "number"])
    piece = _schema(f"{key}, whole boolean, {_STATS}, {_PIECE}")

    def trace(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                yield from _rows_out(_traced(iter(batch.slice(at, 64).to_pylist())), piece)

    made = segments.where("whole").drop("symbols", "matrix")
    return made.unionByName(traced.mapInArrow(trace, piece))


def messages(pieces: DataFrame) -> DataFrame:
    """(conversation, part, number, position, role, text): the repaired rows, in that order."""
    return pieces.select("conversation", "part", "number", F.posexplode(F.arrays_zip("roles", "texts")).alias("position", "m")).select(
        "conversation", "part", "number", "position", F.col("m.roles").alias("role"), F.col("m.texts").alias("text"))


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _reports(batches) -> Iterator[dict]:
    """Pieces in order to one row per conversation; the text goes through the digest piece by piece."""
    def told(held):
        held["gaps"] = 0 if held["low"] is None else held["high"] - held["low"] + 1 - held["turns"]
        held["audit"], held["repaired_sha256"] = "".join(held["audits"]), held["sha"].hexdigest()
        return {k: held[k] for k in ["conversation", *(c.split()[0] for c in _REPORT.split(", "))]}

    held = None
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            if held is None or row["conversation"] != held["conversation"]:
                if held is not None:
                    yield told(held)
                held = {**row, "audits": [], "sha": hashlib.sha256(), "some": False}
            else:
                for name in ("blank", "duplicate", "truncated", "cost"):
                    held[name] += row[name]
                held["illegal"] += row["illegal"] + _illegal(held["last"], row["first"])
                held["last"] = row["last"]
                if row["low"] is not None:
                    held["turns"] += row["turns"] - (row["low"] == held["high"])
                    held["low"] = row["low"] if held["low"] is None else held["low"]
                    held["high"] = row["high"]
            held["audits"].append(row["audit"])
            for role, text in zip(row["roles"], row["texts"]):
                held["sha"].update((("\n" if held["some"] else "") + role + ":" + text).encode())
                held["some"] = True
    if held is not None:
        yield told(held)


def report(pieces: DataFrame, conversations: DataFrame | None = None, conversation_col: str = "conv_id") -> DataFrame:
    """(``conversation_col``, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    One row per conversation; with ``conversations``, one for each of theirs, also where no row was left:
    zeros, an empty audit and the digest of nothing. ``gaps`` counts the missing turns between the first and
    the last one (null turns are ignored), ``illegal`` the adjacent roles that cannot follow each other.
    """
    kind = dict(pieces.dtypes)["conversation"]
    gaps = F.when(F.col("low").isNull(), F.lit(0)).otherwise(F.col("high") - F.col("low") + 1 - F.col("turns"))
    lines = F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t))
    made = pieces.where("whole").select(
        "conversation", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))
    schema = _schema(f"conversation {kind}, {_REPORT}")
    parts = pieces.where("not whole").repartition("conversation").sortWithinPartitions("conversation", "part", "number")
    made = made.unionByName(parts.mapInArrow(lambda b: _rows_out(_reports(b), schema), schema))
    if conversations is None:
        return made.withColumnRenamed("conversation", conversation_col)
    named = conversations.select(F.col(conversation_col).alias("original")).distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return named.join(made, F.col("original").eqNullSafe(F.col("conversation")), "left").select(
        F.col("original").alias(conversation_col), *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
