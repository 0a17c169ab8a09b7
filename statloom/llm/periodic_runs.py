"""Periodic runs of words: an online sparse diagonal DP over the earlier occurrences of what is read.

A run is a longest stretch with smallest period q and at least max(24, 3q) words. Seen from its lag q it is a
diagonal of matches, words equal to the word q before, at least max(24 - q, 2q) of them. So the DP needs no
step per single word: lags from 2^k to 2^(k+1) - 1 are followed in steps of 2^k words (lags below 16 in steps
of 8), and no diagonal that can become a run is shorter than two steps less a word.

At each step the earlier occurrences of the words just read, at the lags of that step size, lengthen the
active diagonals; those that do not go on end, and are told if they are long enough once their ends, less
than a step away on either side, are known to the word. The work is a comparison per word and step size,
and a step per match: n log n for the worst text, whatever its words.

Equality of windows is by name, not by hash: the windows of 2^k words that occur more than once are numbered
from the pairs of windows half as long, so the result is exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: The least words of a run, and the least number of its periods.
LEAST, TIMES = 24, 3
#: Words that are looked at together (more for one longer text).
TOGETHER = 1 << 18


def _names(names: np.ndarray, half: int, n: int) -> np.ndarray:
    """Names of the windows of twice ``half`` words; negative for a window that occurs once."""
    count = max(0, n - 2 * half + 1)
    made = np.full(n, -1, np.int64)
    twice = np.flatnonzero((names[:count] >= 0) & (names[half:half + count] >= 0))
    if len(twice):
        key = names[twice] * (int(names.max()) + 1) + names[twice + half]
        _, name, times = np.unique(key, return_inverse=True, return_counts=True)
        again = times[name] > 1
        made[twice[again]] = name[again]
    return made


def _same(names: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Where the windows at x and y are equal; false outside."""
    inside = (x >= 0) & (y >= 0) & (x < len(names)) & (y < len(names))
    found = names[np.where(inside, x, 0)]
    return inside & (found >= 0) & (found == names[np.where(inside, y, 0)])


def _ended(points: tuple[np.ndarray, np.ndarray], step: int):
    """The diagonals (lag, first step, last step) of the matches (place, lag), in the order of places."""
    active: dict[int, tuple[int, int]] = {}
    for place, lag in zip(points[0].tolist(), points[1].tolist()):
        first, last = active.get(lag, (place, place - step))
        if last + step == place:
            active[lag] = first, place
        else:
            yield lag, first, last
            active[lag] = place, place
    for lag, (first, last) in active.items():
        yield lag, first, last


def runs(words: np.ndarray, longest: int | None = None) -> np.ndarray:
    """Rows (start, length, period), by start, then period, for the numbers of words from 0.

    ``longest`` bounds the words of a single text if ``words`` holds several, each with numbers of its own.
    """
    n = len(words)
    longest = n if longest is None else longest
    if longest < LEAST:
        return np.zeros((0, 3), np.int64)
    levels, found = [], []
    times = np.bincount(words)
    level = np.where(times[words] > 1, words, -1).astype(np.int64)
    size = 1
    while True:
        levels.append(level)
        if size >= 8:
            first, end = (1, 16) if size == 8 else (size, 2 * size)
            if first * TIMES > longest:
                break
            places = np.arange(0, n, size)
            found.append(_diagonals(levels, places[level[places] >= 0], first, end, size))
        if not (level >= 0).any():
            break
        level = _names(level, size, n)
        size *= 2
    found = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    # A multiple of a period gives the same stretch: the smallest is the run's.
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[new]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _diagonals(levels: list[np.ndarray], places: np.ndarray, first: int, end: int, step: int) -> np.ndarray:
    """The stretches (start, length, lag) of the lags from ``first`` up to ``end`` that are long enough."""
    names, at, lags = levels[-1], [], []
    each = max(1, (1 << 20) // (end - first))
    for low in range(0, len(places), each):
        some = places[low:low + each]
        before = some[:, None] - np.arange(first, end)[None, :]
        same = (before >= 0) & (names[np.maximum(before, 0)] == names[some][:, None])
        row, column = np.nonzero(same)
        at.append(some[row])
        lags.append(column + first)
    if not sum(map(len, at)):
        return np.zeros((0, 3), np.int64)
    told = np.array(list(_ended((np.concatenate(at), np.concatenate(lags)), step)), np.int64)
    lag, left, right = told[:, 0], told[:, 1].copy(), told[:, 2] + step
    size = step
    for names in reversed(levels[:-1]):  # less than a step is left to find on either side
        size //= 2
        left -= size * _same(names, left - size, left - size - lag)
        right += size * _same(names, right, right - lag)
    length = right - left + lag
    enough = length >= np.maximum(LEAST, TIMES * lag)
    return np.stack([left - lag, length, lag], axis=1)[enough]


def numbered(texts: list[list[bytes]]) -> np.ndarray:
    """Words as numbers, other ones in every text."""
    made, used = [], 0
    for words in texts:
        seen: dict[bytes, int] = {}
        made.append(np.array([seen.setdefault(w, len(seen)) for w in words], np.int64) + used)
        used += len(seen)
    return np.concatenate(made) if made else np.zeros(0, np.int64)


def runs_of(texts: list[list[bytes]]) -> list[tuple[np.ndarray, list[bytes]]]:
    """Per text its runs and the words that are left when each run keeps its first period only."""
    starts = np.cumsum([0, *map(len, texts)])
    found = runs(numbered(texts), max(map(len, texts), default=0))
    cut = np.searchsorted(found[:, 0], starts)
    change = np.zeros(starts[-1] + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    dropped = np.cumsum(change) > 0
    made = []
    for k, words in enumerate(texts):
        own = found[cut[k]:cut[k + 1]] - [starts[k], 0, 0]
        if len(own):
            keep = np.flatnonzero(~dropped[starts[k]:starts[k + 1]])
            words = [words[i] for i in keep.tolist()]
        made.append((own, words))
    return made


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_words, runs array of (start, length, period), collapsed) per row.

    Words are what stands between ASCII white space, numbered from 0. ``runs`` are sorted by start, then
    period; runs may overlap, each has its smallest period. ``collapsed`` is the text without the words that
    stand in a run after its first period, joined by one space.

    Null and empty texts, and those of white space only, have no words: no runs, an empty ``collapsed``. Texts
    of any length are read whole. Repeated rows and null ids each get their row. Other columns, whatever their
    names, are left out. An empty table gives no rows.
    """
    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(kinds)

        def told(ids, texts):
            made = runs_of(texts)
            return pa.RecordBatch.from_arrays([
                pa.array(ids, schema[0].type), pa.array(list(map(len, texts)), pa.int64()),
                pa.array([[{"start": s, "length": n, "period": p} for s, n, p in own.tolist()] for own, _ in made], schema[2].type),
                pa.array([b" ".join(left).decode() for _, left in made], pa.string())], schema=schema)

        ids, texts, total = [], [], 0
        for batch in batches:
            for name, text in zip(*batch.columns):
                words = (text.as_py() or "").encode().split()
                if texts and total + len(words) > TOGETHER:
                    yield told(ids, texts)
                    ids, texts, total = [], [], 0
                ids.append(name.as_py())
                texts.append(words)
                total += len(words)
        if texts:
            yield told(ids, texts)

    rows = docs.select(id_col, text_col)
    kinds = T._parse_datatype_string(
        f"`{id_col}` {rows.dtypes[0][1]}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return rows.mapInArrow(run, kinds)
