"""Language of a text: words first, and character n-grams for words the model does not know.

A known word adds its log frequency per language. An unknown one adds the mean log frequency of its
longest n-grams that the model knows, each step to shorter n-grams weighing less.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.shared import drop_kept, map_pieces, pieces, written

UNKNOWN = "und"
#: Labelled rows the model learns from: at most about so many, chosen by a hash of the id and the text.
SAMPLE_ROWS = 20_000
#: Words, and n-grams of each order, that the model keeps of each language: its most frequent ones.
WORDS, GRAMS, ORDERS = 40_000, 20_000, (4, 3, 2, 1)
#: Terms of one count go in so many groups, by a hash, where not all of them have room.
GROUPS = 1024
#: Each step back to shorter n-grams weighs so much.
BACKOFF = 0.7
WEIGHTS = {order: BACKOFF**k for k, order in enumerate(ORDERS)}
#: Numbers of the scores of unknown words that a task keeps.
KEPT = 400_000
_LETTERS = re.compile(r"[^\W\d_]+")


class Terms:
    """Log frequencies of terms per language, as rows of the languages that have the term.

    A language without a term has the log of half an occurrence, which is the same for all terms: so it is kept
    once, in ``least``, and a row holds what the others have beyond it. The table grows with the terms that
    languages have, not with terms times languages.
    """

    def __init__(self, rows: list, langs: list[str]):
        place, counts = {lang: k for k, lang in enumerate(langs)}, {}
        totals = np.zeros(len(langs))
        for r in rows:
            counts.setdefault(r["term"], []).append((place[r["lang"]], r["n"]))
            totals[place[r["lang"]]] += r["n"]
        self.least = np.log(0.5 / (totals + 0.5 * (len(counts) + 1)))
        self.row = {term: k for k, term in enumerate(counts)}
        self.begin, self.lang, self.more = array("q", [0]), array("i"), array("d")
        for held in counts.values():
            for lang, n in held:
                self.lang.append(lang)
                self.more.append(math.log((n + 0.5) / 0.5))
            self.begin.append(len(self.lang))

    def add(self, row: int, times: float, total: list[float]) -> None:
        for k in range(self.begin[row], self.begin[row + 1]):
            total[self.lang[k]] += times * self.more[k]


@dataclass
class Model:
    langs: list[str]
    words: Terms
    grams: dict[int, Terms]
    met: dict[str, tuple] = field(default_factory=dict)

    def unseen(self, word: str) -> tuple[int, list[tuple[int, float]]]:
        """What a word says that the model does not know: the order of its n-grams, and the languages that have
        them. Kept, within bounds, for when it comes again."""
        said = self.met.get(word)
        if said is None:
            if len(self.met) * (4 + len(self.langs)) >= KEPT:
                self.met.clear()
            said = self.met[word] = self._backed_off(word)
        return said

    def _backed_off(self, word: str) -> tuple[int, list[tuple[int, float]]]:
        padded = f"^{word}$"
        for order in ORDERS:
            known = self.grams[order]
            at = [known.row[g] for i in range(len(padded) - order + 1) if (g := padded[i:i + order]) in known.row]
            if at:
                total = [0.0] * len(self.langs)
                for row in at:
                    known.add(row, 1.0 / len(at), total)
                return order, [(k, x) for k, x in enumerate(total) if x]
        return 0, []

    def predict(self, text: str | None) -> tuple[str, float]:
        found = Counter(_LETTERS.findall((text or "").lower()))
        # The pattern also takes numerals such as a half: they are no letters.
        if not self.langs or not any(c.isalpha() for word in found for c in word):
            return UNKNOWN, 0.0
        total, known, backed = [0.0] * len(self.langs), 0, dict.fromkeys(ORDERS, 0)
        row, add = self.words.row, self.words.add
        for word, n in found.items():
            k = row.get(word)
            if k is not None:
                known += n
                add(k, n, total)
                continue
            order, said = self.unseen(word)
            if order:
                backed[order] += n
                for lang, more in said:
                    total[lang] += n * WEIGHTS[order] * more
        score = np.array(total) + known * self.words.least
        for order, n in backed.items():
            score += n * WEIGHTS[order] * self.grams[order].least
        best = int(score.argmax())
        return self.langs[best], float(1 / np.exp(score - score[best]).sum())


def _looked_up(values: dict, key: Column, kind: str) -> Column:
    """The value of a column's key in a small dictionary; null without one."""
    if not values:
        return F.lit(None).cast(kind)
    return F.element_at(F.create_map(*(F.lit(x).cast(t) for k, v in values.items() for x, t in ((k, "string"), (v, kind)))), key)


def _most_frequent(counted: DataFrame, most: dict[int, int]) -> Column:
    """Which rows of (kind, term, lang, n) are among the ``most`` frequent of their language, by kind.

    Counts of counts say from which one on a language's terms have room; of those that just have that count,
    so many groups go in as fill it. No task sorts or holds the terms of a language, however many it has.
    """
    key = F.concat_ws(":", F.col("kind").cast("string"), "lang")
    part = F.pmod(F.xxhash64("term"), F.lit(GROUPS))
    each = counted.select(key.alias("key"), part.alias("part"), "n")

    def filled(counts: DataFrame, room: dict[str, int], falling: bool) -> tuple[dict[str, int], dict[str, int]]:
        # By key the value at which the room runs out, and what is left of the room there.
        found: dict[str, list] = {}
        for key, value, times in counts.collect():
            found.setdefault(key, []).append((value, times))
        ends, rest = {}, {}
        for key, some in found.items():
            left = room[key] if key in room else most[int(key.split(":")[0])]
            for value, times in sorted(some, reverse=falling):
                if times > left:
                    ends[key], rest[key] = value, left
                    break
                left -= times
        return ends, rest

    least, room = filled(each.groupBy("key", "n").count(), {}, True)
    tied = each.where(F.col("n") == _looked_up(least, F.col("key"), "long")).groupBy("key", "part").count()
    last, _ = filled(tied, room, False) if least else ({}, {})
    bound = F.coalesce(_looked_up(least, key, "long"), F.lit(0))
    return (F.col("n") > bound) | ((F.col("n") == bound) & (part <= F.coalesce(_looked_up(last, key, "long"), F.lit(-1))))


def _quota(counts: dict[str, int], most: int) -> float:
    """How many rows of a language may be taken, so that all together are ``most``: small ones give all."""
    left, rest = most, sorted(counts.values())
    while rest and rest[0] * len(rest) <= left:
        left -= rest.pop(0)
    return left / len(rest) if rest else float("inf")


def _sample(rows: DataFrame, id_col: str, text_col: str, lang_col: str, most: int) -> DataFrame:
    """About ``most`` rows, chosen by a hash: an equal part of each language, all rows of one that has fewer."""
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    quota = _quota(counts, most)
    large = {lang: int((1 << 40) * quota / n) for lang, n in counts.items() if n > quota}
    if not large:
        return rows
    bounds = F.create_map(*(F.lit(x) for pair in large.items() for x in pair))
    bound = F.coalesce(F.element_at(bounds, F.col(lang_col)), F.lit(1 << 40))
    return rows.where(F.pmod(F.xxhash64(F.struct(id_col, text_col), F.lit(7)), F.lit(1 << 40)) < bound)


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from rows whose text and language are not null; a bounded sample of them, an equal part of
    each language.

    Counting is distributed; the driver gets the most frequent terms only, ``WORDS`` and ``GRAMS`` of each
    language (ties by a hash of the term), of those that occur more than once in the sample. So the model is
    bounded by the sample, whatever the number of languages. Without labelled rows it knows no language.
    """
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = _sample(rows, id_col, text_col, lang_col, sample_rows)
    rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))

    def count(columns: dict[str, list]) -> dict:
        drop_kept()
        words: dict[str, Counter] = {}
        for text, lang in zip(columns["text"], columns["lang"]):
            words.setdefault(lang, Counter()).update(_LETTERS.findall(text.lower()))
        made = []
        for lang, found in words.items():
            grams: Counter = Counter()
            for word, n in found.items():
                padded = f"^{word}$"
                for order in ORDERS:
                    for i in range(len(padded) - order + 1):
                        grams[order, padded[i:i + order]] += n
            made += [(lang, 0, w, n) for w, n in found.items()]
            made += [(lang, order, g, n) for (order, g), n in grams.items()]
        return dict(zip(("lang", "kind", "term", "n"), map(list, zip(*made)))) if made else {
            "lang": [], "kind": [], "term": [], "n": []}

    counted = written(
        map_pieces(rows, "lang string, kind int, term string, n long", count)
        .groupBy("kind", "term", "lang").agg(F.sum("n").alias("n")), "terms")
    # Each language gives its most frequent terms, so that a rare language keeps its own.
    langs = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    often = counted.groupBy("kind", "term").agg(F.sum("n").alias("total")).where("total > 1").drop("total")
    counted = written(counted.join(often, ["kind", "term"]), "terms")
    chosen = _most_frequent(counted, {kind: GRAMS if kind else WORDS for kind in (0, *ORDERS)})
    tables = {}
    for kind in (0, *ORDERS):
        own = counted.where(F.col("kind") == kind)
        top = own.where(chosen).select("term").distinct()
        tables[kind] = Terms(own.join(top, "term").select("term", "lang", "n").collect(), langs)
    return Model(langs, tables.pop(0), tables)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, lang_pred, score) per row; only the text is looked at.

    A null text or one without a letter is ``und`` with score 0, as is every text when nothing was
    learned. Ties go to the language that sorts first. Long texts are read whole; repeated rows are
    judged alike; other columns are left out.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def work(columns: dict[str, list]) -> dict:
        made = [held.value.predict(t) for t in columns["text"]]
        return {"id": columns["id"], "lang_pred": [m[0] for m in made], "score": [m[1] for m in made]}

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_pieces(rows, f"id {kind}, lang_pred string, score double", work).withColumnRenamed("id", id_col)


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text has a language: those predicted ``und`` go.

    These are null and empty texts and those without a letter, or all when nothing was learned. Repeated rows
    are judged alike, ties and long texts as by ``predict``; only ``text_col`` is looked at, whatever the names
    of the others. An empty table stays one.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        drop_kept()
        for piece in (p for batch in batches for p in pieces(batch)):
            texts = piece.column(piece.schema.get_field_index(text_col)).to_pylist()
            yield piece.filter(pa.array([held.value.predict(t)[0] != UNKNOWN for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def accuracy(predicted: DataFrame, truth: DataFrame, id_col: str = "doc_id") -> float:
    both = predicted.join(truth, id_col)
    return both.select(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0] or math.nan
