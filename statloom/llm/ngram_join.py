"""Documents whose word n-grams overlap: MinHash bands propose pairs, full n-gram sets decide.

1. Every text becomes the set of hashes of its n-grams, a digest of that set, and band hashes. Texts of
   equal sets are copies: from here on one row stands for all of them.
2. Rows that share a band hash are tied to the smallest of them (not to each other), and the ties'
   connected components are the families in which pairs are looked for.
3. The texts of a family are brought together once; a large family is cut into blocks and pairs of
   blocks, so no task holds more than two blocks. All pairs there are compared on their full sets, and
   each row keeps its number of links and one tie to what it is linked with: pairs are never written.
4. The components of those ties are the classes.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.shared import PIECE, free_name, written

WORDS, THRESHOLD = 5, 0.8
#: Share of the pairs at the threshold that shall meet in a band, and the hashes that may be spent on it.
RECALL, MOST_HASHES = 0.9999, 128
#: Texts of one block of a family.
BLOCK = 256

_IS_WORD = np.ones(256, bool)
_IS_WORD[:0x30] = _IS_WORD[0x3A:0x61] = _IS_WORD[0x7B:0x80] = False
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_U = np.uint64


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band, so the fewest false pairs, that still reach the recall."""
    best = None
    for rows in range(1, 17):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most:
            best = (bands, rows)
    if best is None:
        raise ValueError("the recall needs more hashes")
    return best


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as the longest text needs."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int):
        if n > len(self.up):
            size = 1 << n.bit_length()
            self.up = np.concatenate([[_U(1)], np.cumprod(np.full(size - 1, _ODD, np.uint64))])
            self.down = np.concatenate([[_U(1)], np.cumprod(np.full(size - 1, _INVERSE, np.uint64))])
        return self.up, self.down


def shingles(text: str, powers: Powers, size: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's n-grams; a shorter text of any words is one n-gram."""
    data = np.frombuffer(text.encode().lower(), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    inside = _IS_WORD[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = powers.upto(len(data) + 1)
    total = np.concatenate([[_U(0)], np.cumsum((data.astype(np.uint64) + _U(1)) * up[:len(data)])])
    words = _mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    n = max(1, len(words) - size + 1)
    grams = np.zeros(n, np.uint64)
    for k in range(min(size, len(words))):
        grams = _mixed(grams + words[k:k + n])
    return np.unique(grams)


def set_digest(grams: np.ndarray, text: str) -> bytes:
    """One value for all texts of equal sets; texts without words are told apart by what they are."""
    return hashlib.md5(grams.tobytes() if len(grams) else b"text" + text.encode()).digest()


def signature(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit hash per band of the least hash values."""
    made = np.random.default_rng(20).integers(0, 1 << 63, (2, bands * rows), dtype=np.uint64)
    factor, shift = made[0] << _U(1) | _U(1), made[1]
    least = np.full(bands * rows, _U(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(grams), 512):
        least = np.minimum(least, (grams[at:at + 512, None] * factor + shift).min(axis=0))
    least = least.reshape(bands, rows)
    hashed = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        hashed = _mixed(hashed + least[:, k])
    return hashed


def signed(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """Per row of (id, text): its key (a, b), the digest of its set and the band hashes of that set."""
    def run(batches):
        powers, known = Powers(), {}
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                a, b, texts = (c.to_pylist() for c in batch.slice(at, PIECE).columns)
                digests, hashes = [], []
                for text in texts:
                    grams = shingles(text, powers, size)
                    digest = set_digest(grams, text)
                    if digest not in known:
                        if len(known) > 20_000:
                            known.clear()
                        known[digest] = signature(grams, bands, rows).view(np.int64) if len(grams) else []
                    digests.append(digest)
                    hashes.append(known[digest])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(hashes, pa.list_(pa.int64()))], names=["a", "b", "set", "bands"])

    return docs.select("a", "b", "text").mapInArrow(run, "a long, b long, set binary, bands array<long>")


def components(ties: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``ties`` (x, y): the smallest node each is connected with.

    Every round maps each node to its smallest neighbour's smallest neighbour and goes on with the ties
    between the nodes that are left; rounds grow with the logarithm of the longest path. Every table is
    written to the shared folder, nothing comes to the driver.
    """
    labels, ties = None, written(ties.distinct(), "ties")
    while True:
        both = ties.union(ties.select("y", "x"))
        least = both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m")).select("node", F.least("node", "m").alias("m"))
        least = written(least, "least")
        further = least.select(F.col("node").alias("m"), F.col("m").alias("mm"))
        step = written(least.join(further, "m").select("node", F.col("mm").alias("label")), "step")
        if labels is None:
            labels = step
        else:
            onward = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
            labels = written(labels.join(onward, "label", "left").select("node", F.coalesce("next", "label").alias("label")), "labels")
        x = step.select(F.col("node").alias("x"), F.col("label").alias("lx"))
        y = step.select(F.col("node").alias("y"), F.col("label").alias("ly"))
        left = ties.join(x, "x").join(y, "y").where("lx <> ly")
        ties = written(left.select(F.least("lx", "ly").alias("x"), F.greatest("lx", "ly").alias("y")).distinct(), "ties")
        if ties.isEmpty():
            return labels


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the sets share."""
    n = len(sets)
    shared = np.zeros((n, n), np.float32)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    useful = times[column] > 1
    column, owner = column[useful], owner[useful]
    if not len(column):
        return shared
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    wide = max(64, (1 << 21) // n)
    for low in range(0, int(column[-1]) + 1, wide):
        a, b = np.searchsorted(column, (low, low + wide))
        part = np.zeros((n, wide), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        shared += part @ part.T
    return shared


def linked(sets: list[np.ndarray], blocks: np.ndarray, threshold: float) -> np.ndarray:
    """Which two of the sets reach the threshold; for two blocks, only pairs across them."""
    sizes = np.array([len(s) for s in sets], np.float64)
    shared = overlaps(sets).astype(np.float64)
    near = shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-9
    np.fill_diagonal(near, False)
    if blocks.min() != blocks.max():
        near &= blocks[:, None] != blocks[None, :]
    return near


def _families(batches, threshold: float, size: int):
    """Links of the rows of one family (or two of its blocks), which stand together, sorted."""
    powers = Powers()
    group, held = None, []

    def done():
        sets = [shingles(r[2], powers, size) for r in held]
        near = linked(sets, np.array([r[4] for r in held]), threshold)
        copies = np.array([r[3] for r in held])
        names = [r[1] for r in held]
        order = sorted(range(len(names)), key=names.__getitem__)
        rank = np.empty(len(names), np.int64)
        rank[order] = np.arange(len(names))
        while True:  # the smallest name each is connected with here
            least = np.minimum(rank, np.where(near, rank[None, :], len(names)).min(axis=1))
            if (least == rank).all():
                break
            rank = least
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array((near * copies[None, :]).sum(axis=1).astype(np.int64)),
             pa.array([names[order[k]] for k in rank], pa.binary())], names=["set", "links", "root"])

    for batch in batches:
        for at in range(0, batch.num_rows, PIECE):
            for row in zip(*(c.to_pylist() for c in batch.slice(at, PIECE).columns)):
                if group is not None and row[0] != group:
                    yield done()
                    held = []
                elif held and held[-1][1] == row[1]:
                    continue  # a row that stands twice in the table comes twice
                group = row[0]
                held.append(row)
    if held:
        yield done()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS,
                    threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(``id_col``, class_id, n_links) per row.

    ``n_links`` is the number of other rows whose n-gram set has at least the threshold's Jaccard
    similarity with the row's own; ``class_id`` the smallest id among all rows connected by such links.
    Null texts count as empty; texts of fewer words than an n-gram are one n-gram; texts without words are
    linked to equal texts only. Repeated rows and equal texts are links too, and never expanded into
    pairs. Null ids give a null class unless the class has another id. Other columns are left out. An
    empty table gives no rows. Within a family the work grows with the square of its different texts,
    in blocks.
    """
    return _classes(docs, id_col, text_col, size, threshold, recall).select(
        F.col("id").alias(id_col), "class_id", "n_links")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text, and the key (a, b) that tells rows apart but for equal ones."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    ident = F.col(id_col).cast("long")
    return docs.select(ident.alias("id"), F.coalesce(ident, F.lit(-(1 << 63))).alias("a"), F.xxhash64(text).alias("b"), text.alias("text"))


def _classes(docs: DataFrame, id_col: str, text_col: str, size: int, threshold: float, recall: float) -> DataFrame:
    bands, rows = bands_for(threshold, recall)
    keyed = _keyed(docs, id_col, text_col)
    marks = written(signed(keyed, size, bands, rows), "signed")
    first = F.min(F.struct("a", "b"))
    sets = marks.groupBy("set").agg(first.alias("first"), F.count(F.lit(1)).alias("copies"), F.max("bands").alias("bands"))
    sets = written(sets, "sets")
    met = sets.select("set", F.explode("bands").alias("band"))
    heads = met.groupBy("band").agg(F.min("set").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    ties = met.join(heads, "band").where("set <> head").select(F.col("set").alias("x"), F.col("head").alias("y"))
    family = components(ties).select(F.col("node").alias("set"), F.col("label").alias("family"))
    sizes = family.groupBy("family").agg(F.count(F.lit(1)).alias("members"))
    members = family.join(sizes, "family").join(sets.select("set", "first", "copies"), "set")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    members = members.select("set", "family", "copies", F.col("first.a").alias("a"), F.col("first.b").alias("b"), blocks.alias("blocks"),
                             F.pmod(F.xxhash64("set"), blocks).cast("int").alias("block"))
    texts = keyed.select("a", "b", "text").join(members, ["a", "b"]).select(
        "set", "text", "copies", "family", "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    group = F.md5(F.concat_ws(":", F.hex("family"), F.least("block", "other"), F.greatest("block", "other")))
    dealt = texts.select(group.alias("group"), "set", "text", "copies", "block")
    dealt = dealt.repartition("group").sortWithinPartitions("group", "set")
    links = written(dealt.mapInArrow(lambda b: _families(b, threshold, size), "set binary, links long, root binary"), "links")
    label = components(links.where("set <> root").select(F.col("set").alias("x"), F.col("root").alias("y")))
    counted = links.groupBy("set").agg(F.sum("links").alias("links"))
    about = (sets.select("set", "copies", F.col("first.a").alias("a")).join(counted, "set", "left")
             .join(label.withColumnRenamed("node", "set"), "set", "left")
             .select("set", F.coalesce("label", "set").alias("class"), "a", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    # The least id of a set but for null: only where the least is null, the next one counts.
    least = marks.where(F.col("a") > -(1 << 63)).groupBy("set").agg(F.min("a").alias("least"))
    classes = about.join(least, "set", "left")
    names = classes.groupBy("class").agg(F.min("least").alias("class_id"))
    about = classes.select("set", "class", "n_links").join(names, "class")
    return marks.select("a", "b", "set").join(about, "set").select(
        F.when(F.col("a") > -(1 << 63), F.col("a")).alias("id"), "a", "b", "class", "class_id", "n_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS,
             threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The rows, with all their columns, of which each class of near duplicates keeps one: the smallest id
    (null last; of equal ids one text, of equal rows one).

    Null and empty texts, and texts without words, are near equal texts only. Texts of any length are read whole.
    Other columns may have any names; of rows equal in id and text, those of any one stay. An empty table stays
    one.
    """
    found = _classes(docs, id_col, text_col, size, threshold, recall)
    chosen = found.groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "a", "b")).alias("one"))
    a, b = free_name(docs, "_keep_a"), free_name(docs, "_keep_b")
    chosen = chosen.select(F.col("one.a").alias(a), F.col("one.b").alias(b))
    ident, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.withColumn(a, F.coalesce(ident, F.lit(-(1 << 63)))).withColumn(b, F.xxhash64(text))
    return rows.join(chosen, [a, b], "left_semi").dropDuplicates([a, b]).drop(a, b)
