"""Near duplicates by an LSH forest: sorted orders of MinHash signatures propose, full shingle sets decide.

1. Every text becomes the set of its word shingles. Texts of equal sets are copies: one row stands for them.
2. A tree of the forest is one order of the signature's values: tree t starts at value ``DEPTH`` * t and goes
   round. All trees are sorted together, by ranges, so a dense part of an order is cut like any other.
   A region is what agrees in the first ``DEPTH`` values of a tree. Inside, the neighbours of a row in the
   order are those of the longest common prefix: the denser the region, the deeper they agree.
3. Neighbours are compared on their full sets. Their links join rows to components.
4. Going up from the neighbours to the whole region, only pairs of different components can still change the
   result. Regions of one component are done, however large. The rows of the others are compared across
   components, in blocks that share a region, again on full sets.

So every pair that shares a region of any tree has either been compared or is connected already.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.ngram_join import Powers, _mixed, components, overlaps
from statloom.llm.shared import PIECE, written

WORDS, PERCENT = 4, 80
#: Values that make a region, and share of the pairs at the threshold that shall meet in one.
DEPTH, RECALL = 5, 0.9999
#: Further values by which the rows of a region are sorted.
DEEPER = 11
#: Rows of a block of undecided rows, and shingles it may hold together.
BLOCK, BLOCK_SHINGLES = 256, 400_000

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 9, 10, 11, 12, 13]] = False
_U = np.uint64
_LEAST = -(1 << 63)


def trees_for(percent: int = PERCENT, recall: float = RECALL) -> int:
    """Trees needed for the recall at the threshold."""
    return math.ceil(math.log(1 - recall) / math.log(1 - (percent / 100) ** DEPTH))


def shingles(text: str, powers: Powers, size: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; a shorter text of any words is one shingle."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], _IS_WORD[data], [False]])))
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


def tree_keys(grams: np.ndarray, trees: int) -> list[bytes]:
    """Per tree 8 bytes for the region and two for each value by which the region is sorted."""
    n = trees * DEPTH
    made = np.random.default_rng(11).integers(0, 1 << 63, (2, n), dtype=np.uint64)
    factor, shift = made[0] << _U(1) | _U(1), made[1]
    least = np.full(n, _U(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(grams), 512):
        least = np.minimum(least, (grams[at:at + 512, None] * factor + shift).min(axis=0))
    least = _mixed(least)
    region = np.arange(1, trees + 1, dtype=np.uint64)
    for k in range(DEPTH):
        region = _mixed(region + least[k::DEPTH])
    deeper = (least >> _U(48)).astype(">u2")
    keys = np.empty((trees, 8 + 2 * DEEPER), np.uint8)
    keys[:, :8] = region.astype(">u8").view(np.uint8).reshape(-1, 8)
    after = (np.arange(trees)[:, None] * DEPTH + DEPTH + np.arange(DEEPER)) % n
    keys[:, 8:] = deeper[after].view(np.uint8).reshape(trees, -1)
    return [row.tobytes() for row in keys]


def _signed(keyed: DataFrame, size: int, trees: int) -> DataFrame:
    def run(batches):
        powers, known = Powers(), {}
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                a, b, texts = (c.to_pylist() for c in batch.slice(at, PIECE).columns)
                sets, counts, keys = [], [], []
                for text in texts:
                    grams = shingles(text, powers, size)
                    digest = hashlib.md5(grams.tobytes()).digest()
                    if digest not in known:
                        if len(known) > 10_000:
                            known.clear()
                        known[digest] = tree_keys(grams, trees) if len(grams) else []
                    sets.append(digest)
                    counts.append(len(grams))
                    keys.append(known[digest])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sets, pa.binary()),
                     pa.array(counts, pa.int64()), pa.array(keys, pa.list_(pa.binary()))],
                    names=["a", "b", "set", "n", "keys"])

    return keyed.select("a", "b", "text").mapInArrow(run, "a long, b long, set binary, n long, keys array<binary>")


def _neighbours(batches):
    """Sorted rows (key, set) to (region, set, follower in the region, whether at an end of the partition).

    A row alone in its region has no partner in that tree and is left out, unless it stands at an end, where
    its region may go on in the next partition.
    """
    held, first = None, True

    def told(regions, sets, before, at_end):
        n = len(sets) - (0 if at_end else 1)
        same = regions[1:] == regions[:-1]
        above = np.concatenate([[before], same])[:n]
        below = np.concatenate([same, [False]])[:n]
        end = np.zeros(n, bool)
        if first:
            end[0] = True
        if at_end:
            end[-1] = True
        chosen = np.flatnonzero(above | below | end)
        return bool(same[n - 1]) if not at_end else False, pa.RecordBatch.from_arrays(
            [pa.array(regions[chosen].view(np.int64)), pa.array([sets[k] for k in chosen], pa.binary()),
             pa.array([sets[k + 1] if below[k] else None for k in chosen], pa.binary()), pa.array(end[chosen])],
            names=["region", "set", "follower", "edge"])

    before = False
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, sets = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        regions = np.frombuffer(b"".join(k[:8] for k in keys), ">u8").astype(np.uint64)
        if held is not None:
            regions, sets = np.concatenate([held[0], regions]), [held[1], *sets]
        if len(sets) > 1:
            before, made = told(regions, sets, before, False)
            first = False
            yield made
        held = (regions[-1:], sets[-1])
    if held is not None:
        yield told(held[0], [held[1]], before, True)[1]


def _confirmed(batches, percent: int):
    """The pairs (x, y, grams of x, grams of y) that reach the threshold on their full sets."""
    for batch in batches:
        x, y = [], []
        for one, two, of_one, of_two in zip(*(batch.column(c) for c in range(4))):
            left, right = np.frombuffer(of_one.as_py(), np.uint64), np.frombuffer(of_two.as_py(), np.uint64)
            shared = len(np.intersect1d(left, right, assume_unique=True))
            if shared and 100 * shared >= percent * (len(left) + len(right) - shared):
                x.append(one.as_py())
                y.append(two.as_py())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), pa.array(y, pa.binary())], names=["x", "y"])


def joined_components(rows: list[tuple], percent: int) -> list[tuple[bytes, bytes]]:
    """Ties between the components of rows (set, component, block, regions, grams) that stand in one block or
    two: rows that share a region and reach the threshold. For two blocks, only pairs across them."""
    parts = {c: k for k, c in enumerate(sorted({r[1] for r in rows}))}
    part = np.array([parts[r[1]] for r in rows])
    block = np.array([r[2] for r in rows])
    size = np.array([len(r[4]) for r in rows], np.int64)
    maybe = (overlaps([r[3] for r in rows]) > 0) & (part[:, None] != part[None, :])
    maybe &= 100 * np.minimum(size[:, None], size[None, :]) >= percent * np.maximum(size[:, None], size[None, :])
    if block.min() != block.max():
        maybe &= block[:, None] != block[None, :]
    kept = np.flatnonzero(maybe.any(axis=1))
    if not len(kept):
        return []
    shared = overlaps([rows[k][4] for k in kept]).astype(np.int64)
    size, part = size[kept], part[kept]
    near = maybe[np.ix_(kept, kept)] & (100 * shared >= percent * (size[:, None] + size[None, :] - shared))
    names = sorted(parts)
    root = list(range(len(names)))
    made = []
    for x, y in {(part[i], part[j]) for i, j in zip(*np.nonzero(near)) if part[i] < part[j]}:
        first = x, y
        while root[x] != x:
            x = root[x]
        while root[y] != y:
            y = root[y]
        if x != y:
            root[x] = y
            made.append((names[first[0]], names[first[1]]))
    return made


def _across(batches, percent: int):
    """Ties between components, from rows sorted by the pair of blocks they stand in."""
    group, held = None, []

    def done():
        ties = joined_components(held, percent)
        return pa.RecordBatch.from_arrays(
            [pa.array([t[0] for t in ties], pa.binary()), pa.array([t[1] for t in ties], pa.binary())], names=["x", "y"])

    for batch in batches:
        for at in range(0, batch.num_rows, PIECE):
            for pair, name, component, block, regions, grams in zip(*(c.to_pylist() for c in batch.slice(at, PIECE).columns)):
                if group is not None and pair != group:
                    yield done()
                    held = []
                group = pair
                held.append((name, component, block, np.array(regions, np.int64), np.frombuffer(grams, np.uint64)))
    if held:
        yield done()


def _grams(texts: DataFrame, size: int) -> DataFrame:
    def run(batches):
        powers = Powers()
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                sets, texts = batch.slice(at, PIECE).columns
                yield pa.RecordBatch.from_arrays(
                    [sets, pa.array([shingles(t, powers, size).tobytes() for t in texts.to_pylist()], pa.binary())],
                    names=["set", "grams"])

    return texts.select("set", "text").mapInArrow(run, "set binary, grams binary")


def _undecided(forest: DataFrame, label: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of regions that hold several components, each in a block, and the pairs of blocks to compare.

    A component of many rows has blocks of its own; the small ones of a family (components that meet in
    regions) share blocks. Blocks are a pair if they meet in a region.
    """
    rows = forest.select("region", "set").join(label, "set", "left").select(
        "region", "set", F.coalesce("label", "set").alias("component"))
    rows = written(rows, "regions")
    mixed = rows.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    rows = written(rows.join(mixed.select("region", "low"), "region"), "mixed")
    ties = rows.where("component <> low").select(F.col("component").alias("x"), F.col("low").alias("y"))
    family = components(ties).select(F.col("node").alias("component"), F.col("label").alias("family"))
    members = rows.groupBy("set", "component").agg(F.collect_list("region").alias("regions"))  # one per tree at most
    members = written(members.join(sets.select("set", "n"), "set"), "undecided")

    def cuts(count: str, weight: str):
        return F.greatest(F.ceil(F.col(count) / BLOCK), F.ceil(F.col(weight) / BLOCK_SHINGLES)).cast("long")

    # What is known of a component is put together first, one row each: a large one then meets it once, in a
    # join that Spark may split.
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("weight")).join(family, "component")
    sizes = sizes.withColumn("own", cuts("rows", "weight")).withColumn("large", F.col("own") > 1)
    small = sizes.where(~F.col("large")).groupBy("family").agg(F.sum("rows").alias("rows"), F.sum("weight").alias("weight"))
    sizes = sizes.drop("rows", "weight").join(small.select("family", cuts("rows", "weight").alias("all")), "family", "left")
    block = F.when(F.col("large"), F.xxhash64("component", F.lit(1), F.pmod(F.xxhash64("set"), F.col("own")))).otherwise(
        F.xxhash64("family", F.lit(2), F.pmod(F.xxhash64("component"), F.col("all"))))
    members = members.join(written(sizes, "sizes"), "component").select(
        "set", "component", "regions", block.alias("block"), F.when(F.col("large"), F.col("component")).alias("only"))
    members = written(members, "members")
    met = members.select(F.explode("regions").alias("region"), "block", "only").distinct()
    other = met.select("region", F.col("block").alias("other"), F.col("only").alias("other_only"))
    pairs = met.join(other, "region").where("block <= other and not coalesce(only = other_only, false)")
    return members, pairs.select("block", "other").distinct()


def _components(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int, recall: float) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    ident = F.col(id_col).cast("long")
    keyed = docs.select(F.coalesce(ident, F.lit(_LEAST)).alias("a"), F.xxhash64(text).alias("b"), text.alias("text"))
    marks = written(_signed(keyed, size, trees_for(percent, recall)), "shingled")
    sets = marks.where("n > 0").groupBy("set").agg(
        F.min(F.struct("a", "b")).alias("first"), F.max("n").alias("n"), F.max("keys").alias("keys"))
    sets = written(sets, "sets")
    forest = sets.select(F.explode("keys").alias("key"), "set")
    forest = forest.repartitionByRange("key", "set").sortWithinPartitions("key", "set")
    forest = written(forest.mapInArrow(_neighbours, "region long, set binary, follower binary, edge boolean"), "forest")

    # Where a region goes on in the next partition, its ends there are neighbours too.
    edges = forest.where("edge").select("region", "set")
    heads = edges.groupBy("region").agg(F.min("set").alias("head"))
    near = forest.where("follower is not null").select(F.col("set").alias("x"), F.col("follower").alias("y"))
    near = near.union(edges.join(heads, "region").where("set <> head").select("head", "set"))
    near = near.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()

    met = forest.select("set").distinct().join(sets.select("set", "first"), "set").select("set", "first.a", "first.b")
    grams = written(_grams(keyed.join(met, ["a", "b"]).dropDuplicates(["set"]), size), "grams")
    one = grams.select(F.col("set").alias("x"), F.col("grams").alias("of_x"))
    two = grams.select(F.col("set").alias("y"), F.col("grams").alias("of_y"))
    pairs = near.join(one, "x").join(two, "y").select("x", "y", "of_x", "of_y")
    links = pairs.mapInArrow(lambda b: _confirmed(b, percent), "x binary, y binary")
    label = components(links).select(F.col("node").alias("set"), "label")

    members, blocks = _undecided(forest, label, sets)
    pair = F.xxhash64("block", "other")
    sides = blocks.select(pair.alias("pair"), F.explode(F.array_distinct(F.array("block", "other"))).alias("block"))
    dealt = sides.join(members, "block").join(grams, "set").select("pair", "set", "component", "block", "regions", "grams")
    dealt = dealt.repartition("pair").sortWithinPartitions("pair", "set")
    joined = components(dealt.mapInArrow(lambda b: _across(b, percent), "x binary, y binary"))
    joined = joined.select(F.col("node").alias("component"), F.col("label").alias("joined"))

    found = sets.select("set").join(label, "set", "left").select("set", F.coalesce("label", "set").alias("component"))
    found = found.join(joined, "component", "left").select("set", F.coalesce("joined", "component").alias("component"))
    least = marks.where(F.col("a") > _LEAST).groupBy("set").agg(F.min("a").alias("least"))
    found = found.join(least, "set", "left")
    names = found.groupBy("component").agg(F.min("least").alias("component_id"))
    found = found.join(names, "component").select("set", "component_id")
    own = F.when(F.col("a") > _LEAST, F.col("a"))
    return marks.select("a", "b", "set", "n").join(found, "set", "left").select(
        own.alias("id"), "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(own).alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS,
                    percent: int = PERCENT, recall: float = RECALL) -> DataFrame:
    """(``id_col``, n_shingles, component_id, kept) per row.

    Words are runs of anything but ASCII white space, A-Z in lower case; ``n_shingles`` is the number of
    distinct runs of ``size`` words (a text of fewer words is one). Rows are linked if 100 times the shingles
    they share is at least ``percent`` times those they hold together; ``component_id`` is the smallest id
    that links lead to, ``kept`` whether it is the row's own. A pair at the threshold shares a region with the
    probability ``recall``, a closer one with more.

    Null and empty texts, and those of white space only, have no shingles and are linked with nothing.
    Repeated rows and equal texts are one component and each gets its row; all rows of the smallest id are
    kept. A null id counts as none: its row gets the component's smallest other id, or null (and is kept
    then). Texts of any length are read whole. Other columns, whatever their names, are left out. An empty
    table gives no rows.
    """
    return _components(docs, id_col, text_col, size, percent, recall).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
