"""Fingerprints of improbable features, and how alike two of them are.

Every window of 64 bytes has an entropy; windows whose entropy is far from that of ordinary text are
rare. Among each run of 64 windows the rarest (the leftmost of equals) scores; windows that score often
are features. Their SHA-1 sets five bits each in a filter of 2,048 bits; a filter takes 160 features,
then the next one is chained on. Likeness is the overlap of bits beyond what chance gives.

A short text has few windows of 64 bytes that a change leaves alone, so it is looked at through windows of 16
bytes; texts of a middle length have both kinds, in filters of their own, and so are like texts on either side.
"""

from __future__ import annotations

import base64
import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.shared import PIECE


@dataclass(frozen=True)
class Scale:
    """Bytes of a window, windows among which one scores, how often a feature has to score, and the entropy (bits
    a byte) of an ordinary window; for texts of at least ``least`` and fewer than ``most`` bytes."""

    window: int
    run: int
    score: int
    typical: float
    least: int
    most: float


WIDE = Scale(64, 64, 8, 4.0, 512, float("inf"))
NARROW = Scale(16, 16, 2, 3.3, 0, 2048)
#: Bits of a filter, and features it takes.
BITS, FEATURES = 2048, 160
#: The least entropy that a feature may have.
LEAST = 1.0
#: Share of the overlap beyond chance that counts as nothing.
CUT = 0.3
#: Bytes that are looked at together, and bytes of the texts that are.
_CHUNK, TOGETHER = 1 << 18, 1 << 20


def entropies(data: np.ndarray, window: int = WIDE.window) -> np.ndarray:
    """Entropy of the window that starts at each byte, for all whole windows."""
    if len(data) < window:
        return np.zeros(0)
    cost = np.arange(window + 2) * np.log2(np.maximum(np.arange(window + 2), 1))
    rise = np.diff(cost)  # what one more byte of a kind adds to the sum of c log c
    before, behind = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for lag in range(1, window):
        same = data[lag:] == data[:-lag]
        before[lag:] += same
        behind[:-lag] += same
    first = cost[np.bincount(data[:window], minlength=256)].sum()
    # The byte that enters had `before` equals in the window, the one that leaves `behind`.
    total = np.concatenate([[first], first + np.cumsum(rise[before[window:]] - rise[behind[:-window]])])
    return np.log2(window) - total / window


def _ranked(data: np.ndarray, scale: Scale) -> tuple[np.ndarray, np.ndarray]:
    """Per window its rarity, and how far ahead the rarest of the run lies that begins with it."""
    n = max(0, len(data) - scale.window + 1)
    rarity, ahead = np.zeros(n, np.uint16), np.zeros(n, np.uint8)
    for low in range(0, n, _CHUNK):
        grown = entropies(data[low:low + _CHUNK + scale.run + scale.window - 2], scale.window)
        # Rounded, so that equal windows rank alike wherever the sums began.
        rare = np.round(np.abs(grown - scale.typical) * 256).astype(np.int64)
        rare[grown < LEAST] = 0
        own = min(_CHUNK, n - low)
        rarity[low:low + own] = rare[:own]
        place = np.arange(len(rare), dtype=np.int64)
        key, width = ((4096 - rare) << 20) | place, 1
        while width < scale.run:  # the least of the next windows, by doubling
            key[:-width] = np.minimum(key[:-width], key[width:])
            width *= 2
        ahead[low:low + own] = ((key & ((1 << 20) - 1)) - place)[:own]
    return rarity, ahead


def _scaled(texts: list[bytes], scale: Scale) -> list[list[bytes]]:
    """The features of each text by one scale, in order of place; none for texts of other lengths."""
    found: list[list[bytes]] = [[] for _ in texts]
    fitting = [k for k, t in enumerate(texts) if scale.least <= len(t) < scale.most]
    buffer, start = b"".join(texts[k] for k in fitting), 0
    rarity, ahead = _ranked(np.frombuffer(buffer, np.uint8), scale)
    for k in fitting:
        low, high = start, start + len(texts[k]) - scale.window + 1
        start += len(texts[k])
        if high <= low:
            found[k] = [texts[k]] if texts[k] else []
            continue
        if high - low <= scale.run:
            found[k] = [buffer[p:p + scale.window] for p in [low + int(rarity[low:high].argmax())]]
            continue
        steps = ahead[low:high - scale.run + 1]
        edge = np.flatnonzero(np.concatenate([[True], steps[1:] + np.uint8(1) != steps[:-1]]))
        score = np.diff(np.append(edge, len(steps)))
        chosen = (low + edge + steps[edge])[score >= min(scale.score, int(score.max()))]
        found[k] = [buffer[p:p + scale.window] for p in chosen.tolist()]
    return found


def features(texts: list[bytes]) -> list[tuple[list[bytes], list[bytes]]]:
    """The features of each text by the wide and by the narrow scale."""
    return list(zip(_scaled(texts, WIDE), _scaled(texts, NARROW)))


def chain(found: tuple[list[bytes], list[bytes]]) -> np.ndarray:
    """The chained filters of a text's features, each filter of one scale."""
    return np.concatenate([filters(some) for some in found])


def filters(found: list[bytes]) -> np.ndarray:
    """The chained filters of a list of features, one row of bits each."""
    if not found:
        return np.zeros((0, BITS), np.uint8)
    digests = b"".join(hashlib.sha1(f).digest() for f in found)
    at = np.frombuffer(digests, ">u4").reshape(-1, 5) % BITS
    chain = np.zeros((-(-len(found) // FEATURES), BITS), np.uint8)
    chain[np.repeat(np.arange(len(found)) // FEATURES, 5), at.ravel()] = 1
    return chain


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: each filter of the shorter chain against the best of the other, on average."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if a.shape == b.shape and (a == b).all():
        return 1.0
    x, y = a.astype(np.float32), b.astype(np.float32)
    nx, ny = x.sum(axis=1)[:, None], y.sum(axis=1)[None, :]
    most, chance = np.minimum(nx, ny), nx * ny / BITS
    floor = chance + CUT * (most - chance)
    score = np.clip((x @ y.T - floor) / np.maximum(most - floor, 1e-6), 0, 1)
    ways = [score.max(axis=1).mean()] * (len(a) <= len(b)) + [score.max(axis=0).mean()] * (len(b) <= len(a))
    return float(np.mean(ways))


def encoded(chain: np.ndarray) -> str:
    return base64.b64encode(np.packbits(chain, axis=1).tobytes()).decode()


def decoded(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, BITS // 8)
    return np.unpackbits(raw, axis=1)


def half_replaced(text: str, following: str) -> str:
    """The text whose last half is replaced by as much of the start of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def ranges(rows: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` (key, text, ..) with their range ``to``, which rises with ``key``, and ``mark``, and a row (key, mark,
    before) per range: its first row is also wanted at the end of the range before.

    Ranges hold about as many rows each. A key with more rows than a range is cut by a hash of the text, its
    ``mark``, which orders rows of one key. What comes to the driver are some numbers per range.
    """
    from pyspark.ml.feature import Bucketizer

    spark = rows.sparkSession
    rows = rows.withColumn("_place", F.col("key").cast("double"))
    cuts = set(rows.approxQuantile("_place", [k / parts for k in range(1, parts)], 0.5 / parts))
    total = rows.count()
    often = rows.groupBy("key").count().where(F.col("count") > max(1, 2 * total // parts)).collect()  # at most half of ``parts``
    heavy = {float(r["key"]): (r["key"], -(-r["count"] * parts // total)) for r in often}
    cuts |= set(heavy) | {float(np.nextafter(place, np.inf)) for place in heavy}
    splits = [-float("inf"), *(sorted(cuts) or [0.0]), float("inf")]
    made = Bucketizer(splits=splits, inputCol="_place", outputCol="_bucket").transform(rows)
    made = made.withColumn("bucket", F.col("_bucket").cast("long")).drop("_bucket", "_place")
    if heavy:
        table = spark.createDataFrame([(splits.index(place), *most) for place, most in heavy.items()], "bucket long, often long, cuts long")
        mark = F.when(F.col("key") == F.col("often"), F.shiftrightunsigned(F.xxhash64("text"), 1)).otherwise(0)
        part = F.when(F.col("key") < F.col("often"), -1).when(F.col("key") > F.col("often"), F.col("cuts")).otherwise(
            F.floor(F.col("mark") / F.lit(float(1 << 63)) * F.col("cuts")))
        made = made.join(F.broadcast(table), "bucket", "left").withColumn("mark", mark).withColumn(
            "part", F.coalesce(part, F.lit(0)).cast("long")).drop("often", "cuts")
    else:
        made = made.withColumn("mark", F.lit(0).cast("long")).withColumn("part", F.lit(0).cast("long"))
    heads = made.groupBy("bucket", "part").agg(F.min(F.struct("key", "mark")).alias("head")).orderBy("bucket", "part").collect()  # a row per range
    places = spark.createDataFrame([(r["bucket"], r["part"], k) for k, r in enumerate(heads)], "bucket long, part long, to int")
    # The first range's goes behind the last.
    before = [(*r["head"], (k or len(heads)) - 1) for k, r in enumerate(heads)]
    made = made.join(F.broadcast(places), ["bucket", "part"]).drop("bucket", "part")
    return made, spark.createDataFrame(before, "key long, mark long, before int")


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its half-replaced form, and how alike they and the next text are.

    Per row: ``id_col``, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next. Next is the
    row after it in ascending id (null first; rows of one id by text, or by a hash of it where they are many),
    for the last row the first one. Null texts count as empty; an empty text has no features, is like another
    empty one (1) and unlike any other (0). Texts of any length are read whole, a very long one in pieces; one
    of fewer than 16 bytes is one feature. Repeated rows each get theirs. Other columns are left out, whatever
    their names. An empty table gives no rows. Texts go through one shuffle by ranges of ids; the first row of
    a range is also sent to the range before it.
    """
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"), key.alias("key"))
    rows, firsts = ranges(rows, parts)
    sent = F.array(F.struct(F.col("to").alias("to"), F.lit(False).alias("tail")),
                   F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("to"), F.lit(True).alias("tail"))))
    dealt = (rows.join(F.broadcast(firsts), ["key", "mark"], "left")
             .select("id", "key", "mark", "text", F.explode(F.array_compact(sent)).alias("sent"))
             .select("sent.to", "sent.tail", "key", "mark", "id", "text")
             .repartitionById(parts, F.col("to")).sortWithinPartitions("to", "tail", "key", "mark", "text"))
    made = dealt.mapInArrow(_fingerprinted, "id long, n_chars long, edited string, fingerprint string, "
                                            "edited_fingerprint string, near_edited double, near_next double")
    return made.withColumnRenamed("id", id_col)


def _compared(pairs: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    # A text is often the next one of the pair before: fingerprint each once.
    texts = list(dict.fromkeys(t for _, a, b in pairs for t in (a, half_replaced(a, b), b)))
    chains = dict(zip(texts, map(chain, features([t.encode() for t in texts]))))
    made = [[], [], [], [], [], [], []]
    for name, text, following in pairs:
        edited = half_replaced(text, following)
        own, other = chains[text], chains[edited]
        for column, value in zip(made, (name, len(text), edited, encoded(own), encoded(other),
                                        likeness(own, other), likeness(own, chains[following]))):
            column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, schema)], schema=schema)


def _fingerprinted(batches):
    """Rows of a sorted partition, each with the row after it in its range; pieces are bounded by their bytes."""
    schema = pa.schema([("id", "int64"), ("n_chars", "int64"), ("edited", "string"), ("fingerprint", "string"),
                        ("edited_fingerprint", "string"), ("near_edited", "float64"), ("near_next", "float64")])
    held, pairs, size = None, [], 0  # the last row seen, which waits for the next one
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: column[k].as_py() for name, column in zip(batch.schema.names, batch.columns)}
            if held is not None and not held["tail"] and held["to"] == row["to"]:
                pairs.append((held["id"], held["text"], row["text"]))
                size += 2 * len(held["text"]) + len(row["text"])
                if size > TOGETHER or len(pairs) >= PIECE:
                    yield _compared(pairs, schema)
                    pairs, size = [], 0
            held = row
    if pairs:
        yield _compared(pairs, schema)
