"""Snapshot files as a stream, into a store that keeps the latest copies of every document.

Documents lie in buckets by a hash of their key, and every bucket has two slots, one of which is current. A
batch merges its documents into the other slot of their buckets, which replaces what lay there, and then
commits a manifest: one small file that names the current slot of every bucket. So readers see a batch wholly
or not at all, a batch that is repeated changes nothing, an interrupted one leaves only what its repetition
overwrites, and the store never holds more than the current copies and those they replaced.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.operators.history import latest_and_previous

#: Buckets of a store. A batch rewrites those its documents belong to.
BUCKETS = 256
_MANIFEST = "batch long, slots array<int>"


def _manifest(spark: SparkSession, store: str):
    """The newest manifest (batch, slots) and the turn it was written in, of the two that are written in turn."""
    found = []
    for turn in (0, 1):
        try:
            found += [(r.batch, list(r.slots), turn) for r in spark.read.schema(_MANIFEST).parquet(f"{store}/manifest/turn={turn}").collect()]
        except AnalysisException:  # not there yet, or being written
            continue
    return max(found, default=(None, None, 1))


def _current(spark: SparkSession, store: str, slots: list[int], schema) -> DataFrame:
    """The rows of the slots named; which folders are read is known when the query is planned."""
    rows = spark.read.schema(schema).parquet(f"{store}/data")
    for slot in (0, 1):
        here = [b for b, s in enumerate(slots) if s == slot]
        part = rows.where((F.col("_slot") == slot) & F.col("_bucket").isin(here))
        chosen = part if slot == 0 else chosen.unionByName(part)
    return chosen


def take_in(batch: DataFrame, number: int, store: str, keys: list[str], order: list[Column], keep: int = 2,
            buckets: int = BUCKETS) -> None:
    """Merge a batch of snapshots into the store: of every document the newest ``keep`` copies stay.

    ``number`` grows from batch to batch (a store belongs to one stream and its log); a number that is committed
    already is passed over. ``order`` should
    tell all snapshots of a document apart. Snapshots that are equal to one another count each.
    """
    spark = batch.sparkSession
    last, slots, turn = _manifest(spark, store)
    if last is not None and last >= number:
        return
    slots = slots or [-1] * buckets
    newest = latest_and_previous(batch, keys, order, keep).drop("generation").withColumn(
        "_bucket", F.pmod(F.xxhash64(*keys), F.lit(len(slots))).cast("int"))
    newest.write.mode("overwrite").parquet(f"{store}/incoming")
    newest = spark.read.schema(newest.schema).parquet(f"{store}/incoming")
    touched = {r[0] for r in newest.select("_bucket").distinct().collect()}  # numbers of buckets, bounded by them
    known = [s if b in touched else -1 for b, s in enumerate(slots)]
    merged = newest
    if any(s >= 0 for s in known):
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in newest.schema)
        merged = newest.unionByName(_current(spark, store, known, f"{kinds}, _slot int").drop("_slot"))
    following = [int(s == 0) if b in touched else s for b, s in enumerate(slots)]
    slot = F.get(F.array(*map(F.lit, following)), F.col("_bucket"))
    rows = latest_and_previous(merged, ["_bucket", *keys], order, keep).drop("generation").withColumn("_slot", slot)
    (rows.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("_slot", "_bucket").parquet(f"{store}/data"))
    manifest = spark.range(1).select(F.lit(number).cast("long").alias("batch"), F.array(*map(F.lit, following)).alias("slots"))
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{store}/manifest/turn={1 - turn}")


def follow_snapshots(stream: DataFrame, keys: list[str], order: list[Column], store: str, log: str, keep: int = 2,
                     buckets: int = BUCKETS) -> None:
    """Take in all available snapshots, batch by batch."""
    query = (
        stream.writeStream.foreachBatch(lambda batch, number: take_in(batch, number, store, keys, order, keep, buckets))
        .option("checkpointLocation", log).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def stored_rows(spark: SparkSession, store: str) -> DataFrame:
    """The rows of the store as they lie there: of every document its newest copies."""
    last, slots, _ = _manifest(spark, store)
    if last is None:
        raise ValueError(f"no batch in {store}")
    schema = spark.read.parquet(f"{store}/incoming").schema
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return _current(spark, store, slots, f"{kinds}, _slot int").drop("_slot", "_bucket")


def current_copies(spark: SparkSession, store: str, keys: list[str], order: list[Column]) -> DataFrame:
    """``generation`` 1 is the latest copy of a document and 2 the one before it."""
    return latest_and_previous(stored_rows(spark, store), keys, order)
