"""Latest and previous copies, missing arrivals, next events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_and_previous(snapshots: DataFrame, keys: list[str], order: list[Column], keep: int = 2) -> DataFrame:
    """The newest ``keep`` rows of each key, with ``generation`` 1 for the newest.

    Every task cuts its rows to ``keep`` per key before the shuffle, so a key with many rows is cheap.
    """
    ranked = snapshots.withColumn("generation", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("generation") <= keep)


def latest_per_section(documents: DataFrame, keys: list[str], position: Column) -> DataFrame:
    """Last document of each section, aggregated before the shuffle."""
    rest = [c for c in documents.columns if c not in keys]
    last = documents.groupBy(*keys).agg(F.max_by(F.struct(*rest), position).alias("_last"))
    return last.select(*keys, "_last.*")


def required_sections(wanted: DataFrame, latest: DataFrame, key: str) -> DataFrame:
    """A row for every wanted section; ``error`` says when it has no document."""
    joined = wanted.join(latest.withColumn("_there", F.lit(True)), key, "left")
    missing = F.when(F.col("_there").isNull(), F.concat(F.lit("section not found: "), F.col(key)))
    return joined.withColumn("error", missing).drop("_there")


def missing_arrivals(expected: DataFrame, arrived: DataFrame, keys: list[str]) -> DataFrame:
    """Expected rows whose key has not arrived. Arrivals are made distinct first, where they lie."""
    return expected.join(arrived.select(*keys).distinct(), keys, "left_anti")


def next_events(events: DataFrame, keys: list[str], time: str, tie: str, now: Column) -> DataFrame:
    """First event after ``now`` per key, and how many follow it."""
    rest = [c for c in events.columns if c not in keys]
    pending = events.where(F.col(time) > now)
    first = pending.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(time, tie)).alias("_next"),
        (F.count(F.lit(1)) - 1).alias("remaining"),
    )
    return first.select(*keys, "_next.*", "remaining")


def next_release(events: DataFrame, time: str, tie: str, now: Column) -> DataFrame:
    """The one next event of all."""
    return events.where(F.col(time) > now).orderBy(time, tie).limit(1)


def single_occurrence(events: DataFrame, uid: str, day: Column, keep: str, wanted: DataFrame | None = None) -> DataFrame:
    """What to do with a recurring event on each day: cancel its one occurrence, or report several.

    ``wanted`` (``uid, day``) lists what is asked for; an event that has no occurrence then is ``none``.
    """
    found = events.groupBy(uid, day.alias("day")).agg(F.count(F.lit(1)).alias("occurrences"), F.min(keep).alias(keep))
    if wanted is not None:
        found = wanted.select(uid, "day").distinct().join(found, [uid, "day"], "left").fillna(0, ["occurrences"])
    return found.select(
        uid, "day", "occurrences",
        F.when(F.col("occurrences") == 1, "cancel").when(F.col("occurrences") == 0, "none").otherwise("ambiguous").alias("action"),
        F.when(F.col("occurrences") == 1, F.col(keep)).alias(keep),
    )
