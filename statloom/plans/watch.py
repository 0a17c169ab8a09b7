"""Release watch over a log of page checks (the batch form of the stream)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.fixed_values import (
    DEFAULT_ZONE,
    RELEASE_ERROR_SUBJECT,
    RELEASED_SUBJECT,
    SUBJECT_PREFIX,
    WATCH_MINUTES,
)
from statloom.functions.text import message
from statloom.functions.times import epoch_minutes, local_date, rollover_days, shift

RELEASED, ERROR, ROLLED = "RELEASED", "ERROR", "ROLLED"


def slot(ts: Column, slot_minutes: int) -> Column:
    """Number of the run of ``slot_minutes`` that a time lies in."""
    return F.floor(epoch_minutes(ts) / slot_minutes).cast("bigint")


def deciding_checks(checks: DataFrame) -> DataFrame:
    """Checks that end a watch: a hit, or a failed check. One that found the old date goes on."""
    return checks.where(F.col("updated").isNull() | F.col("updated"))


def release_watch(releases: DataFrame, checks: DataFrame, minutes: int = WATCH_MINUTES,
                  zone: str = DEFAULT_ZONE, slot_minutes: int = 1) -> DataFrame:
    """``release_id, outcome, at, next_date`` of every release.

    ``releases``: ``release_id, key, release_dt, due_date``; ``checks``: ``key, check_id, ts, updated``
    (nullable). The first deciding check within ``minutes`` gives RELEASED or ERROR, else ROLLED, with
    the date moved. At equal times the lower ``check_id`` comes first.

    Time is cut into slots. The next check of a release lies in its own slot, or is the first of the
    next slot of its key that has any. The one is found in an ordered pass per key and slot, the other
    from one row per key and slot. No release-check pairs are made, no check is copied, and a key
    with many rows is spread over time.
    """
    starts = releases.select(
        "key", slot(F.col("release_dt"), slot_minutes).alias("_slot"), F.col("release_dt").alias("ts"),
        F.lit(None).cast("bigint").alias("check_id"), F.lit(None).cast("boolean").alias("updated"),
        "release_id", "due_date",
    )
    marks = deciding_checks(checks).select(
        "key", slot(F.col("ts"), slot_minutes).alias("_slot"), "ts", "check_id", "updated",
        F.lit(None).cast(releases.schema["release_id"].dataType).alias("release_id"),
        F.lit(None).cast("date").alias("due_date"),
    )
    rows = starts.unionByName(marks)
    mark = F.when(F.col("check_id").isNotNull(), F.struct("ts", "check_id", "updated"))
    # Backwards in time, the last check seen is the next one. At equal times checks go before
    # releases, so that a check at the release time counts.
    later = Window.partitionBy("key", "_slot").orderBy(
        F.desc("ts"), F.desc_nulls_last("check_id")
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later_slots = Window.partitionBy("key").orderBy(F.desc("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    per_slot = rows.groupBy("key", "_slot").agg(
        F.min(mark).alias("_mark"), F.max(F.col("check_id").isNull()).alias("_has_release")
    )
    behind = per_slot.withColumn("_behind", F.last("_mark", ignorenulls=True).over(later_slots))
    behind = behind.where("_has_release").select("key", "_slot", "_behind")
    return (
        rows.withColumn("_inside", F.last(mark, ignorenulls=True).over(later))
        .where(F.col("check_id").isNull())
        .join(behind, ["key", "_slot"])
        .select("release_id", F.col("ts").alias("release_dt"), "due_date",
                F.coalesce("_inside", "_behind").alias("_first"))
        .transform(lambda found: decided(found, minutes, zone))
    )


def decided(rows: DataFrame, minutes: int, zone: str) -> DataFrame:
    """Outcome of ``release_id, release_dt, due_date, _first struct<ts, updated>``."""
    end = shift(F.col("release_dt"), minutes=minutes)
    in_time = F.coalesce(F.col("_first.ts") < end, F.lit(False))
    outcome = F.when(in_time & F.col("_first.updated").isNull(), ERROR).when(in_time, RELEASED).otherwise(ROLLED)
    days = rollover_days(local_date(end, zone))
    return rows.select(
        "release_id", outcome.alias("outcome"), F.when(in_time, F.col("_first.ts")).otherwise(end).alias("at"),
        F.when(~in_time, F.date_add("due_date", days)).alias("next_date"),
    )


def watch_alerts(outcomes: DataFrame, details: DataFrame) -> DataFrame:
    """One alert per released or failed release: ``release_id, subject, message``.

    ``details``: ``release_id, title, date_str, url, info``.
    """
    alerted = outcomes.where(F.col("outcome") != ROLLED).join(details, "release_id")
    released = F.col("outcome") == RELEASED
    fields = {name: F.col(name) for name in ("title", "date_str", "url", "info")}
    return alerted.select(
        "release_id",
        F.concat(F.lit(f"{SUBJECT_PREFIX}- "),
                 F.when(released, RELEASED_SUBJECT).otherwise(RELEASE_ERROR_SUBJECT)).alias("subject"),
        F.when(released, message('New data for "{title}", date "{date_str}". Download: {url}', **fields))
        .otherwise(message('Check of "{title}" failed and is not repeated: {info}', **fields)).alias("message"),
    )


def probe_alerts(probes: DataFrame) -> DataFrame:
    """Alerts of a log of site probes: ``probe_id, outcome, subject, message``, nothing for good probes.

    ``probes``: ``probe_id, url, downloaded boolean, exception string``; an exception goes first.
    """
    failed = F.col("exception").isNotNull()
    outcome = F.when(failed, "exception").when(F.coalesce(F.col("downloaded"), F.lit(False)), "ok").otherwise(
        "unsuccessful"
    )
    fields = {"url": F.col("url"), "exception": F.col("exception")}
    return probes.withColumn("outcome", outcome).where(F.col("outcome") != "ok").select(
        "probe_id", "outcome",
        F.concat(F.lit(f"{SUBJECT_PREFIX}- "),
                 F.when(failed, "Site check BROKEN").otherwise("Site NOT WORKING?")).alias("subject"),
        F.when(failed, message("The check of {url} ended with: {exception}", **fields))
        .otherwise(message("The download failed, please look at {url}", **fields)).alias("message"),
    )


def pending(releases: DataFrame, now: Column) -> DataFrame:
    return releases.where(F.col("release_dt") > now)


def elapsed(releases: DataFrame, now: Column, time: str = "release_dt") -> DataFrame:
    return releases.where(F.col(time) < now)
