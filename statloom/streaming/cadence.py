"""Check cadence and alerts as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.fixed_values import CHECK_EVERY_MINUTES, WATCH_MINUTES
from statloom.plans.watch import ERROR, RELEASED

#: Key of the release and the check that only carry time forward.
CLOCK_KEY = "\x00clock"


def last_check_per_run(checks: DataFrame, lateness: str = "0 minutes",
                       minutes: int = CHECK_EVERY_MINUTES) -> DataFrame:
    """Last check of each key in every run of ``minutes``: ``key, start, check_id, updated, checks``.

    ``checks`` is a stream of ``key, check_id, ts timestamp, updated``. Checks are aggregated before
    the shuffle. A run is emitted when the watermark has passed its end.
    """
    last = F.max_by(F.struct("check_id", "updated"), F.struct("ts", "check_id"))
    return (
        checks.withWatermark("ts", lateness)
        .groupBy("key", F.window("ts", f"{minutes} minutes").alias("run"))
        .agg(last.alias("last"), F.count(F.lit(1)).alias("checks"))
        .select("key", F.col("run.start").alias("start"), "last.check_id", "last.updated", "checks")
    )


def first_alerts(alerts: DataFrame, key: str, time: str, within: str) -> DataFrame:
    """Drop repeats of an alert for the same key that come within the given time."""
    return alerts.withWatermark(time, within).dropDuplicatesWithinWatermark([key])


def first_decisions(checks: DataFrame, releases: DataFrame, late_minutes: int = 0, minutes: int = WATCH_MINUTES) -> DataFrame:
    """``release_id, outcome, at`` of releases whose check came in time, as soon as that is certain.

    For plain logs of checks, where nothing is moved to another day: a stream of checks (``key, check_id, ts,
    updated``) joined with the table of releases (``release_id, key, release_dt``) by key and interval. A check
    that is true or NULL decides; the first one counts. State are the releases that have such a check and
    whose window may still be open: the watermark runs on the ends of windows, ``minutes`` and ``late_minutes``
    behind the last one that a check fell into. Checks of no release move nothing; see ``clock`` for the end.
    """
    end = F.col("release_dt") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    starts = releases.select("release_id", F.col("key").alias("_key"), F.col("release_dt").cast("timestamp").alias("release_dt"))
    deciding = checks.where(F.col("updated").isNull() | F.col("updated")).withColumn("ts", F.col("ts").cast("timestamp"))
    met = deciding.join(starts.withColumn("end", end), (F.col("key") == F.col("_key")) & (F.col("ts") >= F.col("release_dt")) & (F.col("ts") < F.col("end")))
    first = (
        met.withWatermark("end", f"{minutes + late_minutes} minutes").groupBy("release_id", "end")
        .agg(F.min(F.struct("ts", "check_id", "updated", "key")).alias("first"))
    )
    outcome = F.when(F.col("first.updated").isNull(), ERROR).otherwise(RELEASED)
    # Asked of what was aggregated, the filter stays behind the watermark, which needs the clock.
    return first.where(F.col("first.key") != CLOCK_KEY).select(
        "release_id", outcome.alias("outcome"), F.col("first.ts").cast("timestamp_ntz").alias("at"))


def clock(table: DataFrame, at, key: str = "key") -> DataFrame:
    """The table with a row of the clock, for releases and for the last checks alike: ``at`` is its time."""
    row = {key: F.lit(CLOCK_KEY), **{name: F.lit(at) for name in ("release_dt", "ts") if name in table.columns},
           **({"updated": F.lit(True)} if "updated" in table.columns else {})}
    columns = [row.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema]
    return table.unionByName(table.sparkSession.range(1).select(columns))
