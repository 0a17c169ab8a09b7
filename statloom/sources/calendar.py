"""ICS calendars. A record of the text source is one event, so large calendars are read in splits."""

from __future__ import annotations

import zoneinfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.fixed_values import CALENDAR_ZONES, DEFAULT_ZONE


def _property(name: str) -> Column:
    return F.regexp_extract("event", rf"(?md)^{name}(?:;[^:\n]*)?:(.*)$", 1)


def _plain(text: Column) -> Column:
    """Undo the escapes of ICS text values. Cut at the escaped backslashes, no part holds one that escapes nothing."""
    def undone(part):
        for escaped, char in ((r"\n", "\n"), (r"\N", "\n"), (r"\,", ","), (r"\;", ";")):
            part = F.replace(part, F.lit(escaped), F.lit(char))
        return part

    return F.trim(F.array_join(F.transform(F.split(text, r"\\\\"), undone), "\\"))


def _region(name: Column) -> Column:
    """A zone's region name; NULL for a name that is neither a region nor known here."""
    known = F.create_map(*(F.lit(x) for pair in CALENDAR_ZONES.items() for x in pair))
    return F.when(name.isin(*sorted(zoneinfo.available_timezones())), name).otherwise(known[name])


def _local(stamp: Column) -> Column:
    """The time a stamp names, in whatever zone; NULL if it names none."""
    pattern = F.when(stamp.rlike(r"^\d{8}$"), "yyyyMMdd").otherwise("yyyyMMdd'T'HHmmss")
    return F.call_function("try_to_timestamp", F.rtrim(stamp, F.lit("Z")), pattern).cast("timestamp_ntz")


def _events(spark: SparkSession, paths: str | list[str], zone: str) -> DataFrame:
    """``event, stamp, local, local_zone, own_zone``: the text of each event and its start, where it can be read."""
    records = spark.read.option("lineSep", "BEGIN:VEVENT").text(paths)
    event = F.regexp_extract("value", "(?s)^(.*?)END:VEVENT", 1)
    unfolded = F.regexp_replace(F.regexp_replace(event, "\r\n", "\n"), "\n[ \t]", "")
    events = records.where(F.contains("value", F.lit("END:VEVENT"))).select(unfolded.alias("event"))
    stamp = F.trim(_property("DTSTART"))
    own_zone = F.nullif(F.regexp_extract("event", r'(?md)^DTSTART[^:\n]*;TZID="?([^:;"\n]+)"?', 1), F.lit(""))
    named = F.when(own_zone.isNull(), F.lit(zone)).otherwise(_region(own_zone))
    local_zone = F.when(F.endswith(stamp, F.lit("Z")), "UTC").otherwise(named)
    return events.select("event", stamp.alias("stamp"), _local(stamp).alias("local"), local_zone.alias("local_zone"),
                         own_zone.alias("own_zone"))


def _error() -> Column:
    return F.when(F.col("local_zone").isNull(), F.concat(F.lit("unknown zone: "), F.col("own_zone"))).when(
        F.col("local").isNull(), F.concat(F.lit("not a time: "), F.col("stamp")))


def read_ics(spark: SparkSession, paths: str | list[str], zone: str = DEFAULT_ZONE) -> DataFrame:
    """``uid, name, begin, error`` per event, ``begin`` as ``timestamp_ntz`` in UTC.

    A time with no zone of its own is taken to be in ``zone``; a date stands for its midnight. Where the
    time or its zone cannot be read, ``begin`` is NULL and ``error`` tells what stands there.
    """
    return _events(spark, paths, zone).select(
        _plain(_property("UID")).alias("uid"),
        _plain(_property("SUMMARY")).alias("name"),
        F.convert_timezone("local_zone", F.lit("UTC"), "local").alias("begin"),
        _error().alias("error"),
    )


def read_ics_series(spark: SparkSession, paths: str | list[str], zone: str = DEFAULT_ZONE) -> DataFrame:
    """``uid, name, local, zone, rule, excluded, replaces, error`` per event, for ``operators.recurrence``.

    ``local`` is the first start in the event's own ``zone``; ``rule`` its recurrence rule, if it has one;
    ``excluded`` the starts that are left out and ``replaces`` the start this event stands for, in that zone.
    """
    def at(stamp):
        utc = F.convert_timezone(F.lit("UTC"), F.col("local_zone"), _local(stamp))
        return F.when(F.endswith(stamp, F.lit("Z")), utc).otherwise(_local(stamp))

    lines = F.regexp_extract_all("event", F.lit(r"(?md)^EXDATE(?:;[^:\n]*)?:(.*)$"), F.lit(1))
    excluded = F.transform(F.flatten(F.transform(lines, lambda x: F.split(x, ","))), lambda x: at(F.trim(x)))
    return _events(spark, paths, zone).select(
        _plain(_property("UID")).alias("uid"), _plain(_property("SUMMARY")).alias("name"), "local",
        F.col("local_zone").alias("zone"), F.nullif(F.upper(F.trim(_property("RRULE"))), F.lit("")).alias("rule"),
        excluded.alias("excluded"), at(F.trim(_property("RECURRENCE-ID"))).alias("replaces"), _error().alias("error"),
    )
