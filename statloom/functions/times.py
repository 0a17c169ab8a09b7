"""Release times. All inputs are ``timestamp_ntz`` in UTC, so no result depends on the session clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statloom.fixed_values import DEFAULT_ZONE, USUAL_RELEASE_TIME


def epoch_minutes(ts: Column) -> Column:
    days = F.date_diff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 1440 + F.hour(ts) * 60 + F.minute(ts)


def local_time(ts: Column, zone: str = DEFAULT_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def local_date(ts: Column, zone: str = DEFAULT_ZONE) -> Column:
    return local_time(ts, zone).cast("date")


def local_midnight(date: Column, zone: str = DEFAULT_ZONE) -> Column:
    """The UTC time at which a local day begins; constant for a constant date, so it reaches the scan."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), date.cast("timestamp_ntz"))


def iso_local(ts: Column, zone: str = DEFAULT_ZONE) -> Column:
    """ISO text with offset, with the fraction only when there is one."""
    local = local_time(ts, zone)
    offset = epoch_minutes(local) - epoch_minutes(ts)
    size = F.abs(offset)
    fraction = F.date_format(local, ".SSSSSS")
    return F.concat(
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction == ".000000", "").otherwise(fraction),
        F.when(offset < 0, "-").otherwise("+"),
        F.lpad((size / 60).cast("int").cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((size % 60).cast("string"), 2, "0"),
    )


def shift(ts: Column, days: int = 0, hours: int = 0, minutes: int = 0) -> Column:
    return ts + F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes))


def rollover_days(date: Column, skip_weekend: bool = False) -> Column:
    """Days to move a release that did not happen: 3 on a Friday, else 1.

    ``skip_weekend`` also moves a Saturday to the Monday.
    """
    day = F.dayofweek(date)  # 1 = Sunday, 6 = Friday
    days = F.when(day == 6, 3)
    if skip_weekend:
        days = days.when(day == 7, 2)
    return days.otherwise(1)


def off_schedule(ts: Column, zone: str = DEFAULT_ZONE, usual: str = USUAL_RELEASE_TIME) -> Column:
    """True when the local time of day is not the usual release time."""
    return F.date_format(local_time(ts, zone), "HH:mm:ss.SSSSSS") != f"{usual}.000000"
