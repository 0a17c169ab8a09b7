"""Occurrences of recurring events within a span of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.session import written

DAYS = ("MO", "TU", "WE", "TH", "FR", "SA", "SU")
_KEYS = ("FREQ", "INTERVAL", "COUNT", "UNTIL", "BYDAY", "BYMONTHDAY", "BYMONTH", "WKST")


def _part(rule: Column, key: str) -> Column:
    return F.nullif(F.regexp_extract(rule, rf"(?:^|;){key}=([^;]*)", 1), F.lit(""))


def _listed(rule: Column, key: str) -> Column:
    return F.split(_part(rule, key), ",")


def _days(rule: Column) -> Column:
    """The days of the week of a rule, each with its number in the month, if it has one."""
    def day(x):
        nth = F.regexp_extract(x, "^([+-]?[0-9]+)", 1)
        return F.struct(F.when(nth != "", nth).cast("int").alias("number"), F.right(x, F.lit(2)).alias("code"))

    return F.transform(_listed(rule, "BYDAY"), day)


def _unsupported(rule: Column) -> Column:
    """Whether a rule says something beyond days: other keys, frequencies within a day, places in a year."""
    freq, keys = _part(rule, "FREQ"), F.transform(F.split(rule, ";"), lambda x: F.split_part(x, F.lit("="), F.lit(1)))
    day = r"[+-]?[0-9]{0,2}(MO|TU|WE|TH|FR|SA|SU)"
    placed = F.coalesce(_part(rule, "BYDAY"), F.lit("")).rlike("[0-9]")
    return ~(
        F.coalesce(freq.isin("DAILY", "WEEKLY", "MONTHLY", "YEARLY"), F.lit(False))
        & (F.size(F.array_except(keys, F.array(*map(F.lit, _KEYS)))) == 0)
        & F.coalesce(_part(rule, "BYDAY").rlike(f"^{day}(,{day})*$"), F.lit(True))
        & F.coalesce(_part(rule, "WKST") == "MO", F.lit(True))
        & ~(placed & freq.isin("DAILY", "WEEKLY"))
        & ~((freq == "YEARLY") & _part(rule, "BYDAY").isNotNull() & _part(rule, "BYMONTH").isNull())
        & F.coalesce(_part(rule, "INTERVAL").rlike("^[1-9][0-9]{0,4}$"), F.lit(True))
        & F.coalesce(_part(rule, "COUNT").rlike("^[1-9][0-9]{0,6}$"), F.lit(True))
    )


def _on(day: Column, first: Column, rule: dict[str, Column]) -> Column:
    """Whether a rule that began on the day ``first`` holds on ``day``."""
    interval, freq = rule["interval"], rule["freq"]
    months = (F.year(day) - F.year(first)) * 12 + F.month(day) - F.month(first)
    steps = (
        F.when(freq == "DAILY", F.date_diff(day, first))
        .when(freq == "WEEKLY", F.date_diff(F.trunc(day, "week"), F.trunc(first, "week")) / 7)
        .when(freq == "MONTHLY", months).otherwise(F.year(day) - F.year(first))
    )
    last, place = F.dayofmonth(F.last_day(day)), F.dayofmonth(day)
    code = F.element_at(F.array(*map(F.lit, DAYS)), F.weekday(day) + 1)

    def named(x):
        number = x["number"]
        here = F.when(number > 0, F.ceil(place / 7) == number).otherwise(F.floor((last - place) / 7) + 1 == -number)
        return (x["code"] == code) & F.coalesce(here, F.lit(True))

    by_day = F.exists(rule["days"], named)
    by_place = F.exists(rule["places"], lambda x: (x.cast("int") == place) | (x.cast("int") == place - last - 1))
    by_month = F.exists(rule["months"], lambda x: x.cast("int") == F.month(day))
    plain = rule["days"].isNull() & rule["places"].isNull()
    own = (
        F.when(freq == "WEEKLY", F.weekday(day) == F.weekday(first))
        .when(freq.isin("MONTHLY", "YEARLY"), place == F.dayofmonth(first)).otherwise(True)
    )
    own_month = (freq != "YEARLY") | (F.month(day) == F.month(first))
    return ((steps % interval == 0) & F.coalesce(by_day, F.lit(True)) & F.coalesce(by_place, F.lit(True))
            & F.coalesce(by_month, own_month) & (~plain | own))


def occurrences(events: DataFrame, since: Column, until: Column) -> DataFrame:
    """``uid, name, begin, error``: what takes place from ``since`` up to ``until`` (UTC, without it).

    ``events`` are those of ``sources.calendar.read_ics_series``. Rules may be daily, weekly, monthly or yearly,
    with an interval, a count or an end, days of the week (also the n-th and the n-th last of a month), days of the
    month and months; they hold in local time, so the hour stays over a change of the clock. Left out are
    excluded starts, and those that another event of the same uid replaces; that one comes in its own place. A
    rule that says more, or a start that cannot be read, gives one row without ``begin`` and with ``error``.

    Each event is expanded by itself: a rule with a count from its first day, any other within the span only. The
    events are read once and kept in the shared folder, since they are looked at in four ways.
    """
    events = written(events, "events")
    rule = F.col("rule")
    known = events.withColumn("error", F.coalesce("error", F.when(
        rule.isNotNull() & _unsupported(rule), F.concat(F.lit("rule not supported: "), rule))))
    parts = {
        "freq": _part(rule, "FREQ"), "interval": F.coalesce(_part(rule, "INTERVAL").cast("int"), F.lit(1)),
        "days": _days(rule), "places": _listed(rule, "BYMONTHDAY"), "months": _listed(rule, "BYMONTH"),
    }
    end = _part(rule, "UNTIL")
    zone, day = F.col("zone"), F.col("local").cast("date")
    dated = end.rlike("^[0-9]{8}$")
    end_at = F.call_function("try_to_timestamp", F.rtrim(end, F.lit("Z")), F.when(dated, "yyyyMMdd").otherwise("yyyyMMdd'T'HHmmss")).cast("timestamp_ntz")
    end_local = F.when(dated, end_at + F.expr("interval 86399 seconds")).when(
        F.endswith(end, F.lit("Z")), F.convert_timezone(F.lit("UTC"), zone, end_at)).otherwise(end_at)
    # A day more on either side: the span is cut by the time of day below.
    low, high = (F.convert_timezone(F.lit("UTC"), zone, t).cast("date") for t in (since, until))
    series = known.where(F.col("error").isNull()).select(
        "*", day.alias("_first"), F.struct(*(value.alias(name) for name, value in parts.items())).alias("_rule"),
        _part(rule, "COUNT").cast("int").alias("_count"), end_local.alias("_end"), low.alias("_low"), high.alias("_high"))
    held = {name: F.col(f"_rule.{name}") for name in parts}
    from_day = F.when(F.col("_count").isNotNull(), F.col("_first")).otherwise(F.greatest("_first", "_low"))
    to_day = F.least(F.col("_high"), F.coalesce(F.col("_end").cast("date"), F.col("_high")))
    days = F.filter(F.sequence(from_day, to_day), lambda d: _on(d, F.col("_first"), held))
    days = F.when(F.col("_count").isNull(), days).otherwise(F.slice(days, F.lit(1), F.greatest(F.col("_count"), F.lit(1))))
    found = F.when(F.col("rule").isNull(), F.array("_first")).when(from_day <= to_day, days).otherwise(F.array().cast("array<date>"))
    clock = F.col("local") - F.col("_first").cast("timestamp_ntz")
    each = series.withColumn("_day", F.explode(found)).withColumn("_at", F.col("_day").cast("timestamp_ntz") + clock)
    each = each.where(F.coalesce(F.col("_at") <= F.col("_end"), F.lit(True)) & ~F.coalesce(F.array_contains("excluded", F.col("_at")), F.lit(False)))
    each = each.select("uid", "name", "replaces", "_at", F.convert_timezone("zone", F.lit("UTC"), "_at").alias("begin"))
    each = each.where((F.col("begin") >= since) & (F.col("begin") < until))
    replaced = events.where(F.col("replaces").isNotNull()).select("uid", F.col("replaces").alias("_at")).distinct()
    kept = each.where(F.col("replaces").isNull()).join(replaced, ["uid", "_at"], "left_anti")
    moved = each.where(F.col("replaces").isNotNull())
    columns = ["uid", "name", "begin", F.lit(None).cast("string").alias("error")]
    failed = known.where(F.col("error").isNotNull()).select("uid", "name", F.lit(None).cast("timestamp_ntz").alias("begin"), "error")
    return kept.select(columns).unionByName(moved.select(columns)).unionByName(failed)
