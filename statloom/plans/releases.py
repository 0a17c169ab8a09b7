"""Calendars and page checks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.fixed_values import DEFAULT_ZONE
from statloom.functions.checks import template_check
from statloom.functions.events import body_files, body_script, body_url
from statloom.functions.times import iso_local, local_midnight, off_schedule
from statloom.operators.keys import attach, spread
from statloom.sources.selectors import find_all

# Selectors that travel with one page; a page with more of them is read in as many parts.
SELECTORS_AT_ONCE = 10_000


def event_window(events: DataFrame, today: Column, days: int, start: str = "start_dt", end: str = "end_dt",
                 zone: str = DEFAULT_ZONE) -> DataFrame:
    """Events that start after yesterday and end before the day behind the next ``days``.

    ``today`` is a local date, times are in UTC; both comparisons are strict and on the local midnight
    of their day.
    """
    if not isinstance(days, int) or isinstance(days, bool) or days < 1:
        raise ValueError(f"{days} should be positive integer")
    return events.where(
        (F.col(start) > local_midnight(F.date_sub(today, 1), zone))
        & (F.col(end) < local_midnight(F.date_add(today, days + 1), zone))
    )


def next_releases(events: DataFrame, today: Column, days: int, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Releases of the next days in time order, with the fields of their body text.

    ``events``: ``ical_uid, title, start_dt, end_dt, body``, times in UTC.
    """
    return event_window(events, today, days, zone=zone).orderBy("start_dt", "ical_uid").select(
        "ical_uid", "title", iso_local(F.col("start_dt"), zone).alias("release_dt"),
        body_files(F.col("body")).alias("files"), body_url(F.col("body")).alias("url"),
        body_script(F.col("body")).alias("script"),
    )


def due_releases(events: DataFrame, services: DataFrame, today: Column, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Calendar events of the local day ``today`` whose name is a service, with ``off_schedule``.

    ``events``: ``uid, name, begin`` (UTC); ``services``: ``name``.
    """
    tomorrow = local_midnight(F.date_add(today, 1), zone)
    today_events = events.where((F.col("begin") >= local_midnight(today, zone)) & (F.col("begin") < tomorrow))
    due = attach(today_events, services.select("name"), ["name"], ["uid"], "left_semi")
    return due.select("uid", "name", "begin", off_schedule(F.col("begin"), zone).alias("off_schedule"))


def _found(batches):
    """Pages (url, html, asked) to the element each selector finds, page by page."""
    kinds = pa.schema([("url", pa.string()), ("selector_kind", pa.string()), ("selector", pa.string()),
                       ("_found", pa.bool_()), ("_text", pa.string())])
    known = {}
    for batch in batches:
        for url, html, asked in zip(*batch.columns):
            asked = [(s["selector_kind"], s["selector"]) for s in asked.as_py()]
            rows = [(url.as_py(), *s, *f) for s, f in zip(asked, find_all(html.as_py(), asked, known))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), kinds)], schema=kinds)


def find_elements(wanted: DataFrame, pages: DataFrame) -> DataFrame:
    """``url, selector_kind, selector, _found, _text`` of every selector that is asked for a page there is.

    ``wanted``: ``url, selector_kind, selector``. A page is read once for all its selectors (once per
    ``SELECTORS_AT_ONCE`` of them). ``_found`` is NULL for a selector that is not supported.
    """
    wanted = wanted.select("url", "selector_kind", "selector").distinct()
    parts = wanted.groupBy("url").agg(F.ceil(F.count(F.lit(1)) / SELECTORS_AT_ONCE).alias("_parts"))
    asked = wanted.join(parts, "url").withColumn("_part", F.pmod(F.xxhash64("selector_kind", "selector"), F.col("_parts")))
    asked = asked.groupBy("url", "_part").agg(F.collect_list(F.struct("selector_kind", "selector")).alias("_asked"))
    # Pages nobody asks for go before the others are spread over the tasks.
    watched = pages.select("url", "html").join(asked.select("url", "_asked"), "url")
    return spread(watched.select("url", "html", "_asked"), "url").mapInArrow(
        _found, "url string, selector_kind string, selector string, _found boolean, _text string")


def check_pages(rules: DataFrame, pages: DataFrame, raw_regex: bool = False) -> DataFrame:
    """``rule_id, updated, info`` of every rule.

    ``rules``: ``rule_id, url, text_template, date_str, selector_kind, selector``; ``pages``: ``url,
    html``, one row per url. Selectors are data: any number of them changes nothing in the plan, and one
    that is not supported (see ``sources.selectors``) costs its own rules only. A rule whose page is missing
    counts as element not found.
    """
    asked = ["url", "selector_kind", "selector"]
    wanted = rules.select(asked).where(F.col("selector_kind").isin("xpath", "css") & (F.length("selector") > 0))
    # Each element is looked up once, however many rules ask for it; rules never carry a page along.
    seen = rules.join(find_elements(wanted, pages).withColumn("_read", F.lit(True)), asked, "left")
    unsupported = F.when(F.col("_read") & F.col("_found").isNull(), F.concat(
        F.lit("Not a supported "), F.col("selector_kind"), F.lit(" selector: "), F.col("selector")))
    result = template_check(
        F.col("text_template"), F.col("date_str"), F.col("selector_kind"), F.col("selector"),
        F.col("_found"), F.trim("_text"), raw_regex, unsupported,
    )
    return seen.select("rule_id", result.alias("result")).select("rule_id", "result.updated", "result.info")
