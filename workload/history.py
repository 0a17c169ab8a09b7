"""Latest and previous copies, arrivals, sections, next events."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.operators import history
from workload import query, table


@query("latest_and_previous", """
    SELECT o_custkey, o_orderkey, o_totalprice,
           CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS INT) AS generation
    FROM orders
    QUALIFY generation <= 2
""")
def latest_and_previous(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    order = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    return history.latest_and_previous(orders, ["o_custkey"], order).drop("o_orderdate")


def _latest(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return history.latest_per_section(orders, ["o_custkey"], F.struct("o_orderdate", "o_orderkey"))


@query("latest_per_section", """
    SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def latest_per_section(spark, folder):
    return _latest(spark, folder)


# A section per order; its documents are the lines, and some orders have none.
@query("required_sections", """
    SELECT o_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_linenumber IS NULL THEN 'section not found: ' || o_orderkey END AS error
    FROM orders LEFT JOIN (
        SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC) = 1
    ) ON l_orderkey = o_orderkey
""")
def required_sections(spark, folder):
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    latest = history.latest_per_section(lines, ["o_orderkey"], F.struct("l_linenumber", "l_partkey"))
    return history.required_sections(table(spark, folder, "orders").select("o_orderkey"), latest, "o_orderkey")


@query("missing_arrivals", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def missing_arrivals(spark, folder):
    expected = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    arrived = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return history.missing_arrivals(expected, arrived, ["o_orderkey"])


def _at(text):
    return F.lit(text).cast("timestamp_ntz")


@query("next_event", """
    SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id, arg_min(event_type, (ts, event_id)) AS event_type,
           min(ts) AS ts, count(*) - 1 AS remaining
    FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00' GROUP BY user_id
""")
def next_event(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "ts")
    return history.next_events(events, ["user_id"], "ts", "event_id", _at("2024-01-15 12:00:00"))


@query("next_release", """
    SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00' ORDER BY ts, event_id LIMIT 1
""")
def next_release(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts")
    return history.next_release(events, "ts", "event_id", _at("2024-01-15 12:00:00"))


@query("single_occurrence", """
    SELECT user_id || '-' || event_type AS uid, CAST(ts AS DATE) AS day, count(*) AS occurrences,
           CASE WHEN count(*) = 1 THEN 'cancel' ELSE 'ambiguous' END AS action,
           CASE WHEN count(*) = 1 THEN min(event_id) END AS event_id
    FROM events GROUP BY ALL
""")
def single_occurrence(spark, folder):
    events = table(spark, folder, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("uid"), "event_id", "ts"
    )
    return history.single_occurrence(events, "uid", F.col("ts").cast("date"), "event_id")
