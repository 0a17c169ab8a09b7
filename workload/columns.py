"""Column functions: periods, values, labels, texts, times."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.fixed_values import DEFAULT_ZONE
from statloom.functions import periods, text, times, values
from statloom.operators.keys import spread
from statloom.operators.reshape import with_period_dates
from statloom.operators.selection import expand_points, parse_selection
from statloom.plans.watch import probe_alerts
from statloom.sources.html import element_text, links, page_xml
from workload import query, table


@query("period_month", """
    SELECT o_orderkey, strftime(o_orderdate, '%YM%m') AS period,
           last_day(o_orderdate) AS period_end, CAST(date_trunc('month', o_orderdate) AS DATE) AS period_start
    FROM orders
""")
def period_month(spark, folder):
    period = F.date_format("o_orderdate", "yyyy'M'MM")
    return table(spark, folder, "orders").select("o_orderkey", period.alias("period")).select(
        "o_orderkey", "period", periods.month_end(F.col("period")).alias("period_end"),
        periods.month_start(F.col("period")).alias("period_start"),
    )


@query("period_quarter", """
    SELECT o_orderkey, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS period,
           last_day(make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1)) AS period_end,
           CAST(date_trunc('quarter', o_orderdate) AS DATE) AS period_start
    FROM orders
""")
def period_quarter(spark, folder):
    period = F.concat(F.year("o_orderdate"), F.lit("Q"), F.quarter("o_orderdate"))
    return table(spark, folder, "orders").select("o_orderkey", period.alias("period")).select(
        "o_orderkey", "period", periods.quarter_end(F.col("period")).alias("period_end"),
        periods.quarter_start(F.col("period")).alias("period_start"),
    )


@query("period_year", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS period,
           make_date(year(o_orderdate), 12, 31) AS period_end, make_date(year(o_orderdate), 1, 1) AS period_start
    FROM orders
""")
def period_year(spark, folder):
    period = F.year("o_orderdate").cast("string")
    return table(spark, folder, "orders").select("o_orderkey", period.alias("period")).select(
        "o_orderkey", "period", periods.year_end(F.col("period")).alias("period_end"),
        periods.year_start(F.col("period")).alias("period_start"),
    )


# Status F has months, O has quarters, P has years; urgent orders of any status have months.
@query("period_detect", """
    WITH rows AS (
        SELECT o_orderkey, o_orderstatus AS dataset, o_orderdate AS d,
               CASE WHEN o_orderpriority = '1-URGENT' OR o_orderstatus = 'F' THEN 'M'
                    WHEN o_orderstatus = 'O' THEN 'Q' ELSE 'Y' END AS kind
        FROM orders
    ), firsts AS (SELECT dataset, arg_min(kind, o_orderkey) AS period_kind FROM rows GROUP BY dataset)
    SELECT o_orderkey, dataset,
           CASE kind WHEN 'M' THEN strftime(d, '%YM%m') WHEN 'Q' THEN year(d) || 'Q' || quarter(d)
                     ELSE CAST(year(d) AS VARCHAR) END AS period,
           period_kind,
           CASE WHEN kind <> period_kind THEN NULL WHEN kind = 'M' THEN last_day(d)
                WHEN kind = 'Q' THEN last_day(make_date(year(d), quarter(d) * 3, 1))
                ELSE make_date(year(d), 12, 31) END AS period_date
    FROM rows JOIN firsts USING (dataset)
""")
def period_detect(spark, folder):
    d = F.col("o_orderdate")
    text_of = (
        F.when((F.col("o_orderpriority") == "1-URGENT") | (F.col("o_orderstatus") == "F"), F.date_format(d, "yyyy'M'MM"))
        .when(F.col("o_orderstatus") == "O", F.concat(F.year(d), F.lit("Q"), F.quarter(d)))
        .otherwise(F.year(d).cast("string"))
    )
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("dataset"), text_of.alias("period")
    )
    return with_period_dates(rows, ["dataset"], position="o_orderkey")


@query("period_reformat", """
    SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%d/%m/%Y') AS month FROM orders
""")
def period_reformat(spark, folder):
    period = F.date_format("o_orderdate", "yyyy'M'MM")
    return table(spark, folder, "orders").select("o_orderkey", periods.reformat_month(period).alias("month"))


def _cell_texts(spark, folder):
    """Prices as cells: some missing, some with a status, some with two, some that are no numbers."""
    price = F.format_number("l_extendedprice", 2)
    cell = (
        F.when(F.col("l_discount") == 0, "..")
        .when(F.col("l_tax") == 0.08, F.concat(F.col("l_quantity").cast("int"), F.lit("d P")))
        .when(F.col("l_returnflag") == "R", F.concat(price, F.lit(" R")))
        .when(F.col("l_returnflag") == "A", F.concat(price, F.lit(" C P")))
        .otherwise(price)
    )
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", cell.alias("cell"))


@query("value_parse", """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_discount = 0 OR l_tax = 0.08 THEN NULL ELSE l_extendedprice END AS value
    FROM lineitem
""")
def value_parse(spark, folder):
    return _cell_texts(spark, folder).select(
        "l_orderkey", "l_linenumber", values.cell_value(F.col("cell")).alias("value")
    )


@query("status_parse", """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_discount = 0 THEN 'F' WHEN l_tax = 0.08 THEN 'P' WHEN l_returnflag = 'R' THEN 'R'
                WHEN l_returnflag = 'A' THEN 'C' ELSE 'F' END AS status
    FROM lineitem
""")
def status_parse(spark, folder):
    return _cell_texts(spark, folder).select(
        "l_orderkey", "l_linenumber", values.cell_status(F.col("cell")).alias("status")
    )


@query("status_parse_rest", """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_discount = 0 THEN NULL WHEN l_tax = 0.08 THEN CAST(l_quantity AS INT) || 'd'
                ELSE format('{:,.2f}', l_extendedprice) END AS value_text,
           CASE WHEN l_discount = 0 THEN NULL WHEN l_tax = 0.08 THEN 'P' WHEN l_returnflag = 'R' THEN 'R'
                WHEN l_returnflag = 'A' THEN 'C P' END AS status
    FROM lineitem
""")
def status_parse_rest(spark, folder):
    return _cell_texts(spark, folder).select(
        "l_orderkey", "l_linenumber", values.cell_value_text(F.col("cell")).alias("value_text"),
        values.cell_status_rest(F.col("cell")).alias("status"),
    )


@query("label_key", """
    SELECT p_partkey, p_brand || '__' || p_type || '__' || CASE WHEN p_size > 25 THEN 'NA' ELSE p_name END AS key,
           p_brand AS label1, p_type AS label2, CASE WHEN p_size > 25 THEN 'NA' ELSE p_name END AS label3,
           CAST(NULL AS VARCHAR) AS label4
    FROM part
""")
def label_key(spark, folder):
    key = text.label_key(F.col("p_brand"), F.col("p_type"), F.when(F.col("p_size") <= 25, F.col("p_name")))
    return table(spark, folder, "part").select("p_partkey", key.alias("key")).select(
        "p_partkey", "key", *[text.label_part(F.col("key"), i).alias(f"label{i}") for i in (1, 2, 3, 4)]
    )


@query("dataset_slug", """
    SELECT page_id, split_part(url, '/', 3) || '__' || split_part(url, '/', 4) || '__' ||
           replace(regexp_extract(url, '^https?://[^/]+/[^/]+/(.*)$', 1), '/', ' ') AS slug
    FROM pages
""")
def dataset_slug(spark, folder):
    rest = F.regexp_extract("url", "^https?://[^/]+/[^/]+/(.*)$", 1)
    return table(spark, folder, "pages").select(
        "page_id",
        text.dataset_slug(F.split_part("url", F.lit("/"), F.lit(3)), F.split_part("url", F.lit("/"), F.lit(4)), rest)
        .alias("slug"),
    )


@query("label_suffix_strip", """
    SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN c_name || ' (air)' ELSE c_name END AS label FROM customer
""")
def label_suffix_strip(spark, folder):
    ending = F.when(F.col("c_acctbal") > 5000, " (air)").otherwise(" (sea)")
    return table(spark, folder, "customer").select(
        "c_custkey", text.strip_suffix(F.concat("c_name", ending), " (sea)").alias("label")
    )


_FOOTNOTE_SQL = r"""
    WITH html AS (
        SELECT doc_id, '<td class="footnote"><b>' || source || '</b><br/><br/>' || text || '<i>&amp; more</i></td>' AS html
        FROM documents
    ), plain AS (
        SELECT doc_id, replace(replace(replace(replace(replace(replace(
                   regexp_replace(html, '<[^>]*>', chr(10), 'g'),
                   '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', chr(160)), '&amp;', '&') AS t
        FROM html
    )
    SELECT doc_id, regexp_replace(regexp_replace(t, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '\n+', chr(10), 'g')
                   || chr(10) AS footnote
    FROM plain
"""


@query("footnote_clean", _FOOTNOTE_SQL)
def footnote_clean(spark, folder):
    html = F.concat(
        F.lit('<td class="footnote"><b>'), "source", F.lit("</b><br/><br/>"), "text", F.lit("<i>&amp; more</i></td>")
    )
    return table(spark, folder, "documents").select("doc_id", text.footnote_text(html).alias("footnote"))


@query("id_capture", """
    SELECT page_id, nullif(regexp_extract(url, '^(?:https?://[^/]+/[a-z]+/([0-9]+))', 1), '') AS number FROM pages
""")
def id_capture(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", text.captured_number(F.col("url"), r"https?://[^/]+/[a-z]+/(\d+)").alias("number")
    )


@query("selection_parse", """
    SELECT o_orderkey,
           CASE o_orderstatus WHEN 'F' THEN 'LATEST' WHEN 'O' THEN 'FROM'
                ELSE CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'ALL' END END AS kind,
           CASE WHEN o_orderstatus IN ('F', 'O') THEN '%YM%m' END AS fmt,
           CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%YM%m') END AS start
    FROM orders
""")
def selection_parse(spark, folder):
    period = F.date_format("o_orderdate", "yyyy'M'MM")
    spec = (
        F.when(F.col("o_orderstatus") == "F", "USE_LATEST_DATETIME<%YM%m>")
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("<"), period, F.lit(">UNTIL_LATEST_DATETIME<%YM%m>")))
        .when(F.col("o_orderpriority") == "5-LOW", period)
        .otherwise("ALL")
    )
    return table(spark, folder, "orders").select("o_orderkey", parse_selection(spec).alias("s")).select(
        "o_orderkey", "s.kind", "s.fmt", "s.start"
    )


@query("local_release_time", f"""
    WITH times AS (
        SELECT 'event' AS what, event_id AS id, ts FROM events
        UNION ALL SELECT 'order', o_orderkey, o_orderdate FROM orders
    ), local AS (
        SELECT what, id, ts, ts AT TIME ZONE 'UTC' AT TIME ZONE '{DEFAULT_ZONE}' AS l FROM times
    )
    SELECT what, id,
           strftime(l, '%Y-%m-%dT%H:%M:%S')
           || CASE WHEN microsecond(l) % 1000000 = 0 THEN '' ELSE strftime(l, '.%f') END
           || '+' || lpad(CAST(date_diff('minute', ts, l) // 60 AS VARCHAR), 2, '0')
           || ':' || lpad(CAST(date_diff('minute', ts, l) % 60 AS VARCHAR), 2, '0') AS release_dt
    FROM local
""")
def local_release_time(spark, folder):
    events = table(spark, folder, "events").select(F.lit("event").alias("what"), F.col("event_id").alias("id"), "ts")
    orders = table(spark, folder, "orders").select(
        F.lit("order").alias("what"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts")
    )
    return events.unionByName(orders).select("what", "id", times.iso_local(F.col("ts")).alias("release_dt"))


@query("event_shift", """
    SELECT event_id, ts + INTERVAL 1 DAY + INTERVAL 2 HOUR - INTERVAL 30 MINUTE AS start_dt,
           ts + INTERVAL 1 DAY + INTERVAL 3 HOUR - INTERVAL 30 MINUTE AS end_dt
    FROM events
""")
def event_shift(spark, folder):
    end = F.col("ts") + F.expr("interval 1 hour")
    return table(spark, folder, "events").select(
        "event_id", times.shift(F.col("ts"), 1, 2, -30).alias("start_dt"), times.shift(end, 1, 2, -30).alias("end_dt")
    )


@query("rollover_day", """
    SELECT o_orderkey, CASE WHEN isodow(o_orderdate) = 5 THEN 3 ELSE 1 END AS days,
           CASE isodow(o_orderdate) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS weekdays,
           CAST(o_orderdate AS DATE) + CASE WHEN isodow(o_orderdate) = 5 THEN 3 ELSE 1 END AS next_date
    FROM orders
""")
def rollover_day(spark, folder):
    day = F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").select(
        "o_orderkey", times.rollover_days(day).alias("days"),
        times.rollover_days(day, skip_weekend=True).alias("weekdays"),
        F.date_add(day, times.rollover_days(day)).alias("next_date"),
    )


@query("yesterday_month", """
    SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) - 1, '%b %Y') AS month FROM orders
""")
def yesterday_month(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", periods.yesterday_month(F.col("o_orderdate").cast("date")).alias("month")
    )


@query("alert_rows", """
    SELECT event_id AS probe_id, CASE event_type WHEN 'error' THEN 'exception' ELSE 'unsuccessful' END AS outcome,
           'Alert- ' || CASE event_type WHEN 'error' THEN 'Site check BROKEN'
                                          ELSE 'Site NOT WORKING?' END AS subject,
           CASE event_type WHEN 'error' THEN 'The check of site-' || user_id || ' ended with: ' || props
                ELSE 'The download failed, please look at site-' || user_id END AS message
    FROM events WHERE event_type IN ('error', 'view')
""")
def alert_rows(spark, folder):
    probes = table(spark, folder, "events").select(
        F.col("event_id").alias("probe_id"), F.concat(F.lit("site-"), "user_id").alias("url"),
        (F.col("event_type") != "view").alias("downloaded"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("exception"),
    )
    return probe_alerts(probes)


_LINK = r"""<a\s[^>]*?href="([^"]*)"[^>]*>([^<]*)</a>"""


@query("page_links", f"""
    WITH found AS (
        SELECT page_id, regexp_extract_all(html, '{_LINK}', 1) AS hrefs, regexp_extract_all(html, '{_LINK}', 2) AS texts
        FROM pages
    ), places AS (SELECT page_id, hrefs, texts, unnest(range(len(hrefs))) AS p FROM found)
    SELECT page_id, CAST(p AS INT) AS pos, hrefs[p + 1] AS href, texts[p + 1] AS text FROM places
    WHERE starts_with(hrefs[p + 1], '/')
""")
def page_links(spark, folder):
    return (
        table(spark, folder, "pages")
        .select("page_id", F.posexplode(links(F.col("html"))).alias("pos", "link"))
        .select("page_id", "pos", "link.href", "link.text")
        .where(F.startswith("href", F.lit("/")))
    )


@query("page_elements", r"""
    SELECT page_id,
           replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '&amp;', '&') AS title,
           replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '&amp;', '&') AS heading,
           len(regexp_extract_all(regexp_extract(html, '(?s)<nav>.*?</nav>'), '<li>')) AS links,
           regexp_extract(html, '(?s)<nav>.*?href="([^"]*)"', 1) AS first_link,
           contains(html, '<article') AS has_article, contains(html, '<table') AS has_table
    FROM pages
""")
def page_elements(spark, folder):
    pages = spread(table(spark, folder, "pages").select("page_id", "html"), "page_id")
    pages = pages.select("page_id", page_xml("html").alias("xml"))
    xml = F.col("xml")
    return pages.select(
        "page_id", element_text(xml, "//title").alias("title"), element_text(xml, "//article/h1").alias("heading"),
        F.xpath_long(xml, F.lit("count(//nav//li)")).alias("links"),
        element_text(xml, "//nav/ul/li[1]/a/@href").alias("first_link"),
        F.xpath_boolean(xml, F.lit("boolean(//article)")).alias("has_article"),
        F.xpath_boolean(xml, F.lit("boolean(//table)")).alias("has_table"),
    )


@query("map_explode", r"""
    WITH found AS (
        SELECT page_id, split_part(url, '/', 3) AS point,
               regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"[^>]*>([^<]*)</a>', 1) AS meters
        FROM pages
    ), places AS (SELECT page_id, point, meters, unnest(range(len(meters))) AS p FROM found)
    SELECT page_id, point, CAST(p AS INT) AS meter_no, meters[p + 1] AS meter FROM places
""")
def map_explode(spark, folder):
    pages = table(spark, folder, "pages")
    meters = F.transform(links(F.col("html")), lambda link: link["href"])
    return expand_points(pages, F.create_map(F.split_part("url", F.lit("/"), F.lit(3)), meters), "page_id")
