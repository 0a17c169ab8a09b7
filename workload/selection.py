"""Selecting options and cells, catalogues, chunk planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.operators import chunks, selection
from statloom.plans.watch import elapsed as elapsed_releases
from statloom.plans.releases import event_window as in_window
from workload import query, table

_FMT = "%YM%m"
_TITLES = {"Status": "o_orderstatus", "Priority": "o_orderpriority", "Time": "period"}
_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "period"]


def _cells(spark, folder):
    return table(spark, folder, "orders").withColumn("period", F.date_format("o_orderdate", "yyyy'M'MM")).select(_COLUMNS)


_CELLS_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, strftime(o_orderdate, '%YM%m') AS period FROM orders
"""


@query("select_all", _CELLS_SQL)
def select_all(spark, folder):
    return selection.select_cells(_cells(spark, folder), dict.fromkeys(_TITLES, "ALL"), _TITLES)


@query("select_list", _CELLS_SQL + "WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority IN ('1-URGENT', '2-HIGH')")
def select_list(spark, folder):
    wanted = {"Status": ["F", "P"], "Priority": ["1-URGENT", "2-HIGH"], "Time": "ALL"}
    return selection.select_cells(_cells(spark, folder), wanted, _TITLES)


@query("select_latest", _CELLS_SQL + """
    QUALIFY date_trunc('month', o_orderdate) = max(date_trunc('month', o_orderdate)) OVER (PARTITION BY o_custkey)
""")
def select_latest(spark, folder):
    wanted = {"Status": "ALL", "Priority": "ALL", "Time": f"USE_LATEST_DATETIME<{_FMT}>"}
    return selection.select_cells(_cells(spark, folder), wanted, _TITLES, ["o_custkey"])


# The latest month is that of all of a customer's orders, not of the listed ones.
@query("select_latest_listed", """
    WITH dated AS (
        SELECT *, date_trunc('month', o_orderdate) AS m, max(date_trunc('month', o_orderdate)) OVER (PARTITION BY o_custkey) AS newest
        FROM orders)
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, strftime(o_orderdate, '%YM%m') AS period
    FROM dated WHERE m = newest AND o_orderstatus IN ('F', 'P')
""")
def select_latest_listed(spark, folder):
    wanted = {"Status": ["F", "P"], "Priority": "ALL", "Time": f"USE_LATEST_DATETIME<{_FMT}>"}
    return selection.select_cells(_cells(spark, folder), wanted, _TITLES, ["o_custkey"])


@query("select_until", _CELLS_SQL + "WHERE o_orderstatus = 'O' AND o_orderdate >= DATE '1998-03-01'")
def select_until(spark, folder):
    wanted = {"Status": ["O"], "Priority": "ALL", "Time": f"<1998M03>UNTIL_LATEST_DATETIME<{_FMT}>"}
    return selection.select_cells(_cells(spark, folder), wanted, _TITLES)


# A specification per customer: the segment decides which periods are taken.
@query("select_options", """
    WITH options AS (
        SELECT DISTINCT o_custkey AS dataset, 'Priority' AS title, o_orderpriority AS option, NULL::DATE AS d FROM orders
        UNION SELECT o_custkey, 'Time', strftime(o_orderdate, '%YM%m'), CAST(date_trunc('month', o_orderdate) AS DATE)
        FROM orders
    ), ranked AS (
        SELECT *, max(d) OVER (PARTITION BY dataset, title) AS newest FROM options
    )
    SELECT dataset, title, option FROM ranked JOIN customer ON c_custkey = dataset
    WHERE (title = 'Priority' AND option IN ('1-URGENT', '2-HIGH'))
       OR (title = 'Time' AND CASE c_mktsegment WHEN 'BUILDING' THEN TRUE WHEN 'MACHINERY' THEN d = newest
                              ELSE d >= DATE '1998-01-01' END)
""")
def select_options(spark, folder):
    options = selection.label_options(
        _cells(spark, folder).withColumnRenamed("o_custkey", "dataset"), ["dataset"],
        {"Priority": "o_orderpriority", "Time": "period"},
    )
    time_text = (
        F.when(F.col("c_mktsegment") == "BUILDING", "ALL")
        .when(F.col("c_mktsegment") == "MACHINERY", f"USE_LATEST_DATETIME<{_FMT}>")
        .otherwise(f"<1998M01>UNTIL_LATEST_DATETIME<{_FMT}>")
    )
    parsed = selection.parse_selection(time_text)
    no_text = F.lit(None).cast("string")
    listed = F.struct(
        F.lit("Priority").alias("title"), F.lit("LIST").alias("kind"),
        F.array(F.lit("1-URGENT"), F.lit("2-HIGH")).alias("items"), no_text.alias("fmt"), no_text.alias("start"),
    )
    timed = F.struct(
        F.lit("Time").alias("title"), parsed["kind"].alias("kind"), F.lit(None).cast("array<string>").alias("items"),
        parsed["fmt"].alias("fmt"), parsed["start"].alias("start"),
    )
    spec = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("dataset"), F.inline(F.array(listed, timed))
    )
    return selection.select_options(options, spec, [_FMT])


def _line_titles(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("dataset"), "l_returnflag", "l_linestatus",
        F.date_format("l_shipdate", "yyyy'M'MM").alias("period"),
    )
    return selection.label_options(
        lines, ["dataset"], {"Flag": "l_returnflag", "Status": "l_linestatus", "Time": "period"}
    )


_OPTIONS_SQL = """
    SELECT l_suppkey AS dataset, 'Flag' AS title, l_returnflag AS option FROM lineitem
    UNION SELECT l_suppkey, 'Status', l_linestatus FROM lineitem
    UNION SELECT l_suppkey, 'Time', strftime(l_shipdate, '%YM%m') FROM lineitem
"""


@query("label_options", _OPTIONS_SQL)
def label_options(spark, folder):
    return _line_titles(spark, folder)


_BUDGET_SQL = f"""
    WITH options AS ({_OPTIONS_SQL}), counts AS (SELECT dataset, title, count(*) AS n FROM options GROUP BY ALL)
    SELECT dataset, product(n) AS cells, CAST(ceil(product(n) / 100) AS BIGINT) AS chunks
    FROM counts GROUP BY dataset
"""


@query("cell_budget", _BUDGET_SQL)
def cell_budget(spark, folder):
    return chunks.cell_budget(_line_titles(spark, folder), 100)


@query("chunk_assign", f"""
    WITH budget AS ({_BUDGET_SQL}), months AS (
        SELECT DISTINCT l_suppkey AS dataset, CAST(date_trunc('month', l_shipdate) AS DATE) AS month FROM lineitem
    ), placed AS (
        SELECT dataset, month, row_number() OVER (PARTITION BY dataset ORDER BY month) - 1 AS place,
               count(*) OVER (PARTITION BY dataset) AS total
        FROM months
    )
    SELECT dataset, strftime(month, '%YM%m') AS option,
           CAST(place // CAST(ceil(total / chunks) AS BIGINT) AS BIGINT) AS chunk
    FROM placed JOIN budget USING (dataset)
""")
def chunk_assign(spark, folder):
    options = _line_titles(spark, folder)
    budget = chunks.cell_budget(options, 100)
    months = options.where(F.col("title") == "Time").select(
        "dataset", "option", F.to_date("option", "yyyy'M'MM").alias("month")
    )
    return chunks.assign_chunks(months, budget, "month", F.year("month")).select("dataset", "option", "chunk")


@query("first_difference", """
    SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders
    WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW' GROUP BY o_custkey
""")
def first_difference(spark, folder):
    line = F.concat_ws(",", "o_orderstatus", "o_orderpriority")
    left = table(spark, folder, "orders").select("o_custkey", "o_orderkey", line.alias("line"))
    right = left.withColumn("line", F.replace("line", F.lit("P,5-LOW"), F.lit("F,5-LOW")))
    return chunks.first_difference(left, right, ["o_custkey"], "o_orderkey", "line")


def _catalogue(spark, folder):
    regions = table(spark, folder, "region").selectExpr(
        "r_regionkey category_id", "r_name category", "r_regionkey category_pos"
    )
    nations = table(spark, folder, "nation").selectExpr(
        "n_nationkey group_id", "n_regionkey category_id", "n_name `group`", "n_nationkey group_pos"
    )
    customers = table(spark, folder, "customer").selectExpr(
        "c_nationkey group_id", "c_name dataset", "c_custkey dataset_pos"
    )
    return selection.catalogue(regions, nations, customers)


_CATALOGUE_SQL = """
    SELECT r_name AS category, n_name AS "group", c_name AS dataset, r_regionkey AS category_pos,
           n_nationkey AS group_pos, c_custkey AS dataset_pos
    FROM region LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey
"""


@query("catalogue", _CATALOGUE_SQL)
def catalogue(spark, folder):
    return _catalogue(spark, folder)


@query("catalogue_lookup", f"""
    WITH entries AS ({_CATALOGUE_SQL}),
    c AS (SELECT category FROM entries WHERE contains(category, 'AS') ORDER BY category_pos LIMIT 1),
    g AS (SELECT category, "group" FROM entries JOIN c USING (category)
          WHERE contains("group", 'NATION_1') ORDER BY group_pos LIMIT 1)
    SELECT category, "group", dataset FROM entries JOIN g USING (category, "group")
    WHERE contains(dataset, '1') ORDER BY dataset_pos LIMIT 1
""")
def catalogue_lookup(spark, folder):
    return selection.find_in_catalogue(_catalogue(spark, folder), "AS", "NATION_1", "1")


# A reference per customer, with texts of one letter and more, some of which stand nowhere.
_REFERENCES_SQL = """
    SELECT c_custkey, substr('AFRICAMERIASEUROPE', 1 + c_custkey % 17, 1 + c_custkey % 3) AS category,
           CASE c_custkey % 4 WHEN 0 THEN 'NATION_1' WHEN 1 THEN '_' || c_nationkey WHEN 2 THEN '' ELSE 'N_' || c_custkey % 9 END AS "group",
           CASE c_custkey % 5 WHEN 0 THEN CAST(c_custkey % 100 AS VARCHAR) WHEN 1 THEN c_name ELSE substr(c_name, 10 + c_custkey % 6) END AS dataset
    FROM customer
"""


@query("catalogue_lookup_many", f"""
    WITH entries AS ({_CATALOGUE_SQL}), refs AS ({_REFERENCES_SQL}),
    c AS (SELECT r.category, min(category_pos) AS cp FROM (SELECT DISTINCT category FROM refs) r
          JOIN (SELECT DISTINCT category, category_pos FROM entries) e ON contains(e.category, r.category) GROUP BY r.category),
    g AS (SELECT r."group", cp, min(group_pos) AS gp FROM (SELECT DISTINCT "group", cp FROM refs JOIN c USING (category)) r
          JOIN (SELECT DISTINCT category_pos, "group", group_pos FROM entries) e ON category_pos = cp AND contains(e."group", r."group")
          GROUP BY ALL),
    d AS (SELECT r.dataset, cp, gp, min(dataset_pos) AS dp FROM (SELECT DISTINCT dataset, cp, gp FROM refs JOIN c USING (category) JOIN g USING ("group", cp)) r
          JOIN entries e ON category_pos = cp AND group_pos = gp AND contains(e.dataset, r.dataset) GROUP BY ALL)
    SELECT c_custkey, refs.category, refs."group", refs.dataset, e.category AS found_category, e."group" AS found_group, e.dataset AS found_dataset
    FROM refs JOIN c USING (category) JOIN g USING ("group", cp) JOIN d USING (dataset, cp, gp)
    JOIN entries e ON category_pos = cp AND group_pos = gp AND dataset_pos = dp
""")
def catalogue_lookup_many(spark, folder):
    key = F.col("c_custkey")
    references = table(spark, folder, "customer").select(
        key, F.substring(F.lit("AFRICAMERIASEUROPE"), (1 + key % 17).cast("int"), (1 + key % 3).cast("int")).alias("category"),
        F.when(key % 4 == 0, "NATION_1").when(key % 4 == 1, F.concat(F.lit("_"), "c_nationkey")).when(key % 4 == 2, "")
        .otherwise(F.concat(F.lit("N_"), key % 9)).alias("group"),
        F.when(key % 5 == 0, (key % 100).cast("string")).when(key % 5 == 1, F.col("c_name"))
        .otherwise(F.substring("c_name", (10 + key % 6).cast("int"), F.lit(1000))).alias("dataset"))
    return selection.find_all_in_catalogue(_catalogue(spark, folder), references)


@query("skip_list", f"""
    WITH entries AS ({_CATALOGUE_SQL})
    SELECT category, "group", dataset FROM entries WHERE "group" IS NULL OR "group" NOT IN ('NATION_3', 'NATION_7')
""")
def skip_list(spark, folder):
    kept = selection.skip_names(_catalogue(spark, folder), "group", ["NATION_3", "NATION_7"])
    return kept.select("category", "group", "dataset")


@query("catalogue_counts", f"""
    WITH entries AS ({_CATALOGUE_SQL})
    SELECT category, "group", count(dataset) AS datasets FROM entries GROUP BY ALL
""")
def catalogue_counts(spark, folder):
    return selection.catalogue_counts(_catalogue(spark, folder))


@query("event_window", """
    SELECT event_id, ts AS start_dt, ts + INTERVAL 1 HOUR AS end_dt FROM events
    WHERE ts > TIMESTAMP '2024-01-09' AT TIME ZONE 'Pacific/Auckland' AT TIME ZONE 'UTC'
      AND ts + INTERVAL 1 HOUR < TIMESTAMP '2024-01-18' AT TIME ZONE 'Pacific/Auckland' AT TIME ZONE 'UTC'
""")
def event_window(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", F.col("ts").alias("start_dt"), (F.col("ts") + F.expr("interval 1 hour")).alias("end_dt")
    )
    return in_window(events, F.lit("2024-01-10").cast("date"), 7)


@query("elapsed", "SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-15 12:00:00'")
def elapsed(spark, folder):
    now = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return elapsed_releases(table(spark, folder, "events").select("event_id", "ts"), now, "ts")
