"""Reshaping, comparing, merging; grid and long files."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.functions.periods import reformat_month
from statloom.functions.values import is_published
from statloom.operators import compare, reshape, series
from statloom.plans import merge, reconcile
from statloom.session import scratch_path, written
from statloom.sinks import files
from statloom.sources.grids import label_columns, long_from_cells, read_grids
from statloom.sources.long_tables import read_long, read_long_mixed
from workload import query, table
from workload.selection import _catalogue, _CATALOGUE_SQL

STATUSES = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
FLAGS = ["A", "N", "R"]
LINE_STATUSES = ["F", "O"]
LINE_KEYS = [f"{flag}__{status}" for flag in FLAGS for status in LINE_STATUSES]


# --- reconciliation: one dataset per customer, years by status and priority ------------------------
# The API copy is summed from orders; the grid copy leaves out orders that have no lines.

def _order_sums(orders):
    amount = F.sum(F.col("o_totalprice").cast("decimal(18,2)"))
    return orders.groupBy(
        "o_custkey", F.year("o_orderdate").alias("year"), "o_orderstatus", "o_orderpriority"
    ).agg(amount.alias("amount"))


def _api_copy(spark, folder):
    sums = _order_sums(table(spark, folder, "orders"))
    return sums.select(
        F.concat(F.lit("api-"), "o_custkey").alias("dataset"), F.make_date("year", F.lit(12), F.lit(31)).alias("Period"),
        F.col("o_orderstatus").alias("Label1"), F.col("o_orderpriority").alias("Label2"),
        F.lit(None).cast("string").alias("Label3"), F.col("amount").cast("double").alias("Value"),
        F.when(F.col("o_orderstatus") == "P", "P").otherwise("F").alias("Status"),
    )


def _grid_copy(spark, folder):
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    sums = _order_sums(table(spark, folder, "orders").join(lines, "o_orderkey", "left_semi"))
    cell = F.concat(F.format_number("amount", 2), F.when(F.col("o_orderstatus") == "P", " P").otherwise(""))
    cells = sums.select(
        F.concat(F.lit("grid-"), "o_custkey").alias("dataset"), F.col("year").cast("string").alias("period"),
        F.concat_ws("__", "o_orderstatus", "o_orderpriority").alias("key"), cell.alias("cell"),
    )
    keys = [f"{status}__{priority}" for status in STATUSES for priority in PRIORITIES]
    wide = reshape.long_to_wide(cells, ["dataset", "period"], "key", keys, "cell")
    wide = wide.fillna("..", keys)
    long = reshape.wide_to_typed(wide, ["dataset"], "period", "Y", 2)
    long = long.where(is_published(F.col("Value"), F.col("Status")))
    return long.select("dataset", "Period", F.array("Label1", "Label2").alias("labels"), "Value", "Status")


def _manifest(spark, folder):
    return table(spark, folder, "customer").select(
        F.col("c_name").alias("name"), F.concat(F.lit("api-"), "c_custkey").alias("api_fname"),
        F.concat(F.lit("grid-"), "c_custkey").alias("grid_fname"),
    )


_SIDES_SQL = """
    api AS (
        SELECT o_custkey AS c, year(o_orderdate) AS y, o_orderstatus AS s, o_orderpriority AS p,
               sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS v
        FROM orders GROUP BY ALL
    ), grid AS (
        SELECT o_custkey AS c, year(o_orderdate) AS y, o_orderstatus AS s, o_orderpriority AS p,
               sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS v
        FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY ALL
    )
"""
_VERDICT_SQL = f"""
    WITH {_SIDES_SQL}, missing AS (SELECT c, count(*) AS n FROM (SELECT * FROM api EXCEPT SELECT * FROM grid) GROUP BY c),
    a AS (SELECT c, count(*) AS n FROM api GROUP BY c), g AS (SELECT c, count(*) AS n FROM grid GROUP BY c)
    SELECT c_name AS name, 'api-' || c_custkey AS api_fname, 'grid-' || c_custkey AS grid_fname,
           CASE WHEN a.n IS NULL AND g.n IS NULL THEN NULL
                ELSE coalesce(a.n, 0) = coalesce(g.n, 0) AND coalesce(missing.n, 0) = 0 END AS equivalent
    FROM customer LEFT JOIN a ON a.c = c_custkey LEFT JOIN g ON g.c = c_custkey LEFT JOIN missing ON missing.c = c_custkey
"""


@query("reconcile_verdict", _VERDICT_SQL)
def reconcile_verdict(spark, folder):
    # The copies are tables of their own, which a verdict may read twice.
    api, grid = written(_api_copy(spark, folder), "api-copy"), written(_grid_copy(spark, folder), "grid-copy")
    return reconcile.reconcile(_manifest(spark, folder), api, grid)


@query("verdict_json", f"""
    WITH verdicts AS ({_VERDICT_SQL})
    SELECT name, '{{"' || name || '":{{"api_fname":"' || api_fname || '","grid_fname":"' || grid_fname || '"' ||
           CASE WHEN equivalent IS NULL THEN '' ELSE ',"equivalent":' || equivalent END || '}}}}' AS json
    FROM verdicts
""")
def verdict_json(spark, folder):
    verdicts = reconcile_verdict(spark, folder)
    manifest = verdicts.drop("equivalent")
    return files.verdict_documents(verdicts.withColumnRenamed("name", "dataset"), manifest)


@query("reconcile_diff", f"""
    WITH {_SIDES_SQL}, both_sides AS (
        SELECT *, 'left' AS side FROM (SELECT * FROM api EXCEPT SELECT * FROM grid)
        UNION ALL SELECT *, 'right' FROM (SELECT * FROM grid EXCEPT SELECT * FROM api)
    )
    SELECT CAST(c AS VARCHAR) AS dataset, make_date(y, 12, 31) AS "Period", s AS "Label1", p AS "Label2",
           CAST(v AS DOUBLE) AS "Value", CASE WHEN s = 'P' THEN 'P' ELSE 'F' END AS "Status", side,
           CAST(1 AS BIGINT) AS copies
    FROM both_sides
""")
def reconcile_diff(spark, folder):
    def number(rows):
        return rows.withColumn("dataset", F.split_part("dataset", F.lit("-"), F.lit(2)))

    differences = reconcile.reconcile_differences(number(_api_copy(spark, folder)), number(_grid_copy(spark, folder)))
    return label_columns(differences, 2)


@query("set_difference", """
    SELECT o_custkey AS custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderstatus AS status
    FROM orders
    EXCEPT
    SELECT o_custkey, CAST(date_trunc('month', l_shipdate) AS DATE), CASE WHEN l_linestatus = 'O' THEN 'O' END
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""")
def set_difference(spark, folder):
    orders = table(spark, folder, "orders")
    ordered = orders.select(
        F.col("o_custkey").alias("custkey"), F.trunc("o_orderdate", "month").alias("month"),
        F.col("o_orderstatus").alias("status"), "o_totalprice",
    )
    shipped = table(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("custkey"), F.trunc("l_shipdate", "month").alias("month"),
        F.when(F.col("l_linestatus") == "O", "O").alias("status"),
    )
    return compare.set_difference(ordered, shipped)


# No line has a quantity below one, so the column of credits holds nothing.
@query("drop_null_columns", """
    SELECT l_orderkey, l_linenumber, l_shipdate, CASE WHEN l_returnflag = 'R' THEN l_quantity END AS returned FROM lineitem
""")
def drop_null_columns(spark, folder):
    quantity = F.col("l_quantity")
    return compare.drop_null_columns(table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", F.when(F.col("l_returnflag") == "R", quantity).alias("returned"),
        F.when(quantity < 1, quantity).alias("credited")))


@query("used_columns_of_files", """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN l_quantity END AS returned FROM lineitem
""")
def used_columns_of_files(spark, folder):
    path, quantity = scratch_path(spark, "uses"), F.col("l_quantity")
    table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", quantity).alias("returned"),
        F.when(quantity < 1, quantity).alias("credited"), F.when(quantity < 1, F.col("l_shipdate")).alias("credit_day")).write.parquet(path)
    return compare.read_used_columns(spark, path)


@query("label_levels", """
    SELECT l_suppkey, CAST(1 + max(CASE WHEN l_discount = 0 THEN 1 ELSE 0 END)
                           + max(CASE WHEN l_quantity = 50 AND l_tax = 0.08 THEN 1 ELSE 0 END) AS INT) AS levels
    FROM lineitem GROUP BY l_suppkey
""")
def label_levels(spark, folder):
    labelled = table(spark, folder, "lineitem").select(
        "l_suppkey", F.col("l_returnflag").alias("Label1"),
        F.when(F.col("l_discount") == 0, F.col("l_linestatus")).alias("Label2"),
        F.when((F.col("l_quantity") == 50) & (F.col("l_tax") == 0.08), "x").alias("Label3"),
        F.lit(None).cast("string").alias("Label4"),
    )
    return compare.label_levels(labelled, ["l_suppkey"])


@query("suppressed_filter", """
    SELECT l_orderkey, l_linenumber, l_returnflag AS status, CASE WHEN l_discount > 0 THEN l_extendedprice END AS value
    FROM lineitem WHERE l_discount > 0 OR l_returnflag IN ('C', 'S')
""")
def suppressed_filter(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("status"),
        F.when(F.col("l_discount") > 0, F.col("l_extendedprice")).alias("value"),
    )
    return rows.where(is_published(F.col("value"), F.col("status")))


# --- grids: one dataset per supplier, months by flag and status -------------------------------------

def _quantities(spark, folder):
    sums = table(spark, folder, "lineitem").groupBy(
        F.col("l_suppkey").alias("dataset"), F.trunc("l_shipdate", "month").alias("month"), "l_returnflag", "l_linestatus",
    ).agg(F.sum("l_quantity").alias("quantity"))
    return sums.select(
        "dataset", F.date_format("month", "yyyy'M'MM").alias("period"), "l_returnflag", "l_linestatus", "quantity"
    )


def _quantity_cells(spark, folder):
    """Cells with a thousands comma; open lines are provisional."""
    text = F.concat(
        F.format_number(F.col("quantity") * 100, 0), F.when(F.col("l_linestatus") == "O", " P").otherwise("")
    )
    return _quantities(spark, folder).select(
        F.col("dataset").cast("string").alias("dataset"), "period", "l_returnflag", "l_linestatus", text.alias("cell")
    )


_QUANTITY_SQL = """
    quantities AS (
        SELECT l_suppkey AS dataset, date_trunc('month', l_shipdate) AS month, l_returnflag AS flag,
               l_linestatus AS status, sum(l_quantity) * 100 AS quantity
        FROM lineitem GROUP BY ALL
    ), heads AS (SELECT DISTINCT dataset, flag, status FROM quantities),
    months AS (SELECT DISTINCT dataset, month FROM quantities),
    dense AS (SELECT * FROM months JOIN heads USING (dataset) LEFT JOIN quantities USING (dataset, month, flag, status)),
    every AS (
        SELECT * FROM (
            SELECT * FROM months, (SELECT unnest(['A', 'N', 'R']) AS flag), (SELECT unnest(['F', 'O']) AS status)
        ) LEFT JOIN quantities USING (dataset, month, flag, status)
    )
"""
_LONG_SQL = """
    SELECT CAST(dataset AS VARCHAR) AS dataset, last_day(month) AS "Period", flag AS "Label1", status AS "Label2",
           quantity AS "Value", CASE WHEN quantity IS NOT NULL AND status = 'O' THEN 'P' ELSE 'F' END AS "Status"
    FROM {}
"""


def _wide(spark, folder):
    cells = _quantity_cells(spark, folder).withColumn("key", F.concat_ws("__", "l_returnflag", "l_linestatus"))
    return reshape.long_to_wide(cells, ["dataset", "period"], "key", LINE_KEYS, "cell")


@query("grid_to_long", f"WITH {_QUANTITY_SQL} {_LONG_SQL.format('every')}")
def grid_to_long(spark, folder):
    return reshape.wide_to_typed(_wide(spark, folder), ["dataset"], "period", "M", 2, LINE_KEYS)


@query("long_to_grid", f"""
    SELECT l_suppkey AS dataset, strftime(l_shipdate, '%YM%m') AS period,
           {", ".join(f"sum(CASE WHEN l_returnflag = '{k[0]}' AND l_linestatus = '{k[-1]}' THEN l_quantity END) AS {k}"
                      for k in LINE_KEYS)}
    FROM lineitem GROUP BY ALL
""")
def long_to_grid(spark, folder):
    long = _quantities(spark, folder).withColumn("key", F.concat_ws("__", "l_returnflag", "l_linestatus"))
    return reshape.long_to_wide(long, ["dataset", "period"], "key", LINE_KEYS, "quantity")


@query("stack_level", """
    WITH sums AS (
        SELECT l_suppkey AS dataset, strftime(l_shipdate, '%YM%m') AS period, l_linestatus AS port, l_returnflag AS flag,
               sum(l_quantity) AS q
        FROM lineitem GROUP BY ALL
    ), cells AS (SELECT dataset, period, port, flag, CASE WHEN q >= 50 THEN q END AS q FROM sums)
    SELECT dataset, period, port, max(CASE WHEN flag = 'A' THEN q END) AS "A", max(CASE WHEN flag = 'N' THEN q END) AS "N",
           max(CASE WHEN flag = 'R' THEN q END) AS "R"
    FROM cells GROUP BY ALL HAVING max(q) IS NOT NULL
""")
def stack_level(spark, folder):
    long = _quantities(spark, folder).select(
        "dataset", "period", F.col("l_linestatus").alias("port"), "l_returnflag",
        F.when(F.col("quantity") >= 50, F.col("quantity")).alias("cell"),
    )
    return reshape.stack_level(long, ["dataset", "period"], "port", "l_returnflag", FLAGS, "cell")


def _write_grids(spark, folder, cells_per_chunk=300, month="%", labels=None, cell="cell"):
    """Grid files of all suppliers, in chunks, written by Spark from lineitem; of some months, if given."""
    path = scratch_path(spark, "grids")
    labels = F.array("l_returnflag", "l_linestatus") if labels is None else labels
    long = _quantity_cells(spark, folder).select(
        "dataset", "period", labels.alias("labels"), (F.col(cell) if isinstance(cell, str) else cell).alias("cell")
    ).where(F.col("period").like(month))
    year, number = F.substring("period", 1, 4).cast("bigint"), F.substring("period", 6, 2).cast("bigint")
    lines = files.grid_lines(long, year * 12 + number, year, cells_per_chunk, separator_line=True)
    files.write_grids(lines, path)
    return path


@query("grid_read", f"WITH {_QUANTITY_SQL} {_LONG_SQL.format('dense')}")
def grid_read(spark, folder):
    cells = read_grids(spark, _write_grids(spark, folder), merge.chunk_dataset())
    return label_columns(long_from_cells(cells), 2)


# Labels and cells over several lines, with quotes and commas inside.
@query("grid_quoted", f"""
    WITH {_QUANTITY_SQL}
    SELECT CAST(dataset AS VARCHAR) AS dataset, strftime(month, '%YM%m') AS period,
           flag || chr(10) || 'flag, "' || flag || '"' AS label, status,
           CASE WHEN quantity IS NULL THEN '..' ELSE format('{{:,}}', CAST(quantity AS BIGINT)) || CASE WHEN status = 'O' THEN chr(10) || 'P' ELSE '' END
           END AS cell
    FROM dense
""")
def grid_quoted(spark, folder):
    flag = F.concat("l_returnflag", F.lit('\nflag, "'), "l_returnflag", F.lit('"'))
    path = _write_grids(spark, folder, labels=F.array(flag, F.col("l_linestatus")), cell=F.replace("cell", F.lit(" P"), F.lit("\nP")))
    cells = read_grids(spark, path, merge.chunk_dataset())
    return cells.select("dataset", "period", F.get("labels", F.lit(0)).alias("label"), F.get("labels", F.lit(1)).alias("status"), "cell")


@query("merge_chunks", f"""
    WITH {_QUANTITY_SQL}, texts AS (
        SELECT CAST(dataset AS VARCHAR) AS dataset, strftime(month, '%YM%m') AS period, flag, status,
               CASE WHEN quantity IS NULL THEN '..'
                    ELSE format('{{:,}}', CAST(quantity AS BIGINT)) || CASE WHEN status = 'O' THEN ' P' ELSE '' END END AS cell
        FROM dense
    )
    SELECT dataset, period,
           {", ".join(f"max(CASE WHEN flag = '{k[0]}' AND status = '{k[-1]}' THEN cell END) AS {k}" for k in LINE_KEYS)}
    FROM texts GROUP BY ALL
""")
def merge_chunks(spark, folder):
    cells = merge.merge_chunks(spark, _write_grids(spark, folder))
    return merge.merged_table(cells, LINE_KEYS)


# The month of June stands in two chunks of each dataset, and in the merged file twice.
@query("merged_file", f"""
    WITH {_QUANTITY_SQL} {_LONG_SQL.format('dense')}
    UNION ALL {_LONG_SQL.format("(SELECT * FROM dense WHERE strftime(month, '%m') = '06')")}
""")
def merged_file(spark, folder):
    chunks = [_write_grids(spark, folder), _write_grids(spark, folder, month="%M06")]
    whole, june = (merge.merge_chunks(spark, path) for path in chunks)
    path = scratch_path(spark, "merged")
    files.write_grids(files.merged_lines(whole.unionByName(june), 40), path)
    cells = read_grids(spark, path, merge.chunk_dataset())
    return label_columns(long_from_cells(cells), 2)


@query("grid_roundtrip", f"WITH {_QUANTITY_SQL} {_LONG_SQL.format('dense')}")
def grid_roundtrip(spark, folder):
    long = grid_read(spark, folder)
    path = scratch_path(spark, "long")
    name = files.long_copy_name(F.concat("dataset", F.lit(".csv")))
    files.write_by_key(long.withColumn("file", name).drop("dataset"), "file", path)
    back = read_long_mixed(spark, path, F.regexp_extract("_metadata.file_path", r"file=([^/]+)__long\.csv/", 1))
    return back.select("dataset", "Period", "Label1", "Label2", "Value", "Status")


def _api_table(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        F.col("l_shipdate").cast("date").alias("Period"), F.col("l_extendedprice").alias("Value"),
        F.when(F.col("l_discount") > 0, F.col("l_returnflag")).alias("Status"),
        F.concat(F.lit('say "x", '), "l_linestatus").alias("Label1"),
    )


@query("typed_subset_read", """
    SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_shipdate AS DATE) AS "Period", l_extendedprice AS "Value",
           CASE WHEN l_discount > 0 THEN l_returnflag END AS "Status", 'say "x", ' || l_linestatus AS "Label1"
    FROM lineitem
""")
def typed_subset_read(spark, folder):
    path = scratch_path(spark, "api")
    _api_table(spark, folder).write.options(header=True, nullValue="NA", escape='"').csv(path)
    return read_long(spark, path)


@query("typed_mixed_read", """
    SELECT CASE WHEN l_linestatus = 'O' THEN 'open' ELSE 'closed' END AS dataset,
           l_orderkey || '-' || l_linenumber AS id, CAST(l_shipdate AS DATE) AS "Period",
           CASE WHEN l_linestatus = 'O' THEN l_extendedprice END AS "Value",
           CASE WHEN l_linestatus = 'F' AND l_discount > 0 THEN l_returnflag END AS "Status",
           'say "x", ' || l_linestatus AS "Label1"
    FROM lineitem
""")
def typed_mixed_read(spark, folder):
    path = scratch_path(spark, "api")
    rows = _api_table(spark, folder)
    is_open = F.endswith("Label1", F.lit("O"))
    options = {"header": True, "nullValue": "NA", "escape": '"'}
    rows.where(is_open).select("Value", "id", "Period", "Label1").write.options(**options).csv(f"{path}/dataset=open")
    rows.where(~is_open).drop("Value").write.options(**options).csv(f"{path}/dataset=closed")
    back = read_long_mixed(spark, path, merge.chunk_dataset())
    return back.select("dataset", "id", "Period", "Value", "Status", "Label1")


# One dataset per supplier, as files on both sides. In the API copy, lines without a discount are
# left out of the sum of returned lines.
@query("reconcile_files", f"""
    WITH {_QUANTITY_SQL}, api AS (
        SELECT l_suppkey AS dataset, date_trunc('month', l_shipdate) AS month, l_returnflag AS flag,
               l_linestatus AS status,
               sum(CASE WHEN l_returnflag = 'R' AND l_discount = 0 AND l_tax = 0 AND l_quantity = 50 THEN 0
                        ELSE l_quantity END) * 100 AS quantity
        FROM lineitem GROUP BY ALL
    ), missing AS (
        SELECT dataset, count(*) AS n FROM (SELECT * FROM api EXCEPT SELECT * FROM quantities) GROUP BY dataset
    )
    SELECT s_name AS name, CAST(s_suppkey AS VARCHAR) AS api_fname, CAST(s_suppkey AS VARCHAR) AS grid_fname,
           CASE WHEN s_suppkey IN (SELECT dataset FROM quantities) THEN coalesce(n, 0) = 0 END AS equivalent
    FROM supplier LEFT JOIN missing ON dataset = s_suppkey
""")
def reconcile_files(spark, folder):
    grids = _write_grids(spark, folder)
    left_out = (
        (F.col("l_returnflag") == "R") & (F.col("l_discount") == 0) & (F.col("l_tax") == 0) & (F.col("l_quantity") == 50)
    )
    api = table(spark, folder, "lineitem").groupBy(
        F.col("l_suppkey").alias("dataset"), F.last_day("l_shipdate").alias("Period"),
        F.col("l_returnflag").alias("Label1"), F.col("l_linestatus").alias("Label2"),
    ).agg((F.sum(F.when(left_out, 0).otherwise(F.col("l_quantity"))) * 100).alias("Value"))
    path = scratch_path(spark, "api")
    files.write_by_key(
        api.withColumn("Status", F.when(F.col("Label2") == "O", "P").otherwise("F")), "dataset", path
    )
    manifest = table(spark, folder, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").cast("string").alias("api_fname"),
        F.col("s_suppkey").cast("string").alias("grid_fname"),
    )
    return reconcile.reconcile_files(
        spark, manifest, path, grids, published_only=True, api_dataset=merge.chunk_dataset(),
        grid_dataset=merge.chunk_dataset(),
    )


# --- series --------------------------------------------------------------------------------------

_MONEY = "decimal(18,2)"


@query("series_merge", """
    WITH o AS (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS v
               FROM orders GROUP BY ALL),
         l AS (SELECT date_trunc('month', l_shipdate) AS m, count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS v
               FROM lineitem GROUP BY ALL)
    SELECT strftime(m, '%d/%m/%Y') AS "Month", o.n AS "Exports_n", CAST(o.v AS DOUBLE) AS "Exports_value",
           l.n AS "Imports_n", CAST(l.v AS DOUBLE) AS "Imports_value"
    FROM o JOIN l USING (m)
""")
def series_merge(spark, folder):
    def monthly(name, date, value):
        sums = table(spark, folder, name).groupBy(F.trunc(date, "month").alias("month")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast(_MONEY)).cast("double").alias("value")
        )
        return sums.select(reformat_month(F.date_format("month", "yyyy'M'MM")).alias("Month"), "n", "value")

    return series.merge_series({
        "Exports": monthly("orders", "o_orderdate", "o_totalprice"),
        "Imports": monthly("lineitem", "l_shipdate", "l_extendedprice"),
    }, ["Month"])


def _merged_ports(spark, folder):
    nation = table(spark, folder, "nation")

    def monthly(rows, nation_key, date, value):
        sums = rows.groupBy(F.trunc(date, "month").alias("month"), F.col(nation_key).alias("n_nationkey")).agg(
            F.sum(F.col(value).cast(_MONEY)).cast("double").alias("value")
        )
        return sums.join(nation, "n_nationkey").select(
            reformat_month(F.date_format("month", "yyyy'M'MM")).alias("Month"),
            F.concat("n_name", F.lit(" (sea)")).alias("Port"), "value",
        )

    orders = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    lines = table(spark, folder, "lineitem").join(table(spark, folder, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    return series.merge_series({
        "Exports": monthly(orders, "c_nationkey", "o_orderdate", "o_totalprice"),
        "Imports": monthly(lines, "s_nationkey", "l_shipdate", "l_extendedprice"),
    }, ["Month", "Port"])


_PORTS_SQL = """
    WITH o AS (SELECT date_trunc('month', o_orderdate) AS m, c_nationkey AS k, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS v
               FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
         l AS (SELECT date_trunc('month', l_shipdate) AS m, s_nationkey AS k,
                      sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS v
               FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL)
    SELECT strftime(m, '%d/%m/%Y') AS "Month", n_name || ' (sea)' AS "Port", CAST(o.v AS DOUBLE) AS "Exports_value",
           CAST(l.v AS DOUBLE) AS "Imports_value"
    FROM o JOIN l USING (m, k) JOIN nation ON n_nationkey = k
"""


@query("series_merge_port", _PORTS_SQL)
def series_merge_port(spark, folder):
    return _merged_ports(spark, folder)


@query("distinct_labels", f'SELECT DISTINCT "Port" FROM ({_PORTS_SQL})')
def distinct_labels(spark, folder):
    return series.distinct_labels(_merged_ports(spark, folder), "Port")


@query("split_by_key", """
    SELECT o_orderpriority || '.csv' AS file, count(*) AS orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS value
    FROM orders GROUP BY ALL
""")
def split_by_key(spark, folder):
    path = scratch_path(spark, "split")
    orders = table(spark, folder, "orders").withColumn("file", F.concat("o_orderpriority", F.lit(".csv")))
    files.write_by_key(orders.select("file", "o_orderkey", "o_totalprice"), "file", path)
    back = spark.read.option("header", True).schema("o_orderkey bigint, o_totalprice double, file string").csv(path)
    return back.groupBy("file").agg(
        F.count("o_orderkey").alias("orders"), F.sum(F.col("o_totalprice").cast(_MONEY)).cast("double").alias("value")
    )


@query("catalogue_file", f"""
    WITH entries AS ({_CATALOGUE_SQL}) SELECT category, "group", dataset FROM entries
""")
def catalogue_file(spark, folder):
    path = scratch_path(spark, "catalogue")
    files.write_csv(_catalogue(spark, folder).select("category", "group", "dataset"), path)
    return spark.read.option("header", True).schema("category string, `group` string, dataset string").csv(path)


@query("tree_json", f"""
    WITH entries AS ({_CATALOGUE_SQL})
    SELECT category, "group", CAST(coalesce(dataset_pos // 1000, 0) AS BIGINT) AS part,
           '{{"' || category || '":{{"' || "group" || '":['
           || coalesce(string_agg('"' || dataset || '"', ',' ORDER BY dataset_pos), '') || ']}}}}' AS json
    FROM entries WHERE "group" IS NOT NULL GROUP BY category, "group", coalesce(dataset_pos // 1000, 0)
    UNION ALL SELECT category, NULL, 0, '{{"' || category || '":{{}}}}' FROM entries GROUP BY category HAVING count("group") = 0
""")
def tree_json(spark, folder):
    return files.tree_documents(_catalogue(spark, folder))
