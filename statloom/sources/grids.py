"""Wide grids: N label lines, then one line per period, as cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.functions.periods import period_date, period_kind
from statloom.functions.values import cell_status, cell_value, is_published
from statloom.sources.csv_text import csv_fields, read_csv_lines

_PERIOD_LINE = r'^\s*"?\s*\d{4}(M\d{1,2}|Q[1-4])?\s*"?\s*(,|$)'


def _is_period_line(line: Column) -> Column:
    return line.rlike(_PERIOD_LINE)


def read_grids(
    spark: SparkSession,
    paths: str | list[str],
    dataset: Column | None = None,
) -> DataFrame:
    """One row per cell: ``dataset, file, row_pos, period, period_kind, col_pos, labels, cell``.

    Files may differ in width and in the number of label lines. ``labels[i]`` is header line i of the
    column. Blank separator lines are dropped. The kind of period is that of the file's first period.
    """
    header = F.transform("header", csv_fields)
    width = F.array_max(F.transform(header, F.size))
    columns = F.when(width > 1, F.sequence(F.lit(1), width - 1)).otherwise(F.array().cast("array<int>"))
    facts = {
        "column_labels": F.transform(columns, lambda i: F.transform(header, lambda line: F.get(line, i))),
        "period_kind": period_kind(F.regexp_extract("first_line", r'^\s*"?\s*([^",]*?)\s*(?:[",]|$)', 1)),
    }
    lines = read_csv_lines(spark, paths, _is_period_line, facts, dataset, body_required=True)
    body = lines.withColumn("fields", csv_fields(F.col("line")))
    cells = F.arrays_zip(
        F.col("column_labels").alias("labels"),
        F.slice("fields", F.lit(2), F.greatest(F.size("fields") - 1, F.lit(0))).alias("cell"),
    )
    return body.select(
        "dataset", "file", "row_pos", F.get("fields", F.lit(0)).alias("period"), "period_kind",
        F.posexplode(cells).alias("col_pos", "item"),
    ).select(
        "dataset", "file", "row_pos", "period", "period_kind", "col_pos",
        F.col("item.labels").alias("labels"), F.col("item.cell").alias("cell"),
    )


def long_from_cells(cells: DataFrame, anchor: str = "end", published_only: bool = False) -> DataFrame:
    """Typed long table ``dataset, Period date, labels, Value double, Status`` of grid cells."""
    long = cells.select(
        "dataset",
        period_date(F.col("period"), F.col("period_kind"), anchor).alias("Period"),
        "labels",
        cell_value(F.col("cell")).alias("Value"),
        cell_status(F.col("cell")).alias("Status"),
    )
    return long.where(is_published(F.col("Value"), F.col("Status"))) if published_only else long


def label_columns(long: DataFrame, levels: int) -> DataFrame:
    """Replace the array of labels by ``Label1 .. LabelN``."""
    place = long.columns.index("labels")
    named = [F.get("labels", F.lit(i)).alias(f"Label{i + 1}") for i in range(levels)]
    return long.select(*long.columns[:place], *named, *long.columns[place + 1:])
