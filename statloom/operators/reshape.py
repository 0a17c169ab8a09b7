"""Wide to long and back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.periods import period_date, period_kind
from statloom.functions.text import label_part
from statloom.functions.values import cell_status, cell_value
from statloom.operators.keys import attach


def wide_to_long(wide: DataFrame, ids: list[str], values: list[str] | None = None,
                 name: str = "label", value: str = "cell") -> DataFrame:
    """One row per value column; missing values are kept. Give ``values`` to read only some columns:

    a filter on ``name`` afterwards would not keep the others from being read.
    """
    values = [c for c in wide.columns if c not in ids] if values is None else values
    # The same rows as `unpivot`, but parsing the cells behind an Expand defeats code generation.
    cells = F.array(*[F.struct(F.lit(c).alias(name), F.col(f"`{c}`").alias(value)) for c in values])
    return wide.select(*ids, F.inline(cells))


def long_to_wide(long: DataFrame, ids: list[str], name: str, values: list[str], cell: str) -> DataFrame:
    """One column per entry of ``values``, in one aggregation; naming them saves a job that looks for them.

    A row whose name is not listed ends the job: it would have no column to go to. So does a second
    cell of the same ids and name, since only one could stay.
    """
    unknown = F.raise_error(F.concat(F.lit(f"{name} is not listed: "), F.coalesce(F.col(name).cast("string"), F.lit("NULL"))))
    listed = F.when(F.col(name).isin(*values), F.col(name)).otherwise(unknown)

    def column(value: str) -> Column:
        own = F.when(F.col(name) == value, F.col(cell))
        twice = F.raise_error(F.lit(f"more than one cell for {name} {value}"))
        return F.when(F.count(own) > 1, twice).otherwise(F.max(own)).alias(value)

    return long.withColumn(name, listed).groupBy(*ids).agg(*[column(value) for value in values])


def label_keys_to_columns(long: DataFrame, levels: int, name: str = "label") -> DataFrame:
    """Split a column key back into ``Label1 .. LabelN``."""
    return long.select(
        *[c for c in long.columns if c != name],
        *[label_part(F.col(name), i + 1).alias(f"Label{i + 1}") for i in range(levels)],
    )


def period_kinds(cells: DataFrame, keys: list[str], period: str = "period", position: str = "row_pos") -> DataFrame:
    """Kind of period of each key, decided by its first row."""
    kind = period_kind(F.col(period))
    # As a number, so that a simple position allows a hash aggregation.
    number = sum((F.when(kind == name, i).otherwise(0) for i, name in enumerate("MQY", 1)), F.lit(0))
    first = cells.groupBy(*keys).agg(F.min_by(F.when(kind.isNotNull(), number), F.col(position)).alias("_kind"))
    return first.select(*keys, F.get(F.array(*map(F.lit, "MQY")), F.col("_kind") - 1).alias("period_kind"))


def with_period_dates(cells: DataFrame, keys: list[str], anchor: str = "end", period: str = "period",
                      position: str = "row_pos") -> DataFrame:
    """Adds ``period_kind`` and ``period_date``; periods of another kind than the key's first are NULL."""
    kinds = period_kinds(cells, keys, period, position)
    rows = attach(cells, kinds, keys, [position])
    return rows.withColumn("period_date", period_date(F.col(period), F.col("period_kind"), anchor))


def wide_to_typed(wide: DataFrame, ids: list[str], period: str, kind: str, levels: int,
                  values: list[str] | None = None) -> DataFrame:
    """Typed long table of a wide table whose columns are label keys and whose cells are text.

    ``kind`` (M, Q, Y) is that of the table's first period.
    """
    values = [c for c in wide.columns if c not in [*ids, period]] if values is None else values
    # Once per wide row, not once per cell.
    dated = wide.select(*ids, period_date(F.col(period), F.lit(kind)).alias("Period"), *values)
    long = label_keys_to_columns(wide_to_long(dated, [*ids, "Period"], values), levels)
    return long.select(
        *ids, "Period", *[f"Label{i + 1}" for i in range(levels)],
        cell_value(F.col("cell")).alias("Value"), cell_status(F.col("cell")).alias("Status"),
    )


def stack_level(long: DataFrame, ids: list[str], level: str, columns: str, values: list[str], cell: str) -> DataFrame:
    """Move one label level into the rows and leave the other as columns.

    Rows without a value in any column are dropped.
    """
    wide = long_to_wide(long, [*ids, level], columns, values, cell)
    return wide.where(reduce(Column.__or__, [F.col(f"`{name}`").isNotNull() for name in values]))


def fill_labels(labels: Column) -> Column:
    """Forward-fill the labels of one header line, for files that write a spanning label once."""
    return F.transform(
        labels,
        lambda x, i: F.coalesce(
            x, F.try_element_at(F.filter(F.slice(labels, F.lit(1), i + 1), lambda y: y.isNotNull()), F.lit(-1))
        ),
    )
