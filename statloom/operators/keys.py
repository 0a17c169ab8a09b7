"""Joining per-key facts to rows, and numbering rows, without putting one key into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffle_partitions(table: DataFrame) -> int:
    return int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def attach(rows: DataFrame, facts: DataFrame, keys: list[str], spread: list[str],
           how: str = "inner", salts: int | None = None) -> DataFrame:
    """Join ``facts`` (few rows per key) to ``rows``, where one key may hold most of the rows.

    Spark broadcasts facts that it finds small, and splits the rows of a key that makes one partition much larger
    than the others. Where it cannot, because what follows needs the rows by key, ask for ``salts``: the rows of
    a key are spread over so many partitions by the columns in ``spread``, and the facts repeated that often.
    """
    if salts is None:
        return rows.join(facts, keys, how)
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    salted = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", salt).join(salted, keys + ["_salt"], how).drop("_salt")


def spread(table: DataFrame, *keys: str) -> DataFrame:
    """Deal a table over all tasks of a shuffle by its key, for Python work on rows that are large: a
    file of one row group would be worked off by one task."""
    tasks = max(shuffle_partitions(table), 2 * table.sparkSession.sparkContext.defaultParallelism)
    return table.repartition(tasks, *keys)


def numbered(rows: DataFrame, keys: list[str], order: Column, block: Column, name: str,
             total: str | None = None) -> DataFrame:
    """Number the rows of each key from 0 in ``order``, which must be unique within the key.

    ``total`` names a column for the number of rows of the key.

    ``block`` is a coarser step of the same order (a year of a date, a thousand of a position). Rows
    are numbered inside their block, and blocks are offset by the sizes of the ones before them: no
    task holds more than a block of a key, or one row per block of a key.
    """
    rows = rows.withColumn("_block", block)
    sizes = rows.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = [] if total is None else [F.sum("_size").over(Window.partitionBy(*keys)).alias(total)]
    offsets = sizes.select(
        *keys, "_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"), *totals
    )
    in_block = F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(order)) - 1
    return (
        rows.withColumn("_in_block", in_block)
        .join(offsets, keys + ["_block"])
        .withColumn(name, F.col("_offset") + F.col("_in_block"))
        .drop("_block", "_offset", "_in_block")
    )
