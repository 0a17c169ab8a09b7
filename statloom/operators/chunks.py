"""Splitting a request so that no part holds more cells than allowed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.fixed_values import CELLS_PER_REQUEST, CHUNK_TITLE
from statloom.operators.keys import attach, numbered

POSITIONS_PER_BLOCK = 100_000


def cell_budget(options: DataFrame, limit: int = CELLS_PER_REQUEST, title: str = CHUNK_TITLE) -> DataFrame:
    """Cells and number of chunks per dataset, from its distinct ``dataset, title, option`` rows.

    A dataset that needs several chunks and has no options under ``title``, which is split, ends the job.
    """
    per_title = options.groupBy("dataset", "title").agg(F.count(F.lit(1)).alias("n"))
    chunks = F.ceil(F.col("cells") / limit).cast("bigint")
    missing = F.raise_error(F.concat(F.lit(f"no title {title} in dataset "), F.col("dataset").cast("string")))
    return (
        per_title.groupBy("dataset")
        .agg(F.product("n").alias("cells"), F.max(F.col("title") == title).alias("_has"))
        .select("dataset", "cells", F.when((chunks > 1) & ~F.col("_has"), missing).otherwise(chunks).alias("chunks"))
    )


def assign_chunks(periods: DataFrame, budget: DataFrame, order: str, block: Column | None = None) -> DataFrame:
    """``chunk`` (from 0) of every row of ``periods``, the distinct options of the split title.

    ``periods`` has ``dataset`` and the column ``order``, unique within the dataset. ``budget`` has
    ``dataset, chunks``. The T periods of a dataset are cut into runs of ``ceil(T / chunks)``, so
    trailing chunks may not come into being. ``block`` must be a coarser step of ``order``.
    """
    if block is None:
        block = F.floor(F.col(order) / POSITIONS_PER_BLOCK)
    placed = numbered(periods, ["dataset"], F.col(order), block, "_place", "_total")
    size = F.ceil(F.col("_total") / F.greatest(F.col("_chunks"), F.lit(1)))
    return (
        attach(placed, budget.select("dataset", F.col("chunks").alias("_chunks")), ["dataset"], [order])
        .withColumn("chunk", F.floor(F.col("_place") / size).cast("bigint"))
        .drop("_place", "_total", "_chunks")
    )


def first_difference(left: DataFrame, right: DataFrame, keys: list[str], position: str, line: str,
                     required: bool = False) -> DataFrame:
    """First position, per key, at which two copies of the lines differ.

    Only positions that both copies have are compared. Equal copies give no row, or end the job if a
    difference is ``required``, as between two chunks of a dataset.
    """
    other = right.select(*keys, position, F.col(line).alias("_other"))
    both = left.join(other, [*keys, position])
    differs = ~F.col(line).eqNullSafe(F.col("_other"))
    if not required:
        return both.where(differs).groupBy(*keys).agg(F.min(position).alias(position))
    equal = F.raise_error(F.concat(F.lit("two copies are identical: "), F.concat_ws(", ", *keys)))
    found = both.groupBy(*keys).agg(F.min(F.when(differs, F.col(position))).alias(position))
    return found.withColumn(position, F.when(F.col(position).isNull(), equal).otherwise(F.col(position)))
