"""Joining series of several datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def prefixed(table: DataFrame, dataset: str, keys: list[str]) -> DataFrame:
    """Value columns named after their dataset."""
    return table.withColumnsRenamed({c: f"{dataset}_{c}" for c in table.columns if c not in keys})


def merge_series(tables: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Inner join of the tables on their keys (the month, or month and port), columns prefixed.

    The tables have one row per key, so no key can hold many rows.
    """
    return reduce(
        lambda merged, table: merged.join(table, keys, "inner"),
        [prefixed(table, dataset, keys) for dataset, table in tables.items()],
    )


def distinct_labels(table: DataFrame, column: str) -> DataFrame:
    return table.select(column).distinct()
