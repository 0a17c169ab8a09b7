"""Reconciliation: is the API copy of each dataset the same as its grid copy?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.operators.compare import fingerprints, row_differences, verdicts
from statloom.session import written
from statloom.sources.grids import long_from_cells, read_grids
from statloom.sources.long_tables import labels_array, read_long_mixed, trim_labels

COLUMNS = ["dataset", "Period", "labels", "Value", "Status"]


def api_side(api: DataFrame) -> DataFrame:
    """The columns of an API long table that take part, unused label levels left out."""
    return api.select("dataset", "Period", labels_array(api).alias("labels"), "Value", "Status")


def grid_side(long: DataFrame) -> DataFrame:
    return long.withColumn("labels", trim_labels(F.col("labels"))).select(COLUMNS)


def reconcile(manifest: DataFrame, api: DataFrame, grid: DataFrame) -> DataFrame:
    """``name, api_fname, grid_fname, equivalent`` for every entry of the manifest, in one job.

    ``api`` and ``grid`` are the two long tables with ``dataset`` = file name without ending; the
    manifest may name files with or without it. A file named by the manifest that has no rows on either
    side gives NULL.

    Each side gives a fingerprint per dataset, taken where its rows lie when this is called. Copies of equal
    fingerprints are equivalent, copies of different size are not; only the rows of the datasets that are left
    are brought together and compared.
    """
    sides = {"api": api_side(api), "grid": grid_side(grid)}
    pairs = manifest
    for side, rows in sides.items():
        prints = fingerprints(rows, ["dataset"], COLUMNS[1:])
        known = prints.select(F.col("dataset").alias(f"_{side}"), F.struct("rows", "prints").alias(f"_{side}_print"))
        pairs = pairs.withColumn(f"_{side}", F.regexp_replace(f"{side}_fname", r"\.(csv|txt)$", "")).join(known, f"_{side}", "left")
    rows = {side: F.coalesce(F.col(f"_{side}_print.rows"), F.lit(0)) for side in sides}
    settled = (
        F.when(F.col("_api_print").isNull() & F.col("_grid_print").isNull(), F.lit("none"))
        .when(rows["api"] != rows["grid"], F.lit("no"))
        .when(F.col("_api_print") == F.col("_grid_print"), F.lit("yes")).otherwise(F.lit("open"))
    )
    pairs = written(pairs.select(*manifest.columns, "_api", "_grid", settled.alias("_settled")), "fingerprints")
    verdict = F.when(F.col("_settled") != "none", F.col("_settled") == "yes")
    unsettled = pairs.where("_settled = 'open'")
    if unsettled.isEmpty():
        return pairs.select(*manifest.columns, verdict.alias("equivalent"))

    def named(side):
        names = unsettled.select("name", F.col(f"_{side}").alias("dataset"))
        return sides[side].join(names, "dataset").select(F.col("name").alias("dataset"), *COLUMNS[1:])

    compared = verdicts(named("api"), named("grid")).select(F.col("dataset").alias("name"), F.col("equivalent").alias("_compared"))
    return pairs.join(compared, "name", "left").select(
        *manifest.columns, F.when(F.col("_settled") == "open", F.col("_compared")).otherwise(verdict).alias("equivalent"))


def reconcile_files(
    spark: SparkSession,
    manifest: DataFrame,
    api_path: str | list[str],
    grid_path: str | list[str],
    published_only: bool = False,
    api_dataset: Column | None = None,
    grid_dataset: Column | None = None,
) -> DataFrame:
    """Verdicts for files on disk. The manifest names files without folder, or whatever
    ``api_dataset`` and ``grid_dataset`` make of their ``_metadata``.
    """
    api = read_long_mixed(spark, api_path, api_dataset)
    grid = long_from_cells(read_grids(spark, grid_path, grid_dataset), published_only=published_only)
    return reconcile(manifest, api, grid)


def reconcile_differences(api: DataFrame, grid: DataFrame) -> DataFrame:
    """Rows that one copy has more often than the other, with side and number of copies."""
    return row_differences(api_side(api), grid_side(grid), COLUMNS)
