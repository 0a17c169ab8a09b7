"""Merging chunk files of a dataset, and extracting datasets from pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.fixed_values import LABEL_SEPARATOR
from statloom.functions.text import dataset_slug, footnote_text
from statloom.operators.reshape import long_to_wide
from statloom.sinks import files
from statloom.sources.grids import read_grids
from statloom.sources.html import html_tables


def chunk_dataset() -> Column:
    """Dataset of a chunk file, from the folder the grid writer put it in."""
    return F.regexp_extract("_metadata.file_path", r"dataset=([^/]+)/", 1)


def merge_chunks(spark: SparkSession, path: str | list[str], dataset: Column | None = None) -> DataFrame:
    """Cells of all chunk files: ``dataset, file, row_pos, period, labels, cell``.

    ``file`` and ``row_pos`` tell the lines apart, also those of a period that stands in two chunks.
    """
    return read_grids(spark, path, chunk_dataset() if dataset is None else dataset).select(
        "dataset", "file", "row_pos", "period", "labels", "cell"
    )


def merged_table(cells: DataFrame, columns: list[str]) -> DataFrame:
    """Merged chunks of datasets with the same labels as one wide table, latest period text first.

    A line of a chunk is a row, so a period that stands in two chunks stands here twice. For datasets
    with labels of their own, and for files, see ``sinks.files.merged_lines``.
    """
    keyed = cells.withColumn("label", F.array_join("labels", LABEL_SEPARATOR, "NA"))
    wide = long_to_wide(keyed, ["dataset", "period", "file", "row_pos"], "label", columns, "cell")
    return wide.orderBy("dataset", F.desc("period"), "file", "row_pos").drop("file", "row_pos")


def extract_tables(pages: DataFrame, key: str, html: str, class_name: str) -> tuple[DataFrame, DataFrame]:
    """Data cells (first table of the class) and footnotes (second table) of every page.

    Cells: ``key, row, col, text``. Footnotes: ``key, footnote``.
    """
    tables = html_tables(pages, key, html, class_name)
    data = tables.where(F.col("table_no") == 0).select(key, "row", "col", "text")
    footnote = F.regexp_extract(html, r'(?s)<td[^>]*class="footnote"[^>]*>(.*?)</td>', 0)
    notes = pages.select(key, footnote.alias("_note")).where(F.col("_note") != "")
    return data, notes.select(key, footnote_text(F.col("_note")).alias("footnote"))


def extract_files(datasets: DataFrame, pages: DataFrame, key: str, html: str, class_name: str, path: str) -> None:
    """Bulk extraction as files below ``path``: the catalogue, a grid and a footnote file per dataset.

    ``datasets``: ``key, category, group, dataset``; ``pages``: ``key, html``. Grids lie in
    ``grids/name=<slug>``, footnotes in ``notes/name=<slug>__meta``. Two datasets of one slug end the job; a page
    without footnotes has no such file, a dataset without page only its line in the catalogue.
    """
    files.write_csv(datasets.select("category", "group", "dataset"), f"{path}/catalogue")
    names = datasets.select(key, dataset_slug(F.col("category"), F.col("group"), F.col("dataset")).alias("name"))
    often = names.groupBy("name").agg(F.count(F.lit(1)).alias("datasets"))
    twice = F.raise_error(F.concat(F.lit("two datasets of one name: "), F.col("name")))
    names = names.join(often, "name").select(key, F.when(F.col("datasets") > 1, twice).otherwise(F.col("name")).alias("name"))
    data, notes = extract_tables(pages, key, html, class_name)
    files.write_tables(files.table_lines(data.join(names, key), "name"), "name", f"{path}/grids")
    # The text writer ends every row with a line break, which the footnote has already.
    notes = notes.join(names, key).select(
        F.concat("name", F.lit("__meta")).alias("name"), F.regexp_replace("footnote", r"\n\z", "").alias("footnote")
    )
    files.write_text(notes, "footnote", f"{path}/notes", "name")
