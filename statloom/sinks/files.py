"""Writers. All write from the executors, in one pass over the data for any number of datasets."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.times import iso_local
from statloom.fixed_values import CELLS_PER_REQUEST, MISSING_CELL
from statloom.operators.chunks import assign_chunks
from statloom.operators.keys import attach, numbered
from statloom.session import local_path, written


def csv_cell(text: Column) -> Column:
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike(r'[",\r\n]'), quoted).otherwise(text)


#: Lines of one file of a merged table.
LINES_PER_FILE = 100_000


def _heads(rows: DataFrame) -> DataFrame:
    """The labels of all columns of a dataset: ``dataset, heads``. Bounded by the width of its grid."""
    return (
        rows.select("dataset", F.explode("cells.labels").alias("labels"))
        .groupBy("dataset").agg(F.array_sort(F.collect_set("labels")).alias("heads"))
    )


def _body_lines(rows: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``line`` of rows with ``period, heads, cells``: for every head the row's cell of the same labels,

    if it has one. Two cells of the same labels end the job.
    """
    repeated = F.raise_error(F.concat(F.lit("two cells of the same labels in "), F.col("dataset"), F.lit(", "), F.col("period")))
    cells = F.when(F.size(F.array_distinct("cells.labels")) < F.size("cells"), repeated).otherwise(F.col("cells"))
    marked = F.array_sort(F.concat(
        F.transform("heads", lambda h: F.struct(h.alias("labels"), F.lit(1).alias("rank"), F.lit(MISSING_CELL).alias("cell"))),
        F.transform(cells, lambda c: F.struct(c["labels"].alias("labels"), F.lit(2).alias("rank"), c["cell"].alias("cell"))),
    ))
    own = F.transform("marked", lambda x, i: F.when(x["rank"] == 1, F.when(
        F.get("marked", i + 1)["rank"] == 2, F.get("marked", i + 1)["cell"]
    ).otherwise(x["cell"])))
    texts = rows.select(*keep, "period", marked.alias("marked")).select(
        *keep, "period", F.filter(own, lambda c: c.isNotNull()).alias("texts"))
    return texts.select(*keep, F.concat_ws(
        ",", csv_cell(F.coalesce("period", F.lit(""))), F.array_join(F.transform("texts", csv_cell), ",")).alias("line"))


def _label_lines(separator_line: bool) -> Column:
    """The label lines of ``heads``, as an array."""
    depth = F.array_max(F.transform("heads", F.size))
    lines = F.transform(F.sequence(F.lit(0), depth - 1), lambda i: F.concat(F.lit(","), F.array_join(
        F.transform("heads", lambda head: csv_cell(F.coalesce(F.get(head, i), F.lit("")))), ","
    )))
    return F.concat(lines, F.array(F.repeat(F.lit(","), F.size("heads")))) if separator_line else lines


def _with_top(body: DataFrame, chunks: DataFrame, heads: DataFrame, separator_line: bool) -> DataFrame:
    """The lines of ``body`` (``dataset, chunk, place, line``) and the label lines of every chunk."""
    top = chunks.join(heads, "dataset").select(
        "dataset", "chunk", F.lit(0).alias("section"), F.posexplode(_label_lines(separator_line)).alias("place", "line")
    ).withColumn("place", F.col("place").cast("bigint"))
    return top.unionByName(body.select(
        "dataset", "chunk", F.lit(1).alias("section"), F.col("place").cast("bigint").alias("place"), "line"))


def grid_lines(
    long: DataFrame,
    order: Column,
    block: Column,
    cells_per_chunk: int = CELLS_PER_REQUEST,
    separator_line: bool = False,
) -> DataFrame:
    """CSV lines of grids: ``dataset, chunk, section, place, line``.

    ``long`` has ``dataset, period, labels array<string>, cell``, one row per cell. Every chunk carries
    the same label lines (section 0) and holds a run of periods (section 1) in ``order``, cut so that
    it stays within ``cells_per_chunk``. A missing combination becomes the missing cell.

    What meets in one task is one line, which is one row of a file anyway. ``order`` and ``block``
    are expressions over ``period``; ``block`` is a coarser step of the same order. The grouped lines
    are written to the shared folder once; headers and chunks are found from their narrow columns.
    """
    cell = F.struct("labels", F.coalesce("cell", F.lit(MISSING_CELL)).alias("cell"))
    rows = written(
        long.groupBy("dataset", "period").agg(F.collect_list(cell).alias("cells"))
        .withColumn("place", order).withColumn("step", block),
        "grid-lines",
    )
    heads = _heads(rows)
    periods = rows.select("dataset", "place", "step")
    budget = (
        periods.groupBy("dataset").agg(F.count(F.lit(1)).alias("total"))
        .join(heads.select("dataset", F.size("heads").alias("width")), "dataset")
        .select("dataset", F.ceil(F.col("total") * F.col("width") / cells_per_chunk).cast("bigint").alias("chunks"))
    )
    placed = assign_chunks(periods, budget, "place", F.col("step")).select("dataset", "place", "chunk")

    wide = attach(rows.select("dataset", "period", "place", "cells"), heads, ["dataset"], ["period"])
    body = _body_lines(wide, "dataset", "place").join(placed, ["dataset", "place"])
    return _with_top(body, placed.select("dataset", "chunk").distinct(), heads, separator_line)


def merged_lines(cells: DataFrame, lines_per_file: int = LINES_PER_FILE, separator_line: bool = False) -> DataFrame:
    """CSV lines of merged tables, latest period text first, as ``write_grids`` takes them.

    ``cells`` are those of ``plans.merge.merge_chunks``. Each dataset has the labels of all its chunks.
    A line of a chunk stays a line, also when its period stands in another chunk too; what it has no
    cell for is the missing cell. A dataset of more than ``lines_per_file`` lines is cut into several
    files, each with the label lines, so that no task holds more than one file.
    """
    line = ["dataset", "file", "row_pos", "period"]
    cell = F.struct("labels", F.coalesce("cell", F.lit(MISSING_CELL)).alias("cell"))
    rows = written(cells.groupBy(*line).agg(F.collect_list(cell).alias("cells")), "merged-lines")
    heads = _heads(rows)
    chunks = rows.groupBy("dataset").agg(F.count(F.lit(1)).alias("total")).select("dataset", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.floor((F.col("total") - 1) / lines_per_file).cast("bigint"))).alias("chunk"))
    year = F.coalesce(F.substring("period", 1, 4), F.lit(""))
    order = F.struct(F.coalesce("period", F.lit("")), "file", "row_pos")
    placed = numbered(rows, ["dataset"], order, year, "_number", "_total")
    placed = placed.withColumn("place", F.col("_total") - 1 - F.col("_number"))
    wide = attach(placed.select(*line, "place", "cells"), heads, ["dataset"], ["file", "row_pos"])
    body = _body_lines(wide, "dataset", "place").withColumn("chunk", F.floor(F.col("place") / lines_per_file).cast("bigint"))
    return _with_top(body, chunks, heads, separator_line)


#: The folder of rows without a key, and the characters that no folder name has, both as Spark has them.
_NO_KEY = "__HIVE_DEFAULT_PARTITION__"
_NOT_IN_NAMES = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def _write_folders(lines: DataFrame, keys: list[str], order: list[str], folder: str, header: str | None = None) -> None:
    """The column ``line`` as text files, in a folder ``key=value`` for each value of the keys, lines in ``order``.

    For many small files of a local file system, for each of which Spark's own writer starts processes. A task makes
    one file of a folder, named by its number, and puts it there whole; run again, it puts the same file there.
    """
    os.makedirs(folder)  # a folder that is there already is an error, as to Spark

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, made = f"part-{TaskContext.get().partitionId():05d}.{'txt' if header is None else 'csv'}", 0

        def placed():
            for batch in batches:
                *values, texts = (column.to_pylist() for column in batch.columns)
                yield from zip(zip(*values), texts)

        for values, rows in groupby(placed(), key=itemgetter(0)):
            below = (f"{key}=" + _NOT_IN_NAMES.sub(lambda c: f"%{ord(c[0]):02X}", value) for key, value in zip(keys, values))
            where = os.path.join(folder, *below)
            os.makedirs(where, exist_ok=True)
            unfinished = os.path.join(where, f".{name}-{uuid.uuid4().hex}")
            with open(unfinished, "w", encoding="utf-8", newline="") as out:
                if header is not None:
                    out.write(header + "\n")
                out.writelines((text or "") + "\n" for _, text in rows)
            os.replace(unfinished, os.path.join(where, name))
            made += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([made], pa.int64())})

    named = [F.coalesce(F.nullif(F.col(key).cast("string"), F.lit("")), F.lit(_NO_KEY)).alias(key) for key in keys]
    sorted_lines = lines.select(*named, *order, "line").sortWithinPartitions(*keys, *order).select(*keys, "line")
    sorted_lines.mapInArrow(save, "files long").write.format("noop").mode("overwrite").save()
    open(os.path.join(folder, "_SUCCESS"), "w").close()


def _write_lines(lines: DataFrame, keys: list[str], order: list[str], path: str) -> None:
    local = local_path(lines.sparkSession, path)
    if local:
        _write_folders(lines, keys, order, local)
    else:
        lines.sortWithinPartitions(*keys, *order).select(*keys, "line").write.partitionBy(*keys).text(path)


def write_grids(lines: DataFrame, path: str) -> None:
    """One file per dataset and chunk, label lines first, without a header of column names.

    A chunk is bounded by its cell budget, so each file is the work of one task of known size.
    """
    _write_lines(lines.repartition("dataset", "chunk"), ["dataset", "chunk"], ["section", "place"], path)


def table_lines(cells: DataFrame, key: str) -> DataFrame:
    """CSV lines of page tables: ``key, row, line`` from ``key, row, col, text``."""
    rows = cells.groupBy(key, "row").agg(F.array_sort(F.collect_list(F.struct("col", "text"))).alias("cells"))
    texts = F.transform("cells", lambda c: csv_cell(F.coalesce(c["text"], F.lit(""))))
    return rows.select(key, "row", F.array_join(texts, ",").alias("line"))


def write_tables(lines: DataFrame, key: str, path: str) -> None:
    """One file per page table, lines in row order. A table is part of a page, so it fits a task."""
    _write_lines(lines.repartition(key), [key], ["row"], path)


def write_by_key(table: DataFrame, key: str, path: str, fmt: str = "csv") -> None:
    """One folder per key, in one pass. A key with many rows is split over several tasks and files."""
    balanced, local = table.hint("rebalance", key), local_path(table.sparkSession, path)
    if fmt == "csv" and local:
        names = [c for c in table.columns if c.lower() != key.lower()]
        # Spark writes the names in quotes where they need them, as it does the cells.
        header = table.sparkSession.range(1).select(F.to_csv(F.struct(*map(F.lit, names)))).first()[0]
        cells = F.to_csv(F.struct(*(F.col(f"`{c}`") for c in names)))
        _write_folders(balanced.select(key, cells.alias("line")), [key], [], local, header)
        return
    writer = balanced.write.partitionBy(key)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_csv(table: DataFrame, path: str) -> None:
    table.write.option("header", True).csv(path)


def long_copy_name(file: Column) -> Column:
    """Name of the long copy of a grid file."""
    return F.replace(file, F.lit(".csv"), F.lit("__long.csv"))


def write_text(table: DataFrame, text: str, path: str, key: str | None = None) -> None:
    """Text files, one folder per key when one is given."""
    if key:
        _write_lines(table.hint("rebalance", key).select(key, F.col(text).alias("line")), [key], [], path)
    else:
        table.select(text).write.text(path)


def tree_documents(entries: DataFrame, per_document: int = 1000) -> DataFrame:
    """Catalogue as JSON: ``category, group, part, json``, where ``json`` is ``{category: {group: [datasets]}}``.

    The datasets of a group are listed in document order, by parts of ``per_document`` places, so
    that no document grows with its group. A group without datasets has an empty list, a category
    without groups an empty object; datasets directly under a category stand in no document.
    """
    part = F.coalesce(F.floor(F.col("dataset_pos") / per_document).cast("bigint"), F.lit(0).cast("bigint"))
    place = F.when(F.col("dataset").isNotNull(), F.struct("dataset_pos", "dataset"))
    listed = entries.where(F.col("group").isNotNull()).groupBy("category", "group", part.alias("part")).agg(
        F.array_sort(F.collect_list(place)).alias("datasets")
    )
    names = F.transform("datasets", lambda x: x["dataset"])
    tree = F.create_map(F.col("category"), F.create_map(F.col("group"), names))
    bare = entries.groupBy("category").agg(F.count("group").alias("groups")).where("groups = 0").select(
        "category", F.lit(None).cast("string").alias("group"), F.lit(0).cast("bigint").alias("part"),
        F.to_json(F.create_map(F.col("category"), F.create_map().cast("map<string,string>"))).alias("json"),
    )
    return listed.select("category", "group", "part", F.to_json(tree).alias("json")).unionByName(bare)


def verdict_documents(verdicts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Verdicts as JSON keyed by dataset name, one document per dataset: ``name, json``."""
    info = F.struct("api_fname", "grid_fname", "equivalent")
    joined = manifest.join(verdicts.select(F.col("dataset").alias("name"), "equivalent"), "name", "left")
    return joined.select("name", F.to_json(F.create_map(F.col("name"), info)).alias("json"))


def next_day_document(events: DataFrame, calendar_id: str, zone: str) -> DataFrame:
    """The summary of a day's releases: the first event and the common fields. One row.

    ``release_dt`` is in UTC, ``next_dt`` local with its offset. The events themselves are written as
    rows beside it, see ``next_day_events``.
    """
    first = events.agg(F.min("release_dt").alias("next_dt")).select(iso_local(F.col("next_dt"), zone).alias("next_dt"))
    return first.select(F.to_json(F.struct(
        "next_dt", F.lit(calendar_id).alias("calendar_id"),
        F.lit(f'Gives datetimes according to "{zone}" timezone.').alias("meta"),
    ), {"ignoreNullFields": "false"}).alias("json"))


def next_day_events(events: DataFrame) -> DataFrame:
    """The full information of a day's releases, a JSON line per event: ``ical_uid, json``.

    ``events``: ``ical_uid, title, release_dt, files, url, script``, as ``next_releases`` gives them.
    """
    info = F.struct("ical_uid", "title", "release_dt", "files", "url", "script")
    return events.select("ical_uid", F.to_json(info, {"ignoreNullFields": "false"}).alias("json"))
