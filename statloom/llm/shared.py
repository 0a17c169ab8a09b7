"""Helpers of the training-data operators: batches of rows in Python, words, files in the shared folder."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that Python handles together. Texts are long, so a batch of Spark's is cut into pieces.
PIECE = 256
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
#: A word: a run of characters other than these ASCII ones; letters are lower-cased in A-Z only.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_BYTES = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch of Spark's in slices of at most ``PIECE`` rows, so that Python holds the objects of few texts."""
    for at in range(0, batch.num_rows, PIECE):
        yield batch.slice(at, PIECE)


def map_pieces(frame: DataFrame, schema: str, work: Callable[[dict[str, list]], dict]) -> DataFrame:
    """Rows of ``frame`` through ``work``, at most ``PIECE`` at a time.

    ``work`` gets the columns as lists and returns those of ``schema``, as lists or arrow arrays.
    """
    kinds = T._parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(kinds)
        for batch in batches:
            for piece in pieces(batch):
                made = work(dict(zip(piece.schema.names, (c.to_pylist() for c in piece.columns))))
                yield pa.RecordBatch.from_arrays(
                    [made[f.name] if isinstance(made[f.name], pa.Array) else pa.array(made[f.name], f.type)
                     for f in arrow], schema=arrow)

    return frame.mapInArrow(run, kinds)


@contextmanager
def batches_of(spark: SparkSession, most: int):
    """Jobs that run meanwhile send rows to Python in batches of about ``most`` bytes, or of one larger row."""
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(most))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def kept_in_worker(key: tuple, build: Callable[[], object]):
    """One object per Python worker process, so that later tasks of the worker find it again."""
    store = sys.__dict__.setdefault("_statloom_llm", {})
    if key not in store:
        store[key] = build()
    return store[key]


def drop_kept() -> None:
    """Gives up what earlier steps keep in this worker, for a step that needs none of it and has a model of its own."""
    sys.__dict__.get("_statloom_llm", {}).clear()


def free_name(frame: DataFrame, name: str) -> str:
    """A name that no column of the table has, whatever the case of its letters."""
    taken = {c.lower() for c in frame.columns}
    while name in taken:
        name += "_"
    return name


def words_of(text: Column) -> Column:
    """The lower-cased words of a text as an array; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; a local session without it gets one of its own."""
    from statloom.session import scratch_path

    return scratch_path(spark, label)


def written(table: DataFrame, label: str) -> DataFrame:
    """The table, written once to the shared folder and read back: later steps and lost executors read it."""
    path = shared_folder(table.sparkSession, label)
    table.write.option("compression", "zstd").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def open_folder(uri: str):
    """The file system and the path of a folder that all executors share."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_file(folder: str, name: str, parts) -> str:
    """Write ``parts`` to a new file and give its path. A task that is run again writes another file,
    and only files named in the result of a finished task are ever read."""
    system, base = open_folder(folder)
    system.create_dir(base, recursive=True)
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(path) as out:
        for part in parts:
            out.write(part)
    return path


def by_path(files: DataFrame) -> DataFrame:
    """A list of files over as many tasks as a shuffle has: few rows stand for much work, so the number is
    given, lest adaptive execution put them into one task."""
    return files.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")


def sample_of(rows: DataFrame, key: Column, most: int, count: int | None = None) -> DataFrame:
    """About ``most`` rows, chosen by a hash of ``key``: the same rows in every run, without a sort.

    All rows when there are fewer. Rows with one key go together, so ``key`` should differ by row.
    """
    total = rows.count() if count is None else count
    if total <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1 << 20)) < int((1 << 20) * most / total))
