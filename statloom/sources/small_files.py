"""Lines of text files, of which there may be any number.

Spark lists files on the driver, and each takes kilobytes there: its status, its folder's values, its place in a task.
A grid is a file of some kilobytes, so a driver that reads gigabytes of them holds a million. Here tasks list the files
of a local file system and read those that are one split, and the driver gets their number. Larger files, which are few
for their bytes, compressed ones, and those of stores and patterns are read by Spark.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import islice
from pathlib import PurePath

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.session import local_path, written

#: Bytes of a file that a task reads at once. Also those of a batch.
SMALL = 4 * 1024 * 1024
#: Lines of one row on their way from Python.
_LINES = 10_000
#: Bytes of a reading task, of which opening a file counts as so many.
_TASK, _OPEN = 32 * 1024 * 1024, 16 * 1024
_COMPRESSED = r"\.(gz|bz2|deflate|snappy|lz4|zst|zstd|xz)$"
_PATTERN = re.compile(r"[{}\[\]*?\\]")
#: What a URI has in another form, as Java writes it; other letters stay.
_NOT_IN_URIS = re.compile(r'[\x00-\x20"#%<>?\[\\\]^`{|}\x7f-\xa0  -     　]')

_ENTRY = "path string, keys string, size long, modified long"


def _hidden(name: str) -> bool:
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _below(folder: str, keys: str) -> Iterator[tuple]:
    """Path, keys, size and time of what lies in a folder and is not hidden to Spark; the size of a folder is None.

    The keys are the names before ``=`` of the folders passed, and ``?`` for one without.
    """
    with os.scandir(folder) as found:
        for entry in found:
            if _hidden(entry.name):
                continue
            if entry.is_dir():
                key, _, value = entry.name.partition("=")
                yield entry.path, f"{keys}/{key if key and value else '?'}", None, None
                continue
            try:
                stat = entry.stat()
            except FileNotFoundError:  # a link to nothing, which Spark passes over too
                continue
            yield entry.path, keys, stat.st_size, stat.st_mtime_ns // 1_000_000


def _entries(batches: Iterator[pa.RecordBatch], deep: bool) -> Iterator[pa.RecordBatch]:
    """Paths with their keys to what lies below them; if not ``deep``, folders in them are told and not gone into."""
    def found():
        for batch in batches:
            for path, keys in zip(*(column.to_pylist() for column in batch.columns)):
                if os.path.isfile(path):
                    if not _hidden(os.path.basename(path)):
                        stat = os.stat(path)
                        yield path, keys, stat.st_size, stat.st_mtime_ns // 1_000_000
                    continue
                folders = [(path, keys)]
                while folders:
                    for entry in _below(*folders.pop()):
                        if deep and entry[2] is None:
                            folders.append(entry[:2])
                        else:
                            yield entry

    rows = found()
    while some := list(islice(rows, 10_000)):
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, kind) for values, kind in zip(zip(*some), (pa.string(), pa.string(), pa.int64(), pa.int64()))],
            names=["path", "keys", "size", "modified"])


def _listed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, keys, size, modified`` of the files in and below the paths, written once."""
    roots = spark.createDataFrame([(path, "") for path in paths], "path string, keys string").coalesce(1)
    first = written(roots.mapInArrow(lambda batches: _entries(batches, False), _ENTRY), "folders")
    folders = first.where("size is null").select("path", "keys").repartition(2 * spark.sparkContext.defaultParallelism)
    below = folders.mapInArrow(lambda batches: _entries(batches, True), _ENTRY)
    return written(first.where("size is not null").unionByName(below), "files")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files (path, size, modified) to their lines, some at a time and in order, with the names Spark has for them."""
    names = ["file_path", "file_name", "file_size", "modified", "lines"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.binary())]
    rows, held = [], 0

    def told():
        return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for path, size, modified in zip(*(column.to_pylist() for column in batch.columns)):
            with open(path, "rb") as file:
                lines = file.read().removeprefix(b"\xef\xbb\xbf").splitlines()
            uri = "file:" + _NOT_IN_URIS.sub(lambda c: "".join(f"%{b:02X}" for b in c[0].encode()), path)
            for begin in range(0, len(lines), _LINES):
                some = lines[begin:begin + _LINES]
                rows.append((uri, uri.rpartition("/")[2], size, modified, some))
                held += sum(map(len, some)) + 32 * len(some)
                if held >= SMALL:
                    yield told()
                    rows, held = [], 0
    if rows:
        yield told()


def file_lines(spark: SparkSession, paths: list[str], *facts: Column) -> DataFrame:
    """``<facts>, block, value`` for every line of the files: where its split begins, and its text.

    ``facts`` are computed from ``_metadata``. Lines of a file that have the same ``block`` lie in order, in one task.
    A folder's files, and those of its folders ``key=value``, are those that ``spark.read.text`` finds.
    """
    def by_spark(some: list[str], **options: str) -> DataFrame:
        return spark.read.options(**options).text(some).select(*facts, F.col("_metadata.file_block_start").alias("block"), "value")

    local = [local_path(spark, path) for path in paths]
    if not all(path and os.path.exists(path) and not _PATTERN.search(path) for path in local):
        return by_spark(paths)
    local = [os.path.abspath(path) for path in local]
    given = {*local}
    if len(given) < len(local) or any(str(above) in given for path in local for above in PurePath(path).parents):
        return by_spark(paths)  # files given twice are read as often as Spark reads them
    limit = min(SMALL, spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    small = (F.col("size") <= limit) & ~F.col("path").rlike(_COMPRESSED)
    files = _listed(spark, local)
    told = files.agg(
        F.min("keys").alias("keys"), F.max("keys").alias("other"), F.count_if(small).alias("small"),
        F.count_if(~small).alias("large"), F.sum(F.when(small, F.col("size") + _OPEN)).alias("work")).first()
    if told.keys != told.other or "?" in (told.keys or "") or (told.keys and len(paths) > 1):
        return by_spark(paths)  # folders of different depth or keys: Spark's rules tell which files count
    tasks = max(-(-(told.work or 0) // _TASK), min(-(-told.small // 32), 2 * spark.sparkContext.defaultParallelism), 1)
    read = files.where(small).select("path", "size", "modified").repartition(tasks).mapInArrow(
        _read, "file_path string, file_name string, file_size long, modified long, lines array<binary>")
    lines = read.select(
        F.struct("file_path", "file_name", "file_size", F.lit(0).cast("long").alias("file_block_start"),
                 F.col("file_size").alias("file_block_length"),
                 F.timestamp_millis("modified").alias("file_modification_time")).alias("_metadata"), "lines",
    ).select(*facts, F.lit(0).cast("long").alias("block"), F.explode("lines").alias("value"))
    lines = lines.withColumn("value", F.col("value").cast("string"))
    if not told.large:
        return lines
    large = [row.path for row in files.where(~small).select("path").collect()]
    return lines.unionByName(by_spark(large, __globPaths__="false"))
