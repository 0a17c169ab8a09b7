"""CSV files of any width, several in one job, read as records that know their file's header lines.

Files of every size are read in splits, by one path, and once: opening a small file costs more than reading it, so
the lines are kept in the shared folder, with their files and places. A first scan looks at each split, when the
reader is called: its lines up to the first body line, and whether its quotes are even. A second one takes the body
and is joined with what the header of its file says.

A quoted cell may hold line breaks. Where a file has a line with an odd number of quotes, the quotes of the
splits before a split tell whether it begins inside a cell, and those of the lines before a line whether that
line does. So the lines of every record are known without reading the file from its beginning, and its records
go the way the lines of the other files go.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statloom.session import written
from statloom.sources.small_files import file_lines

# Characters of a body line that its file's facts may look at.
FIRST_CHARACTERS = 200
# One field behind its comma. Possessive, so that a long quoted cell needs no backtracking stack.
_FIELD = r',("[^"]*+(?:""[^"]*+)*+"|[^,]*+)'
_QUOTED_FIELD = r',\s*"[^"]*+(?:""[^"]*+)*+"\s*(?=,|\z)'
_BLANK_LINE = r'^[\s,"]*$'


def _odd(line: Column) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 != 0


def _open_quote(line: Column) -> Column:
    return F.raise_error(F.concat(F.lit("quote not closed within the line: "), F.substring(line, 1, 80)))


def csv_fields(line: Column) -> Column:
    """Fields of one CSV record, trimmed; blank and ``NA`` are NULL. A record with an open quote is an error."""
    checked = F.when(_odd(line), _open_quote(line)).otherwise(line)
    raw = F.regexp_extract_all(F.concat(F.lit(","), checked), F.lit(_FIELD), F.lit(1))

    unquoted = F.transform(raw, _unquoted)
    return F.transform(unquoted, lambda x: F.when(~x.isin("", "NA"), x))


def _unquoted(field: Column) -> Column:
    inner = F.substring(field, F.lit(2), F.length(field) - 2)
    return F.trim(
        F.when(F.startswith(field, F.lit('"')), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(field)
    )


def _lines(spark: SparkSession, paths: list[str], dataset: Column | None) -> DataFrame:
    file = F.col("_metadata.file_name")
    name = F.regexp_replace(file, r"\.(csv|txt)$", "") if dataset is None else dataset
    return file_lines(spark, paths, F.col("_metadata.file_path").alias("file"), name.alias("dataset")).select(
        "file", "dataset", F.struct("block", F.monotonically_increasing_id().alias("line")).alias("row_pos"),
        F.regexp_replace("value", "^\uFEFF|\r$", "").alias("line"))


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, block, id, line, body, odd), in order, to one row per split, or piece of one in a task:

    its place, its lines before its own first body line, that line, and the number of lines with an odd number of
    quotes. What lies behind is counted, not kept.
    """
    names = ["file", "block", "id", "top", "first_line", "odd"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.int64()]
    split, place, top, first, odd = None, None, [], None, 0

    def told():
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((*split, place, top, first, odd), kinds)], names=names)

    for batch in batches:
        file, block, ids, line, body, odds = batch.columns
        file = file.dictionary_encode()
        code, block = file.indices.to_numpy(), block.to_numpy()
        cuts = np.flatnonzero((code[1:] != code[:-1]) | (block[1:] != block[:-1])) + 1 if len(code) else []
        bodies, odds = body.to_numpy(zero_copy_only=False), odds.to_numpy(zero_copy_only=False)
        for begin, end in zip([0, *cuts], [*cuts, len(code)]):
            if begin == end:
                continue
            here = file[begin].as_py(), int(block[begin])
            if here != split:
                if split is not None:
                    yield told()
                split, place, top, first, odd = here, ids[begin].as_py(), [], None, 0
            odd += int(odds[begin:end].sum())
            if first is None:
                found = np.flatnonzero(bodies[begin:end])
                stop = begin + int(found[0]) if len(found) else end
                top.extend(line.slice(begin, stop - begin).to_pylist())
                first = line[stop].as_py() if len(found) else None
    if split is not None:
        yield told()


def _splits(lines: DataFrame, is_body: Callable[[Column], Column]) -> DataFrame:
    """``file, block, id, top, first_line, odd`` per split or piece of one, written once."""
    body = is_body(F.col("line"))
    shown = F.when(body, F.substring("line", 1, FIRST_CHARACTERS)).otherwise(F.col("line"))
    looked = lines.select("file", F.col("row_pos.block").alias("block"), F.col("row_pos.line").alias("id"), shown.alias("line"), body.alias("body"), _odd(F.col("line")).alias("odd"))
    return written(looked.mapInArrow(_tops, "file string, block long, id long, top array<string>, first_line string, odd long"), "splits")


def _no_body(file: Column) -> Column:
    return F.raise_error(F.concat(F.lit("no body line behind the header lines of "), file))


def _file_facts(splits: DataFrame, facts: dict[str, Column], body_required: bool) -> DataFrame:
    """``file, _top, <facts>`` of files with a body: the lines before it, and what the header lines say.

    Only splits up to the first body line of their file are looked at, so a header may be longer than a split.
    """
    # One row per split of a file, or piece of one.
    place = F.struct("block", "id")
    begin = F.min(F.when(F.col("first_line").isNotNull(), place)).over(Window.partitionBy("file"))
    heads = splits.withColumn("begin", begin).where(F.col("begin").isNull() | (place <= F.col("begin")))
    heads = heads.groupBy("file").agg(
        F.max("first_line").alias("first_line"),
        F.array_sort(F.collect_list(F.when(F.col("begin").isNotNull(), F.struct("block", "id", "top")))).alias("tops"))
    heads = heads.withColumn("_top", F.flatten(F.transform("tops", lambda t: t["top"])))
    none = F.isnull(_no_body(F.col("file"))) if body_required else F.lit(False)
    return heads.where(F.when(F.col("first_line").isNull(), none).otherwise(True)).select(
        "file", "first_line", "_top", F.filter("_top", lambda x: ~x.rlike(_BLANK_LINE)).alias("header"),
    ).select("file", "_top", *[value.alias(name) for name, value in facts.items()])


def _fact_bytes() -> Column:
    """About the bytes of what a split says of its file: a label of a column takes many times its text."""
    return F.length("file") + 16 * F.length(F.array_join("top", "")) + 200


def _of_size(table: DataFrame, small: bool) -> DataFrame:
    """A table of files for a join. Spark takes the packed bytes of its file for its size, tens of times too few."""
    return table if small else table.hint("merge")


def _body(records: DataFrame, splits: DataFrame, facts: dict[str, Column], body_required: bool, small: bool) -> DataFrame:
    # A file with most of the lines is split by adaptive execution; facts that are small are broadcast.
    joined = records.join(_of_size(_file_facts(splits, facts, body_required), small), "file")
    header = F.array_contains("_top", F.col("line"))
    # Header lines are NULL before they go: what is asked of the cells later may be asked in the join.
    return joined.withColumn("line", F.when(~header, F.col("line"))).where(~header).select(
        "file", "dataset", *facts, "row_pos", "line")


def _quoted_records(lines: DataFrame, splits: DataFrame, small: bool) -> DataFrame:
    """The records of files in which a line has an odd number of quotes, as lines with line breaks inside."""
    every = Window.partitionBy("file")
    before = every.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.groupBy("file", "block").agg(F.sum("odd").alias("odd"))
    splits = splits.withColumn("quoted", F.max("odd").over(every) > 0).where("quoted").select(
        "file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("open"))
    place = ["file", "block"]
    above = Window.partitionBy(*place).orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*place).orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.select("file", "dataset", F.col("row_pos.block").alias("block"), F.col("row_pos.line").alias("id"), "line")
    marked = marked.join(_of_size(splits, small), place).withColumn(
        "inside", (F.col("open") + F.coalesce(F.sum(_odd(F.col("line")).cast("long")).over(above), F.lit(0))) % 2 == 1)
    marked = written(marked.withColumn("number", F.sum(F.when(F.col("inside"), 0).otherwise(1)).over(upto)), "quoted-lines")
    # The lines that end a record begun in an earlier split belong to the last record begun there.
    begun = marked.groupBy(*place).agg(F.max("number").alias("begun"))
    carried = F.last(F.when(F.col("begun") > 0, F.struct("block", F.col("begun").alias("number"))), True).over(before)
    begun = begun.select(*place, carried.alias("carried"))
    record = F.when(F.col("number") > 0, F.struct("block", "number")).otherwise(F.col("carried"))
    part = F.struct("block", "id", "line")
    records = marked.join(_of_size(begun, small), place).groupBy("file", "dataset", record.alias("record")).agg(
        F.array_sort(F.collect_list(part)).alias("parts"))
    line = F.array_join(F.transform("parts", lambda x: x["line"]), "\n")
    stray = F.contains(F.regexp_replace(F.concat(F.lit(","), line), _QUOTED_FIELD, ","), F.lit("\n"))
    records = records.select("file", "dataset", F.struct(F.col("record.block").alias("block"), F.col("record.number").cast("long").alias("line")).alias("row_pos"),
                             F.when(stray, _open_quote(line)).otherwise(line).alias("line"))
    return written(records.where(F.col("line") != ""), "records")


def read_csv_lines(
    spark: SparkSession,
    paths: str | list[str],
    is_body: Callable[[Column], Column],
    facts: dict[str, Column],
    dataset: Column | None = None,
    body_required: bool = False,
) -> DataFrame:
    """``file, dataset, <facts>, row_pos struct<block, line>, line`` for every record of the body.

    ``is_body`` tells body lines from header lines; everything behind a file's first body line belongs to
    the body, but for repeats of its header lines and lines without a character. ``facts`` are computed once
    per file from ``header`` (array of lines) and ``first_line`` (the beginning of the first body line).
    ``dataset`` is computed from ``_metadata`` (the file name by default). A file with lines but no body line
    is an error if ``body_required``. Line breaks inside quoted cells are read as ``\\n``, at every size of
    file and split; a quote that is not closed is an error. ``row_pos`` tells the records of a file apart.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = written(_lines(spark, paths, dataset), "lines")
    lines, splits = raw.where(F.col("line") != ""), _splits(raw.where(F.col("line") != ""), is_body)
    told = splits.agg(F.max("odd").alias("odd"), F.sum(_fact_bytes()).alias("bytes")).first()
    small = (told.bytes or 0) <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if not told.odd:
        return _body(lines, splits, facts, body_required, small)
    quoted = _of_size(splits.where("odd > 0").select("file").distinct(), small)
    plain = _body(lines.join(quoted, "file", "left_anti"), splits.join(quoted, "file", "left_anti"), facts, body_required, small)
    records = _quoted_records(raw, splits, small)
    sorted_records = records.repartition("file", "row_pos.block").sortWithinPartitions("file", "row_pos")
    return plain.unionByName(_body(records, _splits(sorted_records, is_body), facts, body_required, small))


def has_line_breaks(spark: SparkSession, paths: str | list[str]) -> bool:
    """Whether a line of the files has an odd number of quotes."""
    return not spark.read.text(paths).where(_odd(F.col("value"))).isEmpty()
