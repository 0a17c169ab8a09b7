"""Comparing two copies of many datasets in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _both_sides(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Every distinct row with its number of copies on each side; NULL equals NULL.

    The shuffle is on the whole row, after counting copies where they lie: neither a large dataset
    nor a row with many copies meets in one task.
    """
    def side(rows, a, b):
        return rows.select(*columns, F.lit(a).alias("_a"), F.lit(b).alias("_b"))

    both = side(left, 1, 0).unionByName(side(right, 0, 1))
    return both.groupBy(*columns).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left``, cut to the columns of ``right``, that ``right`` has not."""
    columns = right.columns
    return _both_sides(left, right, columns).where((F.col("_a") > 0) & (F.col("_b") == 0)).select(columns)


def row_differences(left: DataFrame, right: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows whose number of copies differs: the row, the ``side`` with more of it, ``copies`` more."""
    columns = right.columns if columns is None else columns
    surplus = F.col("_a") - F.col("_b")
    return (
        _both_sides(left, right, columns)
        .where(surplus != 0)
        .select(*columns, F.when(surplus > 0, "left").otherwise("right").alias("side"), F.abs(surplus).alias("copies"))
    )


def verdicts(left: DataFrame, right: DataFrame, key: str = "dataset") -> DataFrame:
    """``key, left_rows, right_rows, missing, equivalent`` per dataset that either side has.

    Equivalent: as many rows on both sides, and every row of ``left`` somewhere in ``right``. Rows
    that occur more than once can hide a difference; ``row_differences`` shows those too.
    """
    missing = F.sum(F.when((F.col("_a") > 0) & (F.col("_b") == 0), 1).otherwise(0))
    return (
        _both_sides(left, right, right.columns)
        .groupBy(key)
        .agg(F.sum("_a").alias("left_rows"), F.sum("_b").alias("right_rows"), missing.alias("missing"))
        .withColumn("equivalent", (F.col("left_rows") == F.col("right_rows")) & (F.col("missing") == 0))
    )


def fingerprints(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``keys, rows, prints`` per key: the number of its rows and sums of hashes of them, whatever their order.

    Aggregated where the rows lie, so the shuffle gets one row per task and key. Rows that are the same have the
    same 128 bits, NULL equal to NULL; sums of their four parts are exact, for up to two billion rows of a key (more
    end the job). Keys with the same rows, each as often, have the same fingerprint; others with the probability of
    128 random bits.
    """
    def exact(name):
        if name in arrays:  # the hash of an array passes over its NULLs, the joined text tells where they are
            return [F.size(name), F.col(name), F.array_join(name, "\x1f", "\x00")]
        return [F.isnull(name), F.col(name)]

    kinds = dict(rows.dtypes)
    arrays = [name for name in columns if kinds[name] == "array<string>"]
    values = [value for name in columns for value in exact(name)]
    one, two = F.xxhash64(*values), F.xxhash64(F.lit(1), *reversed(values))
    parts = [F.sum(part) for h in ("_one", "_two") for part in (F.col(h).bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(h, 32))]
    hashed = rows.select(*keys, one.alias("_one"), two.alias("_two"))
    return hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.array(*parts).alias("prints"))


def column_uses(table: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Number of non-NULL values of every column, over the table or per key: one aggregation."""
    counted = [F.count(F.col(name)).alias(name) for name in table.columns if name not in (keys or [])]
    return table.groupBy(*keys).agg(*counted) if keys else table.agg(*counted)


def drop_null_columns(table: DataFrame) -> DataFrame:
    """The table without the columns that hold no value at all. Runs one aggregation."""
    used = column_uses(table).first()
    return table.select(*[name for name in table.columns if used[name] > 0])


def file_column_uses(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``column_uses`` of Parquet files: of plain columns from the files' footers, without reading a value; of
    nested ones, whose footers tell of their elements, by a scan of these columns alone.

    Files without the number of NULLs in their footers end the job.
    """
    # A session of its own, since only the newer reader hands counts down and the caller's settings stay.
    apart = spark.newSession()
    apart.conf.set("spark.sql.sources.useV1SourceList", "")
    apart.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    paths = [path] if isinstance(path, str) else path
    table = apart.read.parquet(*paths)
    nested = [f.name for f in table.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    plain = column_uses(table.drop(*nested))
    if not nested:
        return plain
    scanned = column_uses(spark.read.parquet(*paths).select(*nested))
    one = F.lit(1).alias("_one")  # one row on either side
    return plain.select("*", one).join(scanned.select("*", one), "_one").select(table.columns)


def read_used_columns(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet files without the columns that hold no value at all, as ``file_column_uses`` tells."""
    used = file_column_uses(spark, path).first()
    table = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return table.select(*[name for name in table.columns if used[name] > 0])


def label_levels(table: DataFrame, keys: list[str]) -> DataFrame:
    """Number of ``Label*`` columns that hold a value, per key."""
    labels = [name for name in table.columns if name.startswith("Label") and name[5:].isdigit()]
    uses = column_uses(table.select(*keys, *labels), keys)
    levels = sum((F.when(F.col(name) > 0, 1).otherwise(0) for name in labels), F.lit(0))
    return uses.select(*keys, levels.cast("int").alias("levels"))
