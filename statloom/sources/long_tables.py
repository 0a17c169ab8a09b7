"""API long tables: known column types, any subset of the columns in a file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.fixed_values import API_COLUMN_TYPES, MAX_LABEL_LEVELS
from statloom.sources.csv_text import csv_fields, has_line_breaks, read_csv_lines


def read_long(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files that share one header: one CSV scan with an explicit schema.

    Only the first line is read to find the columns. A file whose header differs is an error
    (``enforceSchema`` off), and a column with no known type is one too. Files with line breaks inside
    quoted cells go the way of ``read_long_mixed``, so they are split like any other.
    """
    first = spark.read.text(path).where(F.trim("value") != "").limit(1)
    row = first.select(csv_fields(F.regexp_replace("value", r"^\uFEFF|\r$", "")).alias("names")).first()
    if row is None:
        raise ValueError(f"no header line in {path}")
    unknown = [name for name in row.names if name not in API_COLUMN_TYPES]
    if unknown:
        raise ValueError(f"columns without a known type: {unknown}")
    if has_line_breaks(spark, path):
        return read_long_mixed(spark, path).select(*row.names)
    schema = ", ".join(f"{name} {API_COLUMN_TYPES[name]}" for name in row.names)
    table = (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=False, nullValue="NA", mode="FAILFAST", escape='"',
                 ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
        .csv(path)
    )
    # A quoted blank is an empty string to the CSV reader and missing to us.
    return table.select(*[
        F.nullif(F.col(name), F.lit("")).alias(name) if API_COLUMN_TYPES[name] == "string" else name
        for name in row.names
    ])


def read_long_mixed(
    spark: SparkSession,
    paths: str | list[str],
    dataset: Column | None = None,
) -> DataFrame:
    """Files with different subsets of the columns in one job: ``dataset``, then every known column."""
    head = r"^\s*\"?(" + "|".join(API_COLUMN_TYPES) + r")\"?\s*(,|$)"
    names = csv_fields(F.get("header", F.lit(0)))
    known = F.array(*map(F.lit, API_COLUMN_TYPES))
    checked = F.when((F.size("header") == 1) & (F.size(F.array_except(names, known)) == 0), names).otherwise(
        F.raise_error(F.concat(F.lit("not one header line of known columns: "), F.coalesce(
            F.array_join("header", " | "), F.lit("")), F.lit(" before "), F.substring("first_line", 1, 80)))
    )
    # Where a column stands is a fact of the file; NULL where it has no such column.
    places = F.transform(F.array(checked), lambda names: F.struct(*(
        F.nullif(F.array_position(names, F.lit(name)), F.lit(0)).cast("int").alias(name) for name in API_COLUMN_TYPES)))
    facts = {"places": F.get(places, F.lit(0))}
    lines = read_csv_lines(spark, paths, lambda line: ~line.rlike(head), facts, dataset)
    fields = lines.select("dataset", "places", csv_fields(F.col("line")).alias("fields"))

    def named(name):
        return F.get("fields", F.col(f"places.{name}") - 1).cast(API_COLUMN_TYPES[name]).alias(name)

    return fields.select("dataset", *[named(name) for name in API_COLUMN_TYPES])


def labels_array(table: DataFrame, levels: int = MAX_LABEL_LEVELS) -> Column:
    """Labels of an API table as one array, without the levels a row leaves empty at the end."""
    present = [F.col(f"Label{i}") for i in range(1, levels + 1) if f"Label{i}" in table.columns]
    used = F.lit(0)
    for count, label in enumerate(present, 1):
        used = F.when(label.isNotNull(), count).otherwise(used)
    return F.slice(F.array(*present).cast("array<string>"), F.lit(1), used)


def trim_labels(labels: Column) -> Column:
    """Drop missing labels at the end, so that tables with unused levels compare equal."""
    used = F.array_max(F.transform(labels, lambda x, i: F.when(x.isNotNull(), i + 1).otherwise(0)))
    cut = F.slice(labels, F.lit(1), F.coalesce(used, F.lit(0)))
    return F.when(F.try_element_at(labels, F.lit(-1)).isNotNull(), labels).otherwise(cut)
