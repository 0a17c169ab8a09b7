"""Choosing options of a dataset's titles, and the cells that belong to them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.periods import parse_period
from statloom.operators.keys import attach

ALL, LIST, LATEST, FROM = "ALL", "LIST", "LATEST", "FROM"

_LATEST = r"^USE_LATEST_DATETIME<(.*)>"
_FROM = r"^<(.*)>UNTIL_LATEST_DATETIME<(.*)>"


def parse_selection(text: Column) -> Column:
    """``struct<kind, fmt, start>`` of a selection text; ``kind`` is NULL for a text of no known form."""
    latest, start = text.rlike(_LATEST), text.rlike(_FROM)
    kind = F.when(text == ALL, ALL).when(latest, LATEST).when(start, FROM)
    fmt = F.when(latest, F.regexp_extract(text, _LATEST, 1)).when(start, F.regexp_extract(text, _FROM, 2))
    first = F.when(~latest & start, F.regexp_extract(text, _FROM, 1))
    return F.struct(kind.alias("kind"), fmt.alias("fmt"), first.alias("start"))


def label_options(cells: DataFrame, keys: list[str], titles: dict[str, str]) -> DataFrame:
    """Options of every title: the distinct non-blank values of its column. ``keys, title, option``.

    ``titles`` maps a title to its column.
    """
    pairs = F.array(*[
        F.struct(F.lit(title).alias("title"), F.col(column).cast("string").alias("option"))
        for title, column in titles.items()
    ])
    return (
        cells.select(*keys, F.explode(pairs).alias("pair"))
        .select(*keys, "pair.title", "pair.option")
        .where(F.col("option") != "")
        .distinct()
    )


def select_options(options: DataFrame, spec: DataFrame, formats: list[str]) -> DataFrame:
    """Chosen options: ``dataset, title, option`` rows of ``options`` that the specification takes.

    ``spec`` has ``dataset, title, kind, items, fmt, start``, one row per dataset and title. The
    periods of LATEST and FROM are read with the row's ``fmt``, one of ``formats``.
    """
    chosen = attach(options, spec, ["dataset", "title"], ["option"])

    def read(text):
        date = F.lit(None).cast("date")
        for fmt in formats:
            date = F.when(F.col("fmt") == fmt, parse_period(F.col(text), fmt)).otherwise(date)
        return date

    chosen = chosen.withColumn("_date", read("option"))
    newest = chosen.where(F.col("kind") == LATEST).groupBy("dataset", "title").agg(F.max("_date").alias("_date"))
    chosen = chosen.join(newest.withColumn("_newest", F.lit(True)), ["dataset", "title", "_date"], "left")
    taken = (
        (F.col("kind") == ALL)
        | ((F.col("kind") == LIST) & F.array_contains("items", F.col("option")))
        | ((F.col("kind") == FROM) & (F.col("_date") >= read("start")))
        | F.col("_newest")
    )
    return chosen.where(taken).select(options.columns)


def select_cells(cells: DataFrame, selection: str | dict, titles: dict[str, str],
                 keys: list[str] | None = None) -> DataFrame:
    """Cells inside a selection: ``'ALL'``, or a map from every title to

    - ``'ALL'``;
    - a list of options;
    - ``'USE_LATEST_DATETIME<fmt>'``, the latest period of each dataset in ``keys``;
    - ``'<start>UNTIL_LATEST_DATETIME<fmt>'``, periods from ``start`` on.

    ``titles`` maps a title to its column. Lists and starts become plain predicates that reach the
    scan; only the latest period needs a second look at the data.
    """
    if selection == ALL:
        return cells
    every, latest = cells, []
    for title, column in titles.items():
        wanted = selection[title]
        if isinstance(wanted, (list, tuple)):
            cells = cells.where(F.col(column).isin(*wanted))
        elif wanted != ALL:
            kind, fmt, start = _parse_text(wanted)
            if kind == FROM:
                start_date = parse_period(F.lit(start), fmt)
                cells = cells.where(parse_period(F.col(column), fmt) >= start_date)
            else:
                latest.append((column, fmt))
    # The latest period is that of the dataset, whatever else is selected.
    for column, fmt in latest:
        cells = latest_period(cells, keys or [], column, fmt, every)
    return cells


def latest_period(cells: DataFrame, keys: list[str], column: str, fmt: str, every: DataFrame | None = None) -> DataFrame:
    """Rows of each dataset's latest period among the rows of ``every`` (else of ``cells``)."""
    dated = cells.withColumn("_date", parse_period(F.col(column), fmt))
    among = (cells if every is None else every).select(*keys, parse_period(F.col(column), fmt).alias("_date"))
    newest = among.groupBy(*keys).agg(F.max("_date").alias("_date"))
    return dated.join(newest, [*keys, "_date"], "left_semi").select(cells.columns)


def _parse_text(text: str) -> tuple[str, str, str | None]:
    if match := re.match(_LATEST, text):
        return LATEST, match.group(1), None
    if match := re.match(_FROM, text):
        return FROM, match.group(2), match.group(1)
    raise ValueError(f"not a selection: {text}")


def catalogue(categories: DataFrame, groups: DataFrame, datasets: DataFrame) -> DataFrame:
    """``category, group, dataset`` with their places in document order.

    Inputs: ``category_id, category, category_pos``; ``group_id, category_id, group, group_pos``;
    ``group_id, dataset, dataset_pos``. A category with no group, or a group with no dataset, is kept.
    Datasets that stand directly under a category have no ``group_id`` but a ``category_id``, and get
    NULL for the group.
    """
    columns = ["category", "group", "dataset", "category_pos", "group_pos", "dataset_pos"]
    parents = categories.join(groups, "category_id", "left")
    listed = datasets.drop("category_id")
    # Inner join and empty parents apart: an outer join could not split a group with many datasets.
    entries = attach(listed, parents.where(F.col("group_id").isNotNull()), ["group_id"], ["dataset"]).select(columns)
    empty = parents.join(listed.select("group_id").distinct(), "group_id", "left_anti")
    entries = entries.unionByName(empty.select([c for c in columns if c in empty.columns]), allowMissingColumns=True)
    if "category_id" in datasets.columns:
        direct = datasets.where(F.col("group_id").isNull()).drop("group_id")
        direct = attach(direct, categories, ["category_id"], ["dataset"])
        entries = entries.unionByName(direct.select([c for c in columns if c in direct.columns]), allowMissingColumns=True)
    return entries


def find_in_catalogue(entries: DataFrame, category: str, group: str, dataset: str) -> DataFrame:
    """The first category, then its first group, then its first dataset that contains the given text.

    One row, or none when a level has no hit. The three levels are one order, so one pass finds it.
    """
    group_hit = F.coalesce(F.contains("group", F.lit(group)), F.lit(False))
    dataset_hit = F.coalesce(F.contains("dataset", F.lit(dataset)), F.lit(False))
    order = F.struct("category_pos", ~group_hit, "group_pos", ~dataset_hit, "dataset_pos")
    found = F.struct("category", "group", "dataset", (group_hit & dataset_hit).alias("hit"))
    best = entries.where(F.contains("category", F.lit(category))).agg(F.min_by(found, order).alias("best"))
    return best.where(F.col("best.hit")).select("best.category", "best.group", "best.dataset")


#: Letters of the longest parts of names that the lookup index holds.
GRAM = 3


def _grams(text: Column, sizes: list[int]) -> Column:
    """The distinct parts of a text of these lengths."""
    def parts(size):
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(size)))

    return F.array_distinct(F.concat(*map(parts, sizes)))


def first_hits(wanted: DataFrame, names: DataFrame, keys: list[str], position: str) -> DataFrame:
    """``keys, text, <position>, name``: for every wanted text the first name of its keys that contains it.

    ``wanted``: ``keys, text``; ``names``: ``keys, name, <position>``. Names are indexed by their parts of up to
    ``GRAM`` letters, and a text is looked up by the rarest of its own, so a name meets a text only if they share
    that part. An empty text is contained in every name, a missing one in none.
    """
    index = names.where(F.col("name").isNotNull()).select(
        *keys, "name", position, F.explode(F.concat(F.array(F.lit("")), _grams(F.col("name"), list(range(1, GRAM + 1))))).alias("gram"))
    spread_of = index.groupBy(*keys, "gram").agg(F.count(F.lit(1)).alias("names"))
    length = F.length("text")
    own = F.when(length == 0, F.array(F.lit("")))
    for n in range(1, GRAM + 1):
        own = own.when(F.lit(n == GRAM) | (length == n), _grams(F.col("text"), [n]))
    asked = wanted.where(F.col("text").isNotNull()).select(*keys, "text").distinct()
    # A part that stands in no name has no row there: such a text is in no name either.
    parts = asked.select(*keys, "text", F.explode(own).alias("gram")).join(spread_of, [*keys, "gram"], "left")
    rarest = parts.groupBy(*keys, "text").agg(F.min(F.struct(F.coalesce("names", F.lit(0)).alias("names"), "gram")).alias("rarest"))
    looked = rarest.where("rarest.names > 0").select(*keys, "text", F.col("rarest.gram").alias("gram"))
    hits = looked.join(index, [*keys, "gram"]).where(F.contains("name", F.col("text")))
    best = hits.groupBy(*keys, "text").agg(F.min(F.struct(position, "name")).alias("best"))
    return best.select(*keys, "text", f"best.{position}", "best.name")


def find_all_in_catalogue(entries: DataFrame, references: DataFrame) -> DataFrame:
    """``references`` with ``found_category, found_group, found_dataset`` for those that have a hit.

    ``references`` has ``category, group, dataset``, texts: as ``find_in_catalogue`` for every row, in one job.
    Each level is looked up once per different text, among the names below the hit of the level above.
    """
    levels = [("category", []), ("group", ["category_pos"]), ("dataset", ["category_pos", "group_pos"])]
    found = references.select([F.col(level).alias(f"_{level}") for level, _ in levels]).distinct()
    for level, keys in levels:
        names = entries.select(*keys, F.col(level).alias("name"), f"{level}_pos").distinct()
        hits = first_hits(found.select(*keys, F.col(f"_{level}").alias("text")), names, keys, f"{level}_pos")
        hits = hits.select(*keys, F.col("text").alias(f"_{level}"), f"{level}_pos", F.col("name").alias(f"found_{level}"))
        found = found.join(hits, [*keys, f"_{level}"])
    names = [level for level, _ in levels]
    found = found.select([F.col(f"_{n}").alias(n) for n in names] + [f"found_{n}" for n in names])
    return references.join(found, names)


def skip_names(rows: DataFrame, column: str, names: list[str]) -> DataFrame:
    """Rows whose name is none of ``names``; rows without a name stay."""
    return rows.where(F.coalesce(~F.col(column).isin(*names), F.lit(True)))


def catalogue_counts(entries: DataFrame) -> DataFrame:
    """Datasets per category and group."""
    return entries.groupBy("category", "group").agg(F.count("dataset").alias("datasets"))


def expand_points(rows: DataFrame, points: Column, *keep: str) -> DataFrame:
    """One row per point and meter of a ``map<point, array<meter>>``."""
    return (
        rows.select(*keep, F.explode(points).alias("point", "meters"))
        .select(*keep, "point", F.posexplode("meters").alias("meter_no", "meter"))
    )
