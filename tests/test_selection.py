import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from statloom.fixed_values import POINT_METERS
from statloom.operators import chunks, selection
from statloom.operators.keys import attach, numbered

TITLES = {"Sex": "sex", "Time": "period"}


@pytest.fixture(scope="module")
def cells(spark):
    rows = [(d, s, f"20{y}M{m:02d}") for d in ("a", "b") for s in ("m", "f") for y in (20, 21) for m in (1, 2, 11)
            if not (d == "b" and y == 21 and m > 1)]
    return spark.createDataFrame(rows, "dataset string, sex string, period string").cache()


def taken(frame):
    return sorted(map(tuple, frame.collect()))


def test_select_cells(cells):
    everything = taken(cells)
    assert taken(selection.select_cells(cells, "ALL", TITLES)) == everything
    assert taken(selection.select_cells(cells, {"Sex": ["m"], "Time": "ALL"}, TITLES)) == [r for r in everything if r[1] == "m"]
    latest = selection.select_cells(cells, {"Sex": "ALL", "Time": "USE_LATEST_DATETIME<%YM%m>"}, TITLES, ["dataset"])
    assert taken(latest) == [r for r in everything if r[2] == {"a": "2021M11", "b": "2021M01"}[r[0]]]
    of_all = selection.select_cells(cells, {"Sex": "ALL", "Time": "USE_LATEST_DATETIME<%YM%m>"}, TITLES)
    assert {r[0] for r in taken(of_all)} == {"a"}
    later = selection.select_cells(cells, {"Sex": "ALL", "Time": "<2020M11>UNTIL_LATEST_DATETIME<%YM%m>"}, TITLES)
    assert taken(later) == [r for r in everything if r[2] >= "2020M11"]


def test_unknown_selection(cells):
    with pytest.raises(ValueError):
        selection.select_cells(cells, {"Sex": "male", "Time": "ALL"}, TITLES)
    with pytest.raises(KeyError):
        selection.select_cells(cells, {"Sex": "ALL"}, TITLES)


def test_lists_reach_the_scan(spark, tmp_path, cells):
    cells.write.parquet(str(tmp_path / "cells"))
    chosen = selection.select_cells(spark.read.parquet(str(tmp_path / "cells")), {"Sex": ["m"], "Time": "ALL"}, TITLES)
    plan = chosen.select("dataset")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(sex,m)" in plan and "period" not in plan.split("ReadSchema")[1]


def test_budget_and_chunks(spark):
    options = spark.createDataFrame(
        [("x", "A", str(i)) for i in range(100)] + [("x", "B", str(i)) for i in range(50)]
        + [("x", "Time", str(i)) for i in range(24)] + [("y", "Time", "1")],
        "dataset string, title string, option string",
    )
    budget = chunks.cell_budget(options)
    assert taken(budget) == [("x", 120_000, 3), ("y", 1, 1)]
    times = options.where("title = 'Time'").select("dataset", F.col("option").cast("int").alias("place"))
    for block in (None, F.col("place"), F.floor(F.col("place") / 5)):
        sizes = chunks.assign_chunks(times, budget, "place", block).groupBy("dataset", "chunk").agg(
            F.count("*"), F.min("place")).collect()
        assert sorted(map(tuple, sizes)) == [("x", 0, 8, 0), ("x", 1, 8, 8), ("x", 2, 8, 16), ("y", 0, 1, 1)]


def test_trailing_chunks_stay_empty(spark):
    periods = spark.createDataFrame([("x", i) for i in range(5)], "dataset string, place int")
    budget = spark.createDataFrame([("x", 4)], "dataset string, chunks bigint")
    sizes = chunks.assign_chunks(periods, budget, "place").groupBy("chunk").count().collect()
    assert sorted(map(tuple, sizes)) == [(0, 2), (1, 2), (2, 1)]


def test_split_title_is_required(spark):
    options = spark.createDataFrame([("x", "Time", "1"), ("y", "A", "1"), ("y", "A", "2")],
                                    "dataset string, title string, option string")
    assert taken(chunks.cell_budget(options)) == [("x", 1, 1), ("y", 2, 1)]
    with pytest.raises(PySparkException, match="no title Time in dataset y"):
        chunks.cell_budget(options, 1).collect()


def test_numbered_with_a_hot_key(spark):
    """One key holds most rows; the numbers are those of a plain sort."""
    rng = random.Random(1)
    rows = [("hot", p) for p in rng.sample(range(100_000), 3000)] + [(f"k{i % 50}", i) for i in range(1000)]
    frame = spark.createDataFrame(rows, "k string, p int")
    found = numbered(frame, ["k"], F.col("p"), F.floor(F.col("p") / 777), "n").collect()
    expected = {}
    for k, p in sorted(rows):
        expected[k, p] = sum(1 for key, _ in expected if key == k) if k != "hot" else None
    places = {p: i for i, p in enumerate(sorted(p for k, p in rows if k == "hot"))}
    assert {(r.k, r.p): r.n for r in found} == {
        key: places[key[1]] if key[0] == "hot" else n for key, n in expected.items()
    }


def test_attach_with_a_hot_key(spark):
    """The rows of a hot key go to several tasks."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
        facts = rows.select("k").distinct().withColumn("fact", F.length("k"))
        joined = attach(rows, facts, ["k"], ["id"], salts=8)
        assert joined.count() == 20_000
        assert joined.where(F.col("fact") != F.length("k")).count() == 0
        hot = joined.where("k = 'hot'").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(hot) > 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_latest_period_of_the_whole_dataset(spark):
    cells = spark.createDataFrame([("F", "2020M01", "2020M01"), ("O", "2020M02", "2020M01"), ("F", "2020M02", "2019M12")], "s string, t string, u string")
    titles, latest = {"Status": "s", "Time": "t", "Seen": "u"}, "USE_LATEST_DATETIME<%YM%m>"
    kept = selection.select_cells(cells, {"Status": ["F"], "Time": latest, "Seen": "ALL"}, titles)
    assert [tuple(r) for r in kept.collect()] == [("F", "2020M02", "2019M12")]
    kept = selection.select_cells(cells, {"Status": "ALL", "Time": latest, "Seen": latest}, titles)
    assert [tuple(r) for r in kept.collect()] == [("O", "2020M02", "2020M01")]


def test_names_that_are_null_are_not_skipped(spark):
    rows = spark.createDataFrame([("a",), (None,)], "n string")
    assert [r.n for r in selection.skip_names(rows, "n", ["a"]).collect()] == [None]


def test_first_difference(spark):
    left = spark.createDataFrame([("f", i, line) for i, line in enumerate([",a", ",b", ",,", "2021,1", "2020,2"])],
                                 "file string, pos int, line string")
    right = left.withColumn("line", F.when(F.col("pos") >= 3, "2019,3").otherwise(F.col("line")))
    assert taken(chunks.first_difference(left, right, ["file"], "pos", "line")) == [("f", 3)]
    assert taken(chunks.first_difference(left, left, ["file"], "pos", "line")) == []
    with pytest.raises(PySparkException, match="identical: f"):
        chunks.first_difference(left, left, ["file"], "pos", "line", required=True).collect()


def test_catalogue(spark):
    categories = spark.createDataFrame([(1, "Work", 0), (2, "Tourism", 1), (3, "Empty", 2)],
                                       "category_id int, category string, category_pos int")
    groups = spark.createDataFrame([(1, 1, "Survey W", 0), (2, 2, "Survey T", 0), (3, 2, "Skipped", 1)],
                                   "group_id int, category_id int, `group` string, group_pos int")
    datasets = spark.createDataFrame([(2, "By month", 1), (2, "By month and sex", 0), (3, "Other", 0)],
                                     "group_id int, dataset string, dataset_pos int")
    entries = selection.catalogue(categories, groups, datasets)
    assert entries.count() == 5
    find = selection.find_in_catalogue
    # The group is looked up inside the category, and the first hit in document order wins.
    assert taken(find(entries, "Tour", "Survey", "month")) == [("Tourism", "Survey T", "By month and sex")]
    assert taken(find(entries, "Work", "Survey", "month")) == []
    assert taken(find(entries, "Nope", "Survey", "month")) == []
    assert selection.skip_names(entries, "group", ["Skipped"]).where("dataset = 'Other'").count() == 0
    counts = {(r.category, r.group): r.datasets for r in selection.catalogue_counts(entries).collect()}
    assert counts == {("Work", "Survey W"): 0, ("Tourism", "Survey T"): 2, ("Tourism", "Skipped"): 1, ("Empty", None): 0}


def test_dataset_without_a_group(spark):
    categories = spark.createDataFrame([(1, "Work", 0)], "category_id int, category string, category_pos int")
    groups = spark.createDataFrame([(1, 1, "G", 0)], "group_id int, category_id int, `group` string, group_pos int")
    datasets = spark.createDataFrame([(1, 1, "in", 0), (None, 1, "direct", 1)],
                                     "group_id int, category_id int, dataset string, dataset_pos int")
    entries = selection.catalogue(categories, groups, datasets).select("category", "group", "dataset")
    assert set(map(tuple, entries.collect())) == {("Work", "G", "in"), ("Work", None, "direct")}


def test_points(spark):
    points = F.create_map(*[x for point, meters in POINT_METERS.items()
                            for x in (F.lit(point), F.array(*map(F.lit, meters)))])
    rows = selection.expand_points(spark.range(1), points, "id").collect()
    assert len(rows) == 23 and len({r.point for r in rows}) == 15
    assert [(r.meter_no, r.meter) for r in rows if r.point == "LCF20011"] == [(0, "20021"), (1, "20022")]


def test_lookup_of_many_references(spark):
    """Every reference against the lookup of one."""
    rng = random.Random(8)
    names = ["Income", "Income, by sex", "Work", "Work and income", "", None, "aaa", "aaaa", "Prices (CPI)", "é"]
    entries = [(rng.choice(names[:4]), rng.choice(names), rng.choice(names), c, g, d) for c in range(3) for g in range(4) for d in range(4)]
    categories = {e[3]: e[0] for e in entries}
    groups = {(e[3], e[4]): e[1] for e in entries}
    entries = [(categories[c], groups[c, g], name, c, g, d) for _, _, name, c, g, d in entries]
    frame = spark.createDataFrame(
        entries, "category string, group string, dataset string, category_pos int, group_pos int, dataset_pos int")
    texts = ["", "I", "In", "Inc", "income", "Work", "aaa", "aaaa", "aaaaa", "(C", "é", "zz", "ork and i", None]
    references = [(k, rng.choice(texts), rng.choice(texts), rng.choice(texts)) for k in range(80)] + [(0, "I", "", ""), (99, "Work", "", "In")]
    made = selection.find_all_in_catalogue(frame, spark.createDataFrame(references, "k int, category string, group string, dataset string"))
    found = sorted((r.k, r.category, r.group, r.dataset, r.found_category, r.found_group, r.found_dataset) for r in made.collect())

    def first(rows, level, text):
        hits = [e for e in sorted(rows, key=lambda e: e[level + 3]) if text is not None and e[level] is not None and text in e[level]]
        return [e for e in rows if hits and e[level + 3] == hits[0][level + 3]]

    expected = []
    for k, *texts in references:
        rows = entries
        for level, text in enumerate(texts):
            rows = first(rows, level, text)
        if rows:
            expected.append((k, *texts, *rows[0][:3]))
    assert found == sorted(expected) and len(found) > 5
