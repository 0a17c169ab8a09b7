import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from statloom.operators import compare, history, reshape, series
from statloom.plans import reconcile
from statloom.sinks import files

SCHEMA = "dataset string, label string, value double"


def random_rows(seed):
    """One dataset and one row hold a third of everything."""
    rng = random.Random(seed)
    pick = lambda: ("hot", "x", 1.0) if rng.random() < 0.34 else (
        rng.choice(["hot", "a", "b", "c"]), rng.choice(["x", "y", None]), rng.choice([1.0, 0.1, None, -0.0, 0.0]))
    return [pick() for _ in range(200)]


def norm(row):
    return tuple(0.0 if v == 0 else v for v in row)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    left, right = random_rows(seed), [r for r in random_rows(seed + 10) if r[0] != "c"]
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    ca, cb = Counter(map(norm, left)), Counter(map(norm, right))
    assert {norm(r) for r in compare.set_difference(a, b).collect()} == set(ca) - set(cb)
    found = {(norm(r[:3]), r.side, r.copies) for r in compare.row_differences(a, b).collect()}
    assert found == {(k, "left" if ca[k] > cb[k] else "right", abs(ca[k] - cb[k])) for k in ca | cb if ca[k] != cb[k]}
    verdicts = {r.dataset: r.equivalent for r in compare.verdicts(a, b).collect()}
    for name, equivalent in verdicts.items():
        x, y = ({k: n for k, n in c.items() if k[0] == name} for c in (ca, cb))
        assert equivalent == (sum(x.values()) == sum(y.values()) and not set(x) - set(y))


def test_same_is_equivalent(spark):
    rows = spark.createDataFrame(random_rows(7), SCHEMA)
    assert all(r.equivalent for r in compare.verdicts(rows, rows).collect())
    changed = rows.withColumn("value", F.when(F.col("dataset") == "a", 5.5).otherwise(F.col("value")))
    assert {r.dataset for r in compare.verdicts(rows, changed).collect() if not r.equivalent} == {"a"}


def test_null_columns(spark):
    rows = spark.createDataFrame([(1, None, "x", None), (2, None, None, None)],
                                 "id int, Label1 string, Label2 string, Label3 string")
    assert compare.drop_null_columns(rows).columns == ["id", "Label2"]
    levels = {r.id: r.levels for r in compare.label_levels(rows, ["id"]).collect()}
    assert levels == {1: 1, 2: 0}


def test_wide_and_back(spark):
    rows = [(d, p, k, f"{d}{p}{k}") for d in "ab" for p in "12" for k in ("x__y", "x__z") if (d, p, k) != ("a", "1", "x__z")]
    long = spark.createDataFrame(rows, "dataset string, period string, label string, cell string")
    wide = reshape.long_to_wide(long, ["dataset", "period"], "label", ["x__y", "x__z"], "cell")
    back = reshape.wide_to_long(wide, ["dataset", "period"])
    assert sorted(tuple(r) for r in back.where("cell is not null").collect()) == sorted(rows)
    assert back.count() == 8  # the missing one is kept as NULL
    pruned = reshape.wide_to_long(wide, ["dataset", "period"], ["x__y"])
    assert pruned.select("label").distinct().collect()[0].label == "x__y"


def test_fill_labels(spark):
    row = spark.range(1).select(reshape.fill_labels(F.array(
        F.lit(None).cast("string"), F.lit("a"), F.lit(None), F.lit(None), F.lit("b"), F.lit(None))).alias("x")).first()
    assert row.x == [None, "a", "a", "a", "b", "b"]


def test_merge_series(spark):
    a = spark.createDataFrame([("01/01/2021", "N", 1), ("01/02/2021", "N", 2)], "Month string, Port string, v int")
    b = spark.createDataFrame([("01/01/2021", "N", 5), ("01/01/2021", "T", 6)], "Month string, Port string, v int")
    merged = series.merge_series({"Exports": a, "Imports": b}, ["Month", "Port"])
    assert merged.columns == ["Month", "Port", "Exports_v", "Imports_v"]
    assert [tuple(r) for r in merged.collect()] == [("01/01/2021", "N", 1, 5)]


def test_documents(spark):
    entries = spark.createDataFrame([("c", 'g"', f"d{i}", i) for i in range(5)] + [("c", "empty", None, None)],
                                    "category string, `group` string, dataset string, dataset_pos int")
    entries = entries.union(entries.sparkSession.createDataFrame(
        [("bare", None, None, None), ("direct", None, "d", 0)], entries.schema))
    found = {(r.category, r.group, r.part): r.json for r in files.tree_documents(entries, 3).collect()}
    assert found == {
        ("c", 'g"', 0): '{"c":{"g\\"":["d0","d1","d2"]}}', ("c", 'g"', 1): '{"c":{"g\\"":["d3","d4"]}}',
        ("c", "empty", 0): '{"c":{"empty":[]}}', ("bare", None, 0): '{"bare":{}}', ("direct", None, 0): '{"direct":{}}',
    }


def test_one_folder_per_key(spark, tmp_path):
    rows = spark.range(1000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("k"), "id")
    files.write_by_key(rows, "k", str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {"k=hot", "k=cold"}
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.groupBy("k").count().collect().__len__() == 2 and back.count() == 1000
    texts = spark.createDataFrame([("a", "one"), ("b", "two")], "k string, t string")
    files.write_text(texts, "t", str(tmp_path / "text"), "k")
    assert spark.read.text(str(tmp_path / "text")).where("k = 'a'").first().value == "one"


def test_unlisted_labels_are_an_error(spark):
    long = spark.createDataFrame([("d", "a", "1"), ("d", "b", "2")], "dataset string, label string, cell string")
    with pytest.raises(Exception, match="label is not listed: b"):
        reshape.long_to_wide(long, ["dataset"], "label", ["a"], "cell").collect()


def test_manifest_names_with_ending(spark):
    schema = "dataset string, Period date, Value double, Status string, Label1 string"
    rows = spark.createDataFrame([("a1", dt.date(2020, 1, 31), 1.0, "F", "x")], schema)
    grid = rows.select("dataset", "Period", F.array("Label1").alias("labels"), "Value", "Status")
    manifest = spark.createDataFrame([("n", "a1.csv", "a1.csv"), ("m", "a1", "b.csv")], "name string, api_fname string, grid_fname string")
    found = {r.name: r.equivalent for r in reconcile.reconcile(manifest, rows, grid).collect()}
    assert found["n"] is True and found["m"] is not True


def test_occurrences(spark):
    events = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y"), ("b", 1, "z")], "uid string, d int, iid string")
    wanted = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "uid string, day int")
    found = history.single_occurrence(events, "uid", F.col("d"), "iid", wanted).collect()
    assert {(r.uid, r.action, r.iid) for r in found} == {("a", "cancel", "x"), ("b", "ambiguous", None), ("c", "none", None)}


def test_fingerprints(spark):
    rows = [("a", None, ["x", None], 1.0), ("a", "x", [None], 1.0), ("a", None, ["x", None], 1.0), ("a", "", ["y"], None)]
    kinds = "k string, s string, labels array<string>, v double"

    def printed(rows):
        made = compare.fingerprints(spark.createDataFrame(rows, kinds).repartition(3), ["k"], ["s", "labels", "v"]).collect()
        return [(r.rows, r.prints) for r in made]

    assert printed(rows) == printed(rows[::-1])
    for k, other in enumerate([("a", "x", ["x", None], 1.0), ("a", None, [None], 1.0), ("a", None, [None, "x"], 1.0), ("a", None, ["x", ""], 1.0),
                               ("a", None, ["x"], 1.0), ("a", None, None, 1.0), ("a", None, ["x", None], None), ("a", "x", [None], 1.0)]):
        assert printed([other, *rows[1:]]) != printed(rows), k


def test_equal_copies_are_settled_by_their_fingerprints(spark, monkeypatch):
    api = spark.range(500).selectExpr("concat('d', id % 5) dataset", "date'2021-01-31' Period", "cast(id as string) Label1",
                                      "cast(id as double) Value", "'F' Status")
    grid = api.select("dataset", "Period", F.array("Label1").alias("labels"), "Value", "Status")
    manifest = spark.range(6).selectExpr("concat('n', id) name", "concat('d', id, '.csv') api_fname", "concat('d', id) grid_fname")
    made = reconcile.reconcile(manifest, api, grid)
    assert "Union" not in made._jdf.queryExecution().optimizedPlan().toString()
    assert {r.name: r.equivalent for r in made.collect()} == {**{f"n{k}": True for k in range(5)}, "n5": None}
    moved = grid.withColumn("Value", F.when(F.col("Value") == 3, 4.0).otherwise(F.col("Value")))
    twice = moved.unionByName(moved.where("dataset = 'd4'").limit(1))
    made = reconcile.reconcile(manifest, api, twice)
    assert {r.name: r.equivalent for r in made.collect()} == {"n0": True, "n1": True, "n2": True, "n3": False, "n4": False, "n5": None}


def test_used_columns_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "cast(null as string) a", "if(id = 70, 'x', null) b", "cast(null as date) c",
                                "array(cast(null as int)) d").repartition(4).write.parquet(path)
    plan = compare.file_column_uses(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(id)" in plan
    assert tuple(compare.file_column_uses(spark, path).first()) == (100, 0, 1, 0, 100)
    assert compare.read_used_columns(spark, path).columns == ["id", "b", "d"]
