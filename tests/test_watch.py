import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from statloom.operators import history
from statloom.plans import watch
from statloom.session import scratch_path
from statloom.streaming import cadence, release_watch, snapshots

START = dt.datetime(2021, 9, 16, 22, 45)  # 10:45 on Friday 17 September in Auckland
RELEASES = "release_id bigint, key string, release_dt timestamp_ntz, due_date date"
CHECKS = "key string, check_id bigint, ts timestamp_ntz, updated boolean"


def minute(m):
    return START + dt.timedelta(minutes=m)


@pytest.mark.parametrize("slot_minutes", [1, 7, 60])
@pytest.mark.parametrize("checks, outcome, at, next_date", [
    ([(5, False), (10, True), (15, True)], "RELEASED", 10, None),
    ([(5, None), (10, True)], "ERROR", 5, None),
    ([(5, False), (10, False), (25, False)], "ROLLED", 30, dt.date(2021, 9, 20)),
    ([(35, True)], "ROLLED", 30, dt.date(2021, 9, 20)),
    ([(30, True)], "ROLLED", 30, dt.date(2021, 9, 20)),
    ([(-1, True), (0, None)], "ERROR", 0, None),
    ([], "ROLLED", 30, dt.date(2021, 9, 20)),
])
def test_outcomes(spark, checks, outcome, at, next_date, slot_minutes):
    releases = spark.createDataFrame([(1, "u", START, dt.date(2021, 9, 17))], RELEASES)
    log = spark.createDataFrame([("u", i, minute(m), v) for i, (m, v) in enumerate(checks)], CHECKS)
    found = watch.release_watch(releases, log, slot_minutes=slot_minutes).collect()
    assert list(map(tuple, found)) == [(1, outcome, minute(at), next_date)]


def random_log(seed, keys=12, size=400):
    """One key has a third of everything; many rows share their time."""
    rng = random.Random(seed)
    key = lambda: "hot" if rng.random() < 0.34 else f"k{rng.randrange(keys)}"
    releases = [(i, key(), minute(rng.randrange(0, 3000, 5)), dt.date(2021, 9, 17)) for i in range(size)]
    checks = [(key(), i, minute(rng.randrange(0, 3100, 5)), rng.choice([True, False, False, None])) for i in range(size * 2)]
    return releases, checks


def brute_force(releases, checks):
    out = set()
    for ident, key, at, due in releases:
        near = [(ts, i, v) for k, i, ts, v in checks if k == key and v is not False
                and at <= ts < at + dt.timedelta(minutes=30)]
        if near:
            ts, _, updated = min(near, key=lambda c: c[:2])
            out.add((ident, "RELEASED" if updated else "ERROR", ts, None))
        else:
            end = at + dt.timedelta(minutes=30)
            friday = (end + dt.timedelta(hours=12)).weekday() == 4
            out.add((ident, "ROLLED", end, due + dt.timedelta(days=3 if friday else 1)))
    return out


@pytest.mark.parametrize("slot_minutes", [1, 13, 10_000])
def test_batch_against_brute_force(spark, slot_minutes):
    releases, checks = random_log(3)
    found = watch.release_watch(
        spark.createDataFrame(releases, RELEASES), spark.createDataFrame(checks, CHECKS), slot_minutes=slot_minutes
    ).collect()
    assert len(found) == len(releases) and set(map(tuple, found)) == brute_force(releases, checks)


def test_stream_against_brute_force(spark, tmp_path):
    """Fed in several batches, out of order within the lateness; the answer is that of the whole log."""
    releases, checks = random_log(4, size=150)
    releases.append((150, "quiet", minute(3095), dt.date(2021, 9, 17)))  # only the clock ends it
    tagged = release_watch.tag_rows(spark.createDataFrame(releases, RELEASES), spark.createDataFrame(checks, CHECKS))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    tagged.limit(0).write.parquet(source)
    stream = spark.readStream.schema(release_watch.TAGGED).parquet(source)
    query = (
        release_watch.watch_stream(stream, "20 minutes", shards=3, span_minutes=700)
        .writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "log")).start()
    )
    expected = brute_force(releases, checks)
    # Releases of a batch may come up to 15 minutes after checks of the next.
    at = F.when(F.col("kind") == "release", F.col("ts") - F.expr("interval 15 minutes")).otherwise(F.col("ts"))
    early = None
    try:
        for first in range(-100, 3200, 1100):
            part = tagged.where((at >= F.lit(minute(first))) & (at < F.lit(minute(first + 1100))))
            part.coalesce(1).write.mode("append").parquet(source)
            query.processAllAvailable()
            if first == 1000:
                early = set(map(tuple, spark.read.parquet(out).collect()))
        assert spark.read.parquet(out).count() < len(releases)
        release_watch.clock_row(tagged, 30 + 21).write.mode("append").parquet(source)
        query.processAllAvailable()
    finally:
        query.stop()
    assert early and early < expected  # answers come as soon as they are certain
    found = spark.read.parquet(out).collect()
    assert len(found) == len(releases) and set(map(tuple, found)) == expected


class _State(dict):
    """The state a processor asks for, in memory; counts what is written."""

    written = 0
    timers: list

    def __init__(self):
        super().__init__()
        self.timers = []

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        outer = self

        class Value:
            exists = staticmethod(lambda: "seen" in outer.__dict__)
            get = staticmethod(lambda: outer.seen)
            update = staticmethod(lambda v: outer.__dict__.__setitem__("seen", v))
            clear = staticmethod(lambda: outer.__dict__.pop("seen", None))

        return Value

    def registerTimer(self, ms):
        self.timers.append(ms)

    def containsKey(self, key):
        return key in self

    def getValue(self, key):
        return self[key]

    def updateValue(self, key, value):
        self.written += len(value[0])
        self[key] = value

    def removeKey(self, key):
        del self[key]

    def iterator(self):
        return iter(list(self.items()))


def step(processor, now, *given):
    """One look at the watermark ``now`` with rows (kind, id, minute, updated) of one key."""
    rows = pd.DataFrame([(kind, "u", i, pd.Timestamp(minute(m)), updated, None) for kind, i, m, updated in given],
                        columns=["kind", "key", "id", "ts", "updated", "due_date"])
    clock = type("Clock", (), {"getCurrentWatermarkInMs": lambda _: pd.Timestamp(minute(now)).value // 1_000_000})()
    made = processor.handleInputRows(None, iter([rows]), clock) if given else processor.handleExpiredTimer(None, clock, None)
    return [i for part in made for i in part["release_id"]]


def test_looks_of_the_watch():
    watched, state = release_watch._Watch(30), _State()
    watched.init(state)
    assert step(watched, -5, ("release", 0, 0, None), ("check", 1, 5, True), ("release", 2, 6, None), ("check", 3, 12, None)) == []
    assert state.timers[-1] * 1_000_000 == pd.Timestamp(minute(5)).value + 1_000_000
    assert step(watched, 10) == [0] and step(watched, 10) == []
    assert step(watched, 12) == []  # another check of the same minute may still come
    assert step(watched, 12, ("release", 9, 12, None)) == []
    assert sorted(step(watched, 13)) == [2, 9]
    assert step(watched, 13, ("release", 7, 20, None)) == []
    assert step(watched, 50) == [7] and step(watched, 100) == []
    assert not state and "seen" not in state.__dict__


def test_state_that_is_written_grows_with_the_batch():
    """One hot key with a release a second for an hour: a batch writes its own minutes, whatever is open."""
    watched, state = release_watch._Watch(30), _State()
    watched.init(state)
    sizes, answered = [], []
    for batch in range(60):
        before = state.written
        answered += step(watched, batch, *[("release", 60 * batch + k, batch + k / 60, None) for k in range(60)])
        sizes.append(state.written - before)
    assert max(sizes) <= 2 * min(sizes) and len(state) <= 33
    answered += step(watched, 200)
    assert sorted(answered) == list(range(3600)) and not state


def test_a_watch_of_a_day_holds_few_pieces():
    """A day's watch over rows of every minute: a look handles some sixty pieces, whatever it waits for."""
    watched, state = release_watch._Watch(1440), _State()
    watched.init(state)
    rows = [("release" if m % 7 else "check", m, m, None if m % 7 else m % 2 == 0) for m in range(2880)]
    answered = step(watched, -1, *rows[:1000]) + step(watched, -1, *rows[1000:])
    assert answered == [] and len(state) <= 62
    found = step(watched, 5000)
    assert sorted(found) == [m for m in range(2880) if m % 7] and not state


def test_alerts(spark):
    outcomes = spark.createDataFrame([(1, "RELEASED"), (2, "ERROR"), (3, "ROLLED")], "release_id bigint, outcome string")
    details = spark.createDataFrame(
        [(i, f"t{i}", "Aug 2021", "/u", "boom") for i in (1, 2, 3)],
        "release_id bigint, title string, date_str string, url string, info string",
    )
    found = {r.release_id: (r.subject, r.message) for r in watch.watch_alerts(outcomes, details).collect()}
    assert set(found) == {1, 2}
    assert found[1] == ("Alert- Data Release Detected", 'New data for "t1", date "Aug 2021". Download: /u')
    assert "boom" in found[2][1]


def test_probe_alerts(spark):
    probes = spark.createDataFrame(
        [(1, "u", True, None), (2, "u", False, None), (3, "u", True, "E"), (4, "u", None, None)],
        "probe_id int, url string, downloaded boolean, exception string",
    )
    assert {r.probe_id: r.outcome for r in watch.probe_alerts(probes).collect()} == {
        2: "unsuccessful", 3: "exception", 4: "unsuccessful"
    }


def test_pending(spark):
    releases = spark.createDataFrame([(1, "u", START, None), (2, "u", minute(1), None)], RELEASES)
    now = F.lit(minute(1)).cast("timestamp_ntz")
    assert [r.release_id for r in watch.elapsed(releases, now).collect()] == [1]
    assert watch.pending(releases, now).count() == 0


def test_alerts_are_sent_once(spark, tmp_path):
    schema = "id int, ts timestamp"
    rows = [(1, minute(0)), (1, minute(3)), (2, minute(4)), (1, minute(100))]
    spark.createDataFrame(rows[:2], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    query = (
        cadence.first_alerts(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "id", "ts", "30 minutes")
        .writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "log")).start()
    )
    try:
        query.processAllAvailable()
        for row in rows[2:]:
            spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            query.processAllAvailable()
    finally:
        query.stop()
    ids = [r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert ids.count(2) == 1 and 1 <= ids.count(1) <= 2


def test_snapshots(spark, tmp_path):
    schema = "doc string, snapshot_ts timestamp_ntz, content string"
    order = [F.desc("snapshot_ts")]
    source, store, log = (str(tmp_path / n) for n in ("in", "store", "log"))
    expected = {}
    rng = random.Random(5)
    stream = None
    for batch in range(3):
        rows = [(f"d{rng.randrange(4)}", minute(1000 * batch + i), f"{batch}-{i}") for i in range(10)]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        snapshots.follow_snapshots(stream, ["doc"], order, store, log)
        for doc, _, content in rows:
            expected.setdefault(doc, []).append(content)
    wanted = {(doc, g, c) for doc, cs in expected.items() for g, c in enumerate(reversed(cs[-2:]), 1)}
    current = snapshots.current_copies(spark, store, ["doc"], order)
    assert {(r.doc, r.generation, r.content) for r in current.collect()} == wanted
    assert snapshots.stored_rows(spark, store).count() == len(wanted)


def test_store_is_bounded_and_repeats_change_nothing(spark, tmp_path):
    schema, order, store = "doc string, n long, content string", [F.desc("n")], str(tmp_path / "store")
    rng, seen = random.Random(6), {}
    with pytest.raises(ValueError, match="no batch"):
        snapshots.stored_rows(spark, store)
    for number in range(8):
        rows = [(rng.choice("aaaabcdefg") + (str(number) if rng.random() < 0.1 else ""), 100 * number + i, "x") for i in range(30 * (number != 4))]
        for doc, n, _ in rows:
            seen.setdefault(doc, []).append(n)
        batch = spark.createDataFrame(rows, schema)
        snapshots.take_in(batch, number, store, ["doc"], order, buckets=3)
        wanted = sorted((d, n) for d, ns in seen.items() for n in sorted(ns)[-2:])

        def lying():
            return sorted((r.doc, r.n) for r in snapshots.stored_rows(spark, store).collect())

        assert lying() == wanted
        snapshots.take_in(batch, number, store, ["doc"], order)
        snapshots.take_in(batch.limit(0), number - 1, store, ["doc"], order)
        assert lying() == wanted
    files = [p for p in (tmp_path / "store/data").rglob("*.parquet")]
    assert len({p.parent for p in files}) <= 2 * 3


def test_interrupted_batch_of_the_store(spark, tmp_path, monkeypatch):
    schema, order, store = "doc string, n long", [F.desc("n")], str(tmp_path / "store")
    one, two = (spark.createDataFrame([(d, n) for d in "abc"], schema) for n in (1, 2))
    snapshots.take_in(one, 0, store, ["doc"], order, keep=1, buckets=2)
    spark_range = type(spark).range
    monkeypatch.setattr(type(spark), "range", lambda *a: 1 / 0)  # fails where the manifest is made
    with pytest.raises(ZeroDivisionError):
        snapshots.take_in(two, 1, store, ["doc"], order, keep=1)
    monkeypatch.setattr(type(spark), "range", spark_range)
    assert {r.n for r in snapshots.stored_rows(spark, store).collect()} == {1}
    snapshots.take_in(two, 1, store, ["doc"], order, keep=1)
    assert sorted(map(tuple, snapshots.stored_rows(spark, store).collect())) == [(d, 2) for d in "abc"]


def test_history(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 9)], "doc string, n int")
    kept = history.latest_and_previous(rows, ["doc"], [F.desc("n")])
    assert sorted(map(tuple, kept.collect())) == [("a", 2, 2), ("a", 3, 1), ("b", 9, 1)]
    fresh = history.latest_and_previous(rows, ["doc"], [F.desc("n")])
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # cut before and after the shuffle
    latest = history.latest_per_section(rows, ["doc"], F.col("n"))
    wanted = spark.createDataFrame([("a",), ("z",)], "doc string")
    found = {r.doc: (r.n, r.error) for r in history.required_sections(wanted, latest, "doc").collect()}
    assert found == {"a": (3, None), "z": (None, "section not found: z")}


def test_arrivals(spark):
    expected = spark.createDataFrame([(1, "a.csv"), (1, "b.csv"), (2, "a.csv")], "batch int, fname string")
    arrived = spark.createDataFrame([(1, "a.csv")] * 50 + [(2, "b.csv")], "batch int, fname string")
    missing = history.missing_arrivals(expected, arrived, ["batch", "fname"])
    assert sorted(map(tuple, missing.collect())) == [(1, "b.csv"), (2, "a.csv")]


def test_next_events(spark):
    events = spark.createDataFrame([("u", i, minute(m)) for i, m in enumerate((5, 1, 5, 9))] + [("v", 9, minute(0))],
                                   "user string, id int, ts timestamp_ntz")
    now = F.lit(minute(1)).cast("timestamp_ntz")
    assert [tuple(r) for r in history.next_events(events, ["user"], "ts", "id", now).collect()] == [("u", 0, minute(5), 2)]
    assert history.next_release(events, "ts", "id", now).first().id == 0


def test_single_occurrence(spark):
    events = spark.createDataFrame([("a", 1, dt.date(2021, 1, 1)), ("a", 2, dt.date(2021, 1, 2)),
                                    ("a", 3, dt.date(2021, 1, 2))], "uid string, id int, day date")
    found = history.single_occurrence(events, "uid", F.col("day"), "id").collect()
    assert {(r.day.day, r.action, r.id) for r in found} == {(1, "cancel", 1), (2, "ambiguous", None)}


def test_scratch_folder(spark, monkeypatch):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    if shared:
        assert first.startswith(f"{shared.rstrip('/')}/x-")
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(spark, "x")


def test_first_decisions_of_a_plain_log(spark, tmp_path):
    """Checks out of order within the lateness, over several batches."""
    releases, checks = random_log(11, size=120)
    expected = {r[:3] for r in brute_force(releases, checks) if r[1] != "ROLLED"}
    starts = spark.createDataFrame(releases, RELEASES)
    log = spark.createDataFrame(checks, CHECKS).withColumn("ts", F.col("ts").cast("timestamp"))
    source, last = str(tmp_path / "in"), dt.datetime(2100, 1, 1)
    log.where("false").write.parquet(source)
    stream = spark.readStream.schema(log.schema).parquet(source)
    found = cadence.first_decisions(stream, cadence.clock(starts.select("release_id", "key", "release_dt"), last), late_minutes=15)
    query = (found.writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "log")).start())
    try:
        for first in range(-100, 3300, 700):
            # Every third check comes up to 15 minutes before its turn.
            at = F.col("ts") - F.when(F.col("check_id") % 3 == 0, F.expr("interval 15 minutes")).otherwise(F.expr("interval 0 minutes"))
            log.where((at >= F.lit(minute(first))) & (at < F.lit(minute(first + 700)))).write.mode("append").parquet(source)
            query.processAllAvailable()
        cadence.clock(log, last).where(F.col("key") == cadence.CLOCK_KEY).write.mode("append").parquet(source)
        query.processAllAvailable()
    finally:
        query.stop()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {tuple(r) for r in rows} == expected and len(rows) == len(expected) > 10
