"""Release watch as a stream.

Releases and page checks arrive as one stream of tagged rows, so that a release no check ever came
for still ends. Keys are hashed into shards, and time is cut into spans. A release belongs to the span it
starts in; a check goes to every span from which a release may still wait for it, so all that decides a
release meets in one group of shard and span, and a key with most of the rows is split by time.

A group's state is a map from short pieces of time, a thirtieth of the watch, to the rows of that piece. A batch
writes the pieces its rows lie in, and drops those that no open release can see any more; what is merely open is not
written again. However long the watch, a look handles some sixty pieces and makes one table of them. Nothing needs
to be marked as answered: the time at which a release is decided follows from its rows, and each look answers
those decided since the last one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from statloom.fixed_values import DEFAULT_ZONE, WATCH_MINUTES
from statloom.plans.watch import decided

RELEASE, CHECK, CLOCK = "release", "check", "clock"
TAGGED = "kind string, key string, id bigint, ts timestamp, updated boolean, due_date date"

_MINUTE = 60_000_000
# Pieces of a watch.
_PIECES = 30
_DECIDED = "release_id bigint, release_dt timestamp, due_date date, found timestamp, updated boolean"
_BATCH = pa.schema([
    ("kind", pa.string()), ("key", pa.string()), ("id", pa.int64()), ("ts", pa.timestamp("us")),
    ("updated", pa.bool_()), ("due_date", pa.date32()),
])


def _packed(batches: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _BATCH) as writer:
        writer.write_table(pa.Table.from_batches(batches, _BATCH).combine_chunks())
    return sink.getvalue().to_pybytes()


def _unpacked(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all()


def next_checks(rows: pd.DataFrame) -> pd.DataFrame:
    """The next deciding check of every release in a table of tagged rows, by key."""
    rows = rows.sort_values(["ts", "id"], kind="stable")
    starts = rows.loc[rows["kind"] == RELEASE, ["id", "key", "ts", "due_date"]]
    marks = rows.loc[rows["kind"] == CHECK, ["key", "ts", "updated"]].drop_duplicates(["key", "ts"])
    marks = marks.assign(found=marks["ts"])
    joined = pd.merge_asof(starts, marks, on="ts", by="key", direction="forward")
    return joined.rename(columns={"id": "release_id", "ts": "release_dt"})[
        ["release_id", "release_dt", "due_date", "found", "updated"]
    ]


def decisions(rows: pd.DataFrame, window: pd.Timedelta) -> pd.DataFrame:
    """The releases with their next deciding check, and ``decided``: the time from which nothing can change that.

    That is just behind the check, or the end of the window, whichever comes first.
    """
    found = next_checks(rows)
    ends = found["release_dt"] + window
    return found.assign(decided=(found["found"] + pd.Timedelta(microseconds=1)).fillna(ends).where(lambda d: d < ends, ends))


class _Watch(StatefulProcessor):
    def __init__(self, minutes: int):
        self.window = pd.Timedelta(minutes=minutes)
        self.piece = max(1, minutes // _PIECES) * _MINUTE

    def init(self, handle) -> None:
        self.handle = handle
        self.pieces = handle.getMapState("pieces", "piece bigint", "batch binary")
        self.seen = handle.getValueState("seen", "ms bigint")

    def _take(self, rows: pd.DataFrame) -> None:
        pieces = (rows["ts"].astype("datetime64[us]").astype("int64") // self.piece).to_numpy()
        order = np.argsort(pieces, kind="stable")
        pieces, batch = pieces[order], pa.RecordBatch.from_pandas(rows[_BATCH.names].iloc[order], schema=_BATCH, preserve_index=False)
        cuts = np.flatnonzero(np.diff(pieces)) + 1
        for begin, end in zip([0, *cuts], [*cuts, len(pieces)]):
            key, parts = (int(pieces[begin]),), [batch.slice(begin, end - begin)]
            if self.pieces.containsKey(key):
                parts = _unpacked(self.pieces.getValue(key)[0]).to_batches() + parts
            self.pieces.updateValue(key, (_packed(parts),))

    def _step(self, rows: pd.DataFrame, timer_values) -> Iterator[pd.DataFrame]:
        ms = timer_values.getCurrentWatermarkInMs()
        before = self.seen.get()[0] if self.seen.exists() else None
        if before == ms and not len(rows):
            return  # an older timer of this look
        now = pd.Timestamp(ms, unit="ms")
        if len(rows):
            self._take(rows)
        held = {key[0]: _unpacked(value[0]) for key, value in self.pieces.iterator()}
        if not held:
            self.seen.clear()
            return
        found = decisions(pa.concat_tables(held.values()).to_pandas(), self.window)
        due = found["decided"] <= now
        if before is not None:
            due &= found["decided"] > pd.Timestamp(before, unit="ms")
        ends = {piece: pd.Timestamp((piece + 1) * self.piece, unit="us") + self.window for piece in held}
        for piece in [p for p, end in ends.items() if end <= now]:
            self.pieces.removeKey((piece,))
            del ends[piece]
        if ends:
            self.seen.update((ms,))
            wake = min([*found.loc[found["decided"] > now, "decided"], *ends.values()])
            self.handle.registerTimer(-(-wake.value // 1_000_000))
        else:
            self.seen.clear()
        if due.any():
            yield found.loc[due].drop(columns="decided")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = pd.Timestamp(timerValues.getCurrentWatermarkInMs(), unit="ms")
        return self._step(pd.concat([b.loc[b["ts"] >= now, _BATCH.names] for b in rows], ignore_index=True), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._step(pd.DataFrame(columns=_BATCH.names), timerValues)

    def close(self) -> None:
        pass


def _span(ts: Column, span_minutes: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(span_minutes * 60_000_000))


def watch_stream(tagged: DataFrame, lateness: str = "0 minutes", minutes: int = WATCH_MINUTES,
                 zone: str = DEFAULT_ZONE, shards: int | None = None, span_minutes: int = 1440) -> DataFrame:
    """``release_id, outcome, at, next_date`` per release, as soon as it is decided.

    ``tagged`` is a stream of ``kind, key, id, ts, updated, due_date`` (see ``TAGGED``). A ``clock``
    row only carries time forward. A release is answered when the watermark has passed its first
    deciding check or the end of its window, and answered once, so an alert is sent once. The answer
    depends on event times alone, not on how the rows were batched. Rows later than ``lateness`` are
    left out. Needs the RocksDB state store.

    ``shards`` is the number of hash groups of keys (by default the number of shuffle partitions). What one
    task holds at a time are the rows of a shard in ``span_minutes`` and the ``minutes`` behind them: with
    more rows, take more shards or shorter spans.
    """
    shards = int(tagged.sparkSession.conf.get("spark.sql.shuffle.partitions")) if shards is None else shards
    of_use = (F.col("kind") == RELEASE) | ((F.col("kind") == CHECK) & (F.col("updated").isNull() | F.col("updated")))
    # Asked about the event time, the filter stays behind the watermark, which needs the clock rows.
    own = _span(F.col("ts"), span_minutes)
    first = _span(F.col("ts") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes)), span_minutes)
    placed = (
        tagged.withWatermark("ts", lateness).where(F.when(F.col("ts").isNotNull(), of_use))
        .withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
        .withColumn("span", F.explode(F.when(F.col("kind") == CHECK, F.sequence(first, own)).otherwise(F.array(own))))
    )
    return (
        placed.groupBy("shard", "span")
        .transformWithStateInPandas(_Watch(minutes), _DECIDED, "Append", "EventTime")
        .select("release_id", F.col("release_dt").cast("timestamp_ntz").alias("release_dt"), "due_date",
                F.when(F.col("found").isNotNull(), F.struct(F.col("found").cast("timestamp_ntz").alias("ts"), "updated"))
                .alias("_first"))
        .transform(lambda rows: decided(rows, minutes, zone))
    )


def tag_checks(checks: DataFrame) -> DataFrame:
    """Checks (``key, check_id, ts, updated``) as rows of the stream."""
    return checks.selectExpr(
        f"'{CHECK}' kind", "cast(key as string) key", "cast(check_id as bigint) id",
        "cast(ts as timestamp) ts", "updated", "cast(null as date) due_date",
    )


def tag_rows(releases: DataFrame, checks: DataFrame) -> DataFrame:
    """One table of releases and checks, as ``watch_stream`` reads it."""
    starts = releases.selectExpr(
        f"'{RELEASE}' kind", "cast(key as string) key", "cast(release_id as bigint) id",
        "cast(release_dt as timestamp) ts", "cast(null as boolean) updated", "due_date",
    )
    return starts.unionByName(tag_checks(checks))


def clock_row(tagged: DataFrame, minutes: int) -> DataFrame:
    """A row ``minutes`` behind the last one of the table, to end what is still open."""
    end = F.max("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return tagged.agg(end.alias("ts")).select(
        F.lit(CLOCK).alias("kind"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("bigint").alias("id"),
        "ts", F.lit(None).cast("boolean").alias("updated"), F.lit(None).cast("date").alias("due_date"),
    )
