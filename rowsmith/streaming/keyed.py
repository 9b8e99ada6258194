"""Ordered work per key in Spark's own keyed state: rows wait for the watermark, then are taken in time order.

A stream gives its rows in any order. The keys are dealt to buckets by hash, and a bucket is what Spark's state knows: it
keeps the rows that the watermark has not passed yet as a list of Arrow tables, and one event-time timer; when that fires,
the rows behind the watermark are taken in (key, time, tie) order, all keys of the bucket at once. So the calls to the state
grow with buckets and batches, not with the number of keys. State, timers, late rows and replays are Spark's: a batch that is
run again finds the state of the batch before it. What waits is what arrives within the delay; rows behind the watermark are
left out and counted by Spark (``late_rows``). Rows without a time are left out as well, and so are rows of 1970 and earlier,
where every watermark starts.

Spark keeps such state in RocksDB only. ``state_session`` gives a session of the same application with that setting, so the
caller's own session is left as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Keys that wait together: the state is asked once for all of them.
BUCKETS = 512
# Rows of one piece of a bucket's state.
PIECE = 20_000
WAITING = pa.schema([("key", pa.string()), ("at", pa.int64()), ("tie", pa.int64()), ("value", pa.string())])
OPEN = pa.schema([("key", pa.string()), ("value", pa.string()), ("length", pa.int64()), ("starts_at", pa.int64())])
KEPT_SETTINGS = ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")


def state_session(spark: SparkSession) -> SparkSession:
    """A second session of the application whose streams keep their state in RocksDB."""
    session = spark.newSession()
    for name in KEPT_SETTINGS:
        session.conf.set(name, spark.conf.get(name))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    return session


def late_rows(query) -> int:
    """The rows that came behind the watermark, over the batches this run of the query still remembers."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def packed(rows: pa.Table) -> list[tuple[bytes]]:
    """Rows as pieces that a list state holds."""
    out = []
    for start in range(0, rows.num_rows, PIECE):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as writer:
            writer.write_table(rows.slice(start, PIECE))
        out.append((sink.getvalue().to_pybytes(),))
    return out


def unpacked(pieces, schema: pa.Schema) -> pa.Table:
    return pa.concat_tables([schema.empty_table(), *[pa.ipc.open_stream(bytes(piece[0])).read_all() for piece in pieces]])


def numbers(texts: pa.ChunkedArray) -> np.ndarray:
    """A number for each different text; -1 for NULL."""
    return texts.combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


class InTimeOrder(StatefulProcessor):
    """Rows (key, at: microseconds, tie, value) of a bucket of keys, handed on in order once the watermark has passed them."""

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.timer = handle.getValueState("timer", "at_ms long")

    def take(self, waiting: pa.Table, key: np.ndarray, at: np.ndarray, upto: int) -> tuple[pd.DataFrame, np.ndarray, int | None]:
        """(rows to emit, which rows go on waiting, time of the next look) from rows by (key, time, tie) and the watermark;
        ``key`` numbers the keys, a NULL one like any other."""
        raise NotImplementedError

    def first_look(self, at: int) -> int:
        """When a row at ``at`` can be dealt with at the earliest."""
        return at

    def _look_at(self, at: int | None) -> None:
        """Keep one timer, at the earliest time asked for."""
        wanted = None if at is None else -(-at // 1000)
        known = self.timer.get()[0] if self.timer.exists() else None
        if wanted is None or (known is not None and known <= wanted):
            return
        if known is not None:
            self.handle.deleteTimer(known)
        self.handle.registerTimer(wanted)
        self.timer.update((wanted,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:
            self.waiting.appendList(packed(pa.table([pa.array(part[f.name], f.type, from_pandas=True) for f in WAITING], WAITING)))
            at = int(part["at"].min())
            first = at if first is None else min(first, at)
        if first is not None:
            self._look_at(self.first_look(first))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = unpacked(self.waiting.get(), WAITING)
        number, at = numbers(waiting["key"]), waiting["at"].to_numpy()
        order = np.lexsort((waiting["tie"].to_numpy(), at, number))
        waiting = waiting.take(pa.array(order))
        emitted, rest, again = self.take(waiting, number[order], at[order], upto)
        if rest.any():
            self.waiting.put(packed(waiting.filter(pa.array(rest))))
        else:
            self.waiting.clear()
        self._look_at(again)
        if len(emitted):
            yield emitted

    def close(self) -> None:
        pass


class ClosedRuns(InTimeOrder):
    """Runs of the same value, emitted when another value of the key has ended them."""

    def init(self, handle) -> None:
        super().init(handle)
        self.open = handle.getListState("open", "runs binary")

    def take(self, waiting, key, at, upto):
        done = at <= upto
        known = unpacked(self.open.get(), OPEN)
        n = int(done.sum())
        rows = waiting.filter(pa.array(done))
        # An open run is a row of its length before the new rows of its key.
        keys, values = (pa.chunked_array([*known[c].chunks, *rows[c].chunks], pa.string()) for c in ("key", "value"))
        order = np.argsort(numbers(keys), kind="stable")
        key, value = numbers(keys)[order], numbers(values)[order]
        length = np.concatenate([known["length"].to_numpy(), np.ones(n, np.int64)])[order]
        begin = np.concatenate([known["starts_at"].to_numpy(), np.ones(n, np.int64)])[order]
        if len(key):
            other = np.append(True, key[1:] != key[:-1])
            first = np.flatnonzero(other | np.append(True, value[1:] != value[:-1]))
            length, upto_here = np.add.reduceat(length, first), np.cumsum(length) - length
            # Rows of the key before the run, and where its first run starts.
            own = np.flatnonzero(other)[np.cumsum(other) - 1][first]
            runs = pa.table([keys.take(pa.array(order[first])), values.take(pa.array(order[first])), pa.array(length), pa.array(upto_here[first] - upto_here[own] + begin[own])], OPEN)
            last = np.append(key[first][1:] != key[first][:-1], True)
            self.open.put(packed(runs.filter(pa.array(last))))
            emitted = runs.filter(pa.array(~last)).to_pandas()
        else:
            emitted = pd.DataFrame()
        return emitted, ~done, None if done.all() else int(at[~done].min())


class SessionLaps(InTimeOrder):
    """Every lap of a session, emitted in order when the watermark has passed the session's end."""

    def __init__(self, gap_us: int):
        self.gap_us = gap_us

    def first_look(self, at):
        return at + self.gap_us

    def take(self, waiting, key, at, upto):
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (at[1:] - at[:-1] >= self.gap_us)))
        size = np.diff(np.append(first, len(at)))
        start, ends = np.repeat(at[first], size), at[first + size - 1] + self.gap_us
        rest = np.repeat(ends > upto, size)
        lap_no = np.arange(len(at)) - np.repeat(first, size) + 1
        lap = np.where(lap_no == 1, 0, np.diff(at, prepend=at[:1]))
        columns = [waiting["key"], pa.array(start), waiting["tie"], pa.array(lap_no), pa.array(lap), pa.array(at - start)]
        laps = pa.table(columns, ["key", "session_us", "tie", "lap_no", "lap_us", "total_us"])
        return laps.filter(pa.array(~rest)).to_pandas(), rest, int(ends[ends > upto].min()) if rest.any() else None


def _timed(events: DataFrame, by: str, ts: str, tie: str, value, delay: str, buckets: int):
    at = F.col(ts).cast("timestamp")
    # Keys travel as text, a NULL one as NULL; bytes that may be no text as hex digits.
    key = F.hex(by) if events.schema[by].dataType.simpleString() == "binary" else F.col(by).cast("string")
    rows = events.select(
        F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"), at.alias("_ts"),
        key.alias("key"), F.unix_micros(at).alias("at"), F.col(tie).cast("long").alias("tie"), value.alias("value"),
    )
    return rows.where("_ts is not null").withWatermark("_ts", delay).groupBy("bucket")


def _key(events: DataFrame, by: str):
    kind = events.schema[by].dataType
    return (F.unhex("key") if kind.simpleString() == "binary" else F.col("key").cast(kind)).alias(by)


def closed_runs(events: DataFrame, by: str, ts: str, tie: str, value: str, delay: str = "1 hour", buckets: int = BUCKETS) -> DataFrame:
    """by, value, length, starts_at of every run of equal values that has ended, over a stream (``state_session``).

    ``starts_at`` counts the key's rows in time order from 1, as the batch form does; the last run of a key is still open
    and stays in the state. ``buckets`` belongs to the state: a stream that goes on from a checkpoint keeps its number.
    """
    kind = events.schema[value].dataType
    runs = _timed(events, by, ts, tie, F.col(value).cast("string"), delay, buckets).transformWithStateInPandas(
        ClosedRuns(), "key string, value string, length long, starts_at long", "Append", "EventTime"
    )
    return runs.select(_key(events, by), F.col("value").cast(kind).alias(value), "length", "starts_at")


def session_laps(
    events: DataFrame, by: str, ts: str, tie: str, gap_seconds: int = 1800, delay: str = "1 hour", buckets: int = BUCKETS
) -> DataFrame:
    """by, session (start), tie, lap_no, lap_us and total_us of every event of every closed session, over a stream."""
    laps = _timed(events, by, ts, tie, F.lit(None).cast("string"), delay, buckets).transformWithStateInPandas(
        SessionLaps(gap_seconds * 1_000_000), "key string, session_us long, tie long, lap_no long, lap_us long, total_us long", "Append", "EventTime"
    )
    return laps.select(_key(events, by), F.timestamp_micros("session_us").alias("session"), F.col("tie").alias(tie), "lap_no", "lap_us", "total_us")
