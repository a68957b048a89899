"""State by key with timers: sessions that close themselves, and first sights that expire.

Both run as ``transformWithState``; its state lives in RocksDB, on disk and in
the checkpoint, so it may exceed memory and survives lost executors.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.temporal import micros

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_on_disk(spark: SparkSession) -> None:
    """State of several kinds for a key needs the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class Sessions(StatefulProcessor):
    """Open sessions of a key in a list, ordered by time; a timer for the end of each.

    Events may come in any order within the watermark: one that joins two open
    sessions unites them.
    """

    def __init__(self, gap_seconds: int):
        self.gap = gap_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "first long, last long, n long")
        self.closed = handle.getValueState("closed", "n long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        found = [tuple(s) for s in self.open.get()]
        before = {last for _, last, _ in found}
        found += [(r["at"], r["at"], 1) for r in rows]
        merged: list[list[int]] = []
        for first, last, n in sorted(found):
            if merged and first - merged[-1][1] < self.gap:
                merged[-1][1] = max(last, merged[-1][1])
                merged[-1][2] += n
            else:
                merged.append([first, last, n])
        after = {last for _, last, _ in merged}
        for last in before - after:
            self.handle.deleteTimer(self._due(last))
        for last in after - before:
            self.handle.registerTimer(self._due(last))
        self.open.put([tuple(s) for s in merged])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        over, rest = [], []
        for s in self.open.get():
            (over if self._due(s[1]) <= due else rest).append(tuple(s))
        if rest:
            self.open.put(rest)
        else:
            self.open.clear()
        if over:
            number = self.closed.get()[0] if self.closed.exists() else 0
            for k, (first, last, n) in enumerate(over, 1):
                yield Row(**{f: v for f, v in zip(self.names, (*key, first, last, n, number + k), strict=True)})
            self.closed.update((number + len(over),))

    def close(self) -> None:
        pass

    def _due(self, last: int) -> int:
        """Milliseconds at which a session is over; rounded up."""
        return -(-(last + self.gap) // 1000)


class FirstSeen(StatefulProcessor):
    """Lets the first event of a key through, and the next one again only after ``hours`` of processing time."""

    def __init__(self, hours: float):
        self.milliseconds = int(hours * 3_600_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "at long", self.milliseconds)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.seen.exists()
        first = min(rows, key=lambda r: r["at"])
        if not known:
            self.seen.update((first["at"],))
            yield first

    def close(self) -> None:
        pass


def _timed(events: DataFrame, by: str, time: str, late: str | None) -> DataFrame:
    """key, at (microseconds) and the event time that the watermark follows."""
    at = micros(events, time)
    rows = events.select(F.col(by).alias("key"), at.alias("at"), F.timestamp_micros(at).alias("event_time")).where("at IS NOT NULL")
    return rows if late is None else rows.withWatermark("event_time", late)


def session_stream(events: DataFrame, by: str, time: str, gap_seconds: int, late: str) -> DataFrame:
    """Every session of a key once it is over by the watermark: key, session_start, session_end (last time), n_events, number (from 1 by key).

    A pause of ``gap_seconds`` or more ends a session. Rows without a time are
    left out, null keys are one key. Rows later than ``late`` behind the latest
    time may be dropped.
    """
    rows = _timed(events, by, time, late)
    kind = rows.schema["key"].dataType.simpleString()
    processor = Sessions(gap_seconds)
    processor.names = ("key", "session_start", "session_end", "n_events", "number")
    shape = f"key {kind}, session_start long, session_end long, n_events long, number long"
    return rows.groupBy("key").transformWithState(processor, shape, "Append", "EventTime")


def first_seen(events: DataFrame, by: str, time: str, hours: float) -> DataFrame:
    """The earliest event of each key in the batch that first has it: key, at; the same again after the time to live.

    Start it with a trigger of processing time: state with a time to live keeps
    a query that takes what is available from ending by itself.
    """
    rows = _timed(events, by, time, None).select("key", "at")
    shape = f"key {rows.schema['key'].dataType.simpleString()}, at long"
    return rows.groupBy("key").transformWithState(FirstSeen(hours), shape, "Append", "ProcessingTime")
