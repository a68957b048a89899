"""Streams over event time: what is late, what is final, and going on from a checkpoint."""

import random
import time

import pytest
from pyspark.sql import functions as F

from siltstone.operators import temporal
from siltstone.streaming import sessions, windows

SCHEMA = "event_id long, ts timestamp_ntz, user_id long"


def put(spark, folder, rows):
    """One file of events (id, second, user), read as one batch."""
    df = spark.createDataFrame(rows, "event_id long, s long, user_id long")
    at = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s)")
    df.select("event_id", at.alias("ts"), "user_id").coalesce(1).write.mode("append").parquet(folder)


def run(rows, out, state):
    query = windows.append_available(rows, out, state)
    query.awaitTermination(120)
    assert query.exception() is None


def start(spark, folder):
    return windows.event_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, 1)


def test_windows_drop_late_rows_and_equal_a_table(spark, tmp_path):
    folder, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    rng = random.Random(1)
    first = [(k, rng.randint(0, 7200), k % 3) for k in range(200)]
    put(spark, folder, first)
    counts = lambda: windows.window_counts(start(spark, folder), "ts", "10 minutes", by=["user_id"], late="5 minutes")
    run(counts(), out, state)
    second = [(1000 + k, rng.randint(7200, 9000), 1) for k in range(50)]
    put(spark, folder, second)
    run(counts(), out, state)
    put(spark, folder, [(2000, 30, 1), (2001, 100_000, 2)])  # the first is too late by now, the second ends all windows before it
    run(counts(), out, state)
    put(spark, folder, [(3000, 100_001, 2)])
    run(counts(), out, state)
    table = spark.createDataFrame(first + second, "event_id long, s long, user_id long")
    table = table.select("event_id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s)").alias("ts"), "user_id")
    want = sorted(map(tuple, windows.window_counts(table, "ts", "10 minutes", by=["user_id"]).collect()))
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == want
    with pytest.raises(ValueError):
        windows.window_counts(start(spark, folder), "ts", "10 minutes")


def test_sliding_windows_of_a_table(spark):
    df = spark.sql("SELECT timestamp_ntz'1970-01-01 00:59:59.5' AS ts UNION ALL SELECT timestamp_ntz'1970-01-01 01:00:00' UNION ALL SELECT null")
    got = sorted((r["window_start"] // 60_000_000, r["window_end"] // 60_000_000, r["n_events"]) for r in windows.window_counts(df, "ts", "1 hour", "30 minutes").collect())
    assert got == [(0, 60, 1), (30, 90, 2), (60, 120, 1)]


@pytest.mark.parametrize("kind", ["state", "window"])
def test_sessions_of_a_stream_equal_those_of_a_table(spark, tmp_path, kind):
    sessions.keep_state_on_disk(spark)
    folder, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    rng = random.Random(2)
    batches = [[(100 * b + k, 600 * b + rng.randint(0, 700), rng.choice((1, 1, 2, 3))) for k in range(40)] for b in range(4)]

    def found():
        if kind == "state":
            return sessions.session_stream(start(spark, folder), "user_id", "ts", 60, "10 minutes")
        return windows.session_counts(start(spark, folder), "ts", "60 seconds", ["user_id"], "10 minutes")

    for rows in batches[:2]:
        put(spark, folder, rows)
    run(found(), out, state)
    for rows in batches[2:]:  # a new query goes on from the checkpoint
        put(spark, folder, rows)
    run(found(), out, state)
    put(spark, folder, [(9000, 1_000_000, 9)])
    run(found(), out, state)
    put(spark, folder, [(9001, 1_000_001, 9)])
    run(found(), out, state)
    rows = [r for b in batches for r in b]
    table = spark.createDataFrame(rows, "event_id long, s long, user_id long")
    table = table.select(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s)").alias("ts"), "user_id")
    want = sorted(map(tuple, temporal.sessions(table, ["user_id"], "ts", 60).collect()))
    got = spark.read.parquet(out)
    if kind == "state":
        assert sorted(tuple(r)[:4] for r in got.collect()) == want
        numbers = {}
        for r in got.collect():
            numbers.setdefault(r["key"], []).append(r["number"])
        assert all(sorted(n) == list(range(1, len(n) + 1)) for n in numbers.values())
    else:
        gap = 60_000_000
        assert sorted(tuple(r) for r in got.collect()) == [(k, a, b + gap, n) for k, a, b, n in want]


def test_first_seen_lets_a_key_through_once(spark, tmp_path):
    sessions.keep_state_on_disk(spark)
    folder, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    put(spark, folder, [(1, 5, 1), (2, 3, 1), (3, 9, 2)])
    rows = sessions.first_seen(start(spark, folder), "user_id", "ts", 24)
    query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(processingTime="1 second").start()

    def read(n):
        """Wait until the query has read so many rows."""
        for _ in range(240):
            if query.exception() is not None or sum(p["numInputRows"] for p in query.recentProgress) >= n:
                return
            time.sleep(0.25)

    try:
        read(3)
        put(spark, folder, [(4, 1, 1), (5, 7, 3)])
        read(5)
    finally:
        query.stop()
    epoch = 1_704_067_200
    assert sorted((r["key"], r["at"] // 1_000_000 - epoch) for r in spark.read.parquet(out).collect()) == [(1, 3), (2, 9), (3, 7)]
