"""Operators over time, totals and sketches against plain Python: hot keys, ties, nulls, empty tables."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import sketches, temporal, totals

SHAPE = "id int, k string, at timestamp_ntz, bucket int, found string"


def rows(seed, n=300):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        key = rng.choice(("hot", "hot", "hot", "a", "b", None))
        at = None if rng.random() < 0.05 else rng.choice((rng.randint(0, 50), rng.randint(0, 5000), -rng.randint(1, 400)))
        out.append((k, key, at, k, "x"))
    return out


def frame(spark, data):
    df = spark.createDataFrame(data, "id int, k string, s long, bucket int, found string")
    at = F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, s)")
    return df.select("id", "k", at.alias("at"), "bucket", "found")


@pytest.mark.parametrize("most", [1_000_000, 7])
@pytest.mark.parametrize("or_equal", [False, True])
def test_as_of(spark, most, or_equal):
    left, right = rows(1), rows(2, 200)
    found = temporal.as_of(frame(spark, left), frame(spark, right), ["k"], "at", "at", ties=["id"], or_equal=or_equal, name="match", most=most)
    want = {}
    for i, k, s, *_ in left:
        fits = [(t, j) for j, q, t, *_ in right if None not in (k, s, t) and q == k and (t <= s if or_equal else t < s)]
        want[i] = max(fits)[1] if fits else None
    assert found.columns == ["id", "k", "at", "bucket", "found", "match"]
    assert {r["id"]: r["match"] and r["match"]["id"] for r in found.collect()} == want and found.count() == len(left)
    none = frame(spark, right).limit(0)
    assert temporal.as_of(none, frame(spark, right), ["k"], "at", "at", name="match").count() == 0


def test_as_of_without_ties_and_an_empty_side(spark):
    left = frame(spark, rows(3, 40)).drop("found")
    found = temporal.as_of(left, left.limit(0), ["k"], "at", "at")
    assert found.count() == 40 and found.where("found IS NOT NULL").count() == 0



def test_interval_join(spark):
    rng = random.Random(4)
    points = rows(5)
    spans = [(k, rng.choice(("hot", "a", None)), None if k == 3 else (b := rng.randint(-300, 5000)), None if k == 4 else (b if k != 3 else 0) + rng.choice((-5, 0, 1, 3, 4, 16, 64, 1000, 100_000))) for k in range(120)]
    df = spark.createDataFrame(spans, "span int, k string, a long, b long")
    at = lambda c: F.expr(f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {c})")
    pairs = temporal.interval_join(frame(spark, points), df.select("span", "k", at("a").alias("at"), at("b").alias("lo")), "at", "at", "lo", ["k"])
    want = sorted((i, j) for i, k, s, *_ in points for j, q, a, b in spans if None not in (k, s, a, b) and k == q and a <= s < b)
    assert sorted((r["point"]["id"], r["interval"]["span"]) for r in pairs.collect()) == want
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = df.select("span", "k", at("a").alias("at"), at("b").alias("lo")).limit(0)
    assert temporal.interval_join(frame(spark, points), none, "at", "at", "lo").count() == 0


def test_trailing(spark):
    data = rows(6)
    found = temporal.trailing(frame(spark, data), ["k"], "at", 60, n=lambda r: F.count(r["id"]), total=lambda r: F.sum(r["id"]))
    want = {}
    for i, k, s, *_ in data:
        own = [j for j, q, t, *_ in data if None not in (s, t) and q == k and s - 60 <= t <= s]
        want[i] = (len(own), sum(own)) if s is not None else (None, None)
    assert {r["id"]: (r["n"], r["total"]) for r in found.collect()} == want and found.columns == ["id", "k", "at", "bucket", "found", "n", "total"]


def plain_sessions(data, gap):
    out = []
    for key in {k for _, k, *_ in data}:
        own = sorted((s, i) for i, k, s, *_ in data if k == key and s is not None)
        for n, (s, i) in enumerate(own):
            if n == 0 or s - own[n - 1][0] >= gap:
                out.append([key, s * 1_000_000, s * 1_000_000, 0, 0])
            out[-1][2], out[-1][3], out[-1][4] = s * 1_000_000, out[-1][3] + 1, out[-1][4] + i
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("most", [1_000_000, 5])
def test_sessions(spark, most):
    data = rows(7)
    found = temporal.sessions(frame(spark, data), ["k"], "at", 30, "id", most)
    assert found.columns == ["k", "session_start", "session_end", "n_events", "total"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain_sessions(data, 30)


def test_times_of_every_kind(spark):
    row = "timestamp_ntz'1969-12-31 23:59:59.999999' n, timestamp'2024-03-31 01:30:00Z' t, date'1970-01-02' d, 5 i"
    df = spark.sql(f"SELECT {row}")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", z)
            got = tuple(df.select(*(temporal.micros(df, c).alias(c) for c in "ntdi")).first())
            assert got == (-1, 1711848600000000, temporal.DAY, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_grouping_totals_tell_nulls_from_totals(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", None), (None, None, 4)], "p string, q string, n long").withColumnRenamed("n", "size")
    found = totals.grouping_totals(df, ["p", "q"], totals.cube_sets(["p", "q"]), bytes=F.col("size"))
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    want = [("a", None, 0, 1, 1), ("a", "x", 0, 1, 0), (None, None, 0, 1, 4), ("a", None, 1, 2, 1), (None, None, 1, 1, 4), (None, None, 2, 2, 5), (None, "x", 2, 1, 0), (None, None, 3, 3, 5)]
    assert got == sorted(want, key=repr)
    assert totals.grouping_totals(df.limit(0), ["p", "q"], totals.rollup_sets(["p", "q"]), bytes=F.col("size")).count() == 0
    with pytest.raises(ValueError):
        totals.grouping_totals(df, ["p"], [["q"]])


def test_sketches_merge_in_any_order(spark, tmp_path):
    df = spark.range(60_000).selectExpr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 10 as int)) AS ts", "id % 20011 AS item", "cast(id AS double) AS value")
    daily = sketches.daily_sketches(df.unionByName(spark.sql("SELECT cast(null as timestamp_ntz) ts, 1L item, 1D value")), "ts", "item", "value")
    daily.write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    told = sketches.estimates(sketches.merged(stored), 0.1, 0.5).first()
    assert told["n"] == 60_000 and abs(told["distinct_items"] - 20_011) < 600 and abs(told["q50"] - 30_000) < 1200 and abs(told["q10"] - 6000) < 1200
    trailing = {str(r["day"]): r for r in sketches.estimates(sketches.trailing_days(stored, 3), 0.5).collect()}
    assert len(trailing) == 10 and trailing["2024-01-01"]["n"] == 6000 and trailing["2024-01-05"]["n"] == 18_000
    exact = df.where("ts BETWEEN timestamp_ntz'2024-01-03 00:00:00' AND timestamp_ntz'2024-01-05 00:00:00'").select("item").distinct().count()
    assert abs(trailing["2024-01-05"]["distinct_items"] - exact) < 0.03 * exact
    assert sketches.merged(stored.limit(0), ["day"]).count() == 0
