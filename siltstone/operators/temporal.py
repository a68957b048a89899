"""Joins and frames over time: as-of, intervals, trailing frames and sessions.

A key may hold a large part of all rows, so no operator sorts a whole key in one
task where time can split it: rows are dealt by key and a bucket of time, and
what a bucket needs from earlier ones is carried over as few rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one key that a task may sort; keys with more are split by time.
ROWS_PER_BUCKET = 1_000_000


DAY = 86_400_000_000


def micros(rows: DataFrame, time: str) -> Column:
    """Microseconds since 1970 of a column of times, or of whole numbers that already are such.

    A timestamp without time zone counts as it reads, whatever the session's zone.
    """
    kind, at = rows.schema[time].dataType, F.col(time)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(at)
    if isinstance(kind, T.IntegralType):
        return at.cast("long")
    days = F.datediff(at.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * DAY
    if isinstance(kind, T.DateType):
        return days
    second = (F.date_part(F.lit("SECOND"), at) * 1_000_000).cast("long")
    return days + (F.hour(at) * 3600 + F.minute(at) * 60).cast("long") * 1_000_000 + second


def floored(at: Column, width: Column | int) -> Column:
    """Number of the bucket of so much width that holds a number; exact for negative ones too."""
    width = F.lit(width).cast("long")
    return ((at - F.pmod(at, width)) / width).cast("long")


def bucket_width(rows: DataFrame, key: str, at: str, most: int) -> int | None:
    """Width of time buckets that keep the rows of the most frequent key below about ``most`` each; None if no key needs any.

    One aggregate with partial counts. Rows of a key that crowd at one time stay together.
    """
    per_key = rows.where(F.col(key).isNotNull() & F.col(at).isNotNull()).groupBy(key).agg(F.count("*").alias("n"), (F.max(at) - F.min(at) + 1).alias("span"))
    width = per_key.where(F.col("n") > most).agg(F.min(F.col("span") * F.lit(most) / F.col("n"))).first()[0]
    return None if width is None else max(1, int(width))


def as_of(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, ties: Sequence[str] = (), or_equal: bool = False, name: str = "found", most: int = ROWS_PER_BUCKET) -> DataFrame:
    """Every row of ``left`` with the latest earlier row of ``right`` with equal ``by`` columns, as a struct column ``name`` (null if there is none).

    or_equal: a row at the same time counts as earlier. Of several rows of
    ``right`` at one time the last in the order of ``ties`` is found. Null keys
    and null times find nothing and are found by nothing; repeated rows of
    ``left`` stay. Both sides are united and sorted by (key, bucket of time), so
    the exchange is one of both sides, and a frequent key is split; each bucket
    gets one row carried over from the buckets before it.
    """
    key = F.when(_all_there(by), F.struct(*by)).alias("key")
    none = F.lit(None)
    rows = left.select(key, micros(left, left_time).alias("at"), F.lit(1 if or_equal else 0).alias("side"), F.struct("*").alias("row"))
    found = right.select(key, micros(right, right_time).alias("at"), F.lit(0 if or_equal else 1).alias("side"), F.struct("*").alias("found")).where("key IS NOT NULL AND at IS NOT NULL")
    rows = rows.withColumn("tie", none.cast(_tie_type(right, ties)))
    found = found.withColumn("tie", F.struct(*[F.col("found")[c].alias(c) for c in ties]) if ties else F.lit(0))
    lone = rows.where("key IS NULL OR at IS NULL").select("row", none.cast(found.schema["found"].dataType).alias("found"))
    rows = rows.where("key IS NOT NULL AND at IS NOT NULL")
    both = rows.unionByName(found, allowMissingColumns=True)
    width = bucket_width(both.select("key", "at"), "key", "at", most)
    if width is None:
        frame = Window.partitionBy("key")
    else:
        both = both.withColumn("bucket", floored(F.col("at"), width))
        both = both.unionByName(_carried(rows, found, width), allowMissingColumns=True)
        frame = Window.partitionBy("key", "bucket")
    frame = frame.orderBy("at", "side", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = both.select("row", F.last("found", ignorenulls=True).over(frame).alias("found")).where("row IS NOT NULL")
    return out.unionByName(lone).select("row.*", F.col("found").alias(name))


def _all_there(columns: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def _tie_type(right: DataFrame, ties: Sequence[str]) -> str:
    return right.select(*ties).schema.simpleString() if ties else "int"


def _carried(rows: DataFrame, found: DataFrame, width: int) -> DataFrame:
    """For each (key, bucket) of rows the last found row of the buckets before it, at the bucket's beginning."""
    bucket = floored(F.col("at"), width).alias("bucket")
    last = found.groupBy("key", bucket).agg(F.max_by("found", F.struct("at", "tie")).alias("found"))
    wanted = rows.select("key", bucket).distinct()
    steps = wanted.join(last, ["key", "bucket"], "full").withColumn("wanted", F.lit(True))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = steps.select("key", "bucket", F.last("found", ignorenulls=True).over(before).alias("found")).where("found IS NOT NULL")
    return carried.select("key", (F.col("bucket") * width).alias("at"), F.lit(-1).alias("side"), "found", "bucket")


def interval_join(points: DataFrame, intervals: DataFrame, time: str, start: str, end: str, by: Sequence[str] = ()) -> DataFrame:
    """Pairs of a point and an interval that holds it (start <= time < end) and agrees in the ``by`` columns: structs point and interval.

    Every interval goes to bins about as wide as itself (by powers of four), of
    which it touches two at most; a point goes to its bin of each width that
    occurs. So the join is on equal keys, and short intervals are not compared
    with far points because of long ones. Null times, bounds and keys, and
    intervals that end before they begin, join with nothing.
    """
    lo, hi = micros(intervals, start), micros(intervals, end)
    spans = intervals.select(*by, lo.alias("lo"), hi.alias("hi"), F.struct("*").alias("interval")).where("lo < hi")
    spans = spans.withColumn("level", F.ceil(F.log2((F.col("hi") - F.col("lo")).cast("double")) / 2).cast("int"))
    levels = sorted(r[0] for r in spans.select("level").distinct().collect())  # 32 at most
    wide = lambda level: F.call_function("shiftleft", F.lit(1).cast("long"), F.col(level) * 2)
    width = wide("level")
    bins = F.explode(F.sequence(floored(F.col("lo"), width), floored(F.col("hi") - 1, width)))
    spans = spans.select(*(F.col(c).alias(f"_{c}") for c in by), "level", "lo", "hi", "interval", bins.alias("bin"))
    at = points.select(*by, micros(points, time).alias("at"), F.struct("*").alias("point")).where("at IS NOT NULL")
    at = at.select("*", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")).alias("level_"))
    at = at.withColumn("bin_", floored(F.col("at"), wide("level_")))
    same = (F.col("level") == F.col("level_")) & (F.col("bin") == F.col("bin_"))
    for c in by:
        same = same & (F.col(c) == F.col(f"_{c}"))
    return at.join(spans, same).where("lo <= at AND at < hi").select("point", "interval")


def trailing(rows: DataFrame, by: Sequence[str], time: str, seconds: int, **values: Callable[[Column], Column]) -> DataFrame:
    """The rows with aggregates of the rows of their key in the last ``seconds`` up to and with their own time.

    values: name = aggregate of the row, as ``total=lambda r: F.sum(r["x"])``. Rows at the same time
    count each other. A bucket of time as wide as the frame also gets the rows
    of the bucket before it, so a frequent key is split by time. Null keys are
    one key; rows without a time have null aggregates.
    """
    width = seconds * 1_000_000
    placed = rows.select(F.struct("*").alias("row"), micros(rows, time).alias("at"), F.struct(*by).alias("key"))
    placed = placed.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("later"))
    placed = placed.withColumn("bucket", floored(F.col("at"), width) + F.col("later"))
    frame = Window.partitionBy("key", "bucket").orderBy("at").rangeBetween(-width, Window.currentRow)
    told = {n: v(F.col("row")).over(frame) for n, v in values.items()}
    out = placed.where("at IS NOT NULL").select("row", "later", *(c.alias(f"_{n}") for n, c in told.items())).where("later = 0")
    out = out.select("row.*", *(F.col(f"_{n}").alias(n) for n in values))
    kinds = [out.schema[n].dataType for n in values]
    return out.unionByName(placed.where("at IS NULL AND later = 0").select("row.*", *(F.lit(None).cast(k).alias(n) for n, k in zip(values, kinds, strict=True))))


def sessions(events: DataFrame, by: Sequence[str], time: str, gap_seconds: int, value: str | None = None, most: int = ROWS_PER_BUCKET) -> DataFrame:
    """Sessions of each key: its rows with no pause of ``gap_seconds`` or more between them.

    Columns: ``by``, session_start and session_end (first and last time, in
    microseconds), n_events, and total (of ``value``) if it is named. Rows
    without a time belong to no session; null keys are one key. Sessions are
    found inside buckets of time first where a key is frequent, and those that
    touch across buckets become one, which takes one row for each session.
    """
    gap = gap_seconds * 1_000_000
    total = F.col(value) if value else F.lit(0)
    rows = events.select(F.struct(*by).alias("key"), micros(events, time).alias("first"), total.alias("total")).where("first IS NOT NULL")
    rows = rows.select("key", "first", F.col("first").alias("last"), F.lit(1).cast("long").alias("n"), "total")
    width = bucket_width(rows, "key", "first", most)
    if width is not None:
        rows = _islands(rows.withColumn("bucket", floored(F.col("first"), width)), ["key", "bucket"], gap)
    out = _islands(rows, ["key"], gap)
    named = [F.col("first").alias("session_start"), F.col("last").alias("session_end"), F.col("n").alias("n_events")]
    return out.select("key.*", *named, *([F.col("total")] if value else []))


def _islands(rows: DataFrame, keys: list[str], gap: int) -> DataFrame:
    """Unite the rows (first, last, n, total) of each key that lie less than ``gap`` apart; none of them overlap otherwise than at their ends."""
    order = Window.partitionBy(*keys).orderBy("first", "last")
    fresh = F.coalesce(F.col("first") - F.lag("last").over(order) >= gap, F.lit(True))
    numbered = rows.select("*", fresh.cast("int").alias("fresh"))
    numbered = numbered.withColumn("island", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    parts = [F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"), F.sum("total").alias("total")]
    return numbered.groupBy(*keys, "island").agg(*parts).drop("island", "bucket")
