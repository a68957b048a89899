"""Counts over windows of event time: one definition for tables and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.temporal import micros


def window_counts(events: DataFrame, time: str, width: str, slide: str | None = None, by: Sequence[str] = (), late: str | None = None) -> DataFrame:
    """Rows in every tumbling window, or every sliding one (``slide``): window_start, window_end (microseconds), ``by``, n_events.

    Windows begin at multiples of ``slide`` since 1970 and hold their beginning,
    not their end. ``late``: how far behind the latest time a stream still takes
    rows; older ones are dropped, and a window is emitted once it can get no
    more. Tables take all rows. Rows without a time are in no window. Counts are
    partial before the exchange, and state holds one row for each open window
    and ``by``.
    """
    if events.isStreaming and late is None:
        raise ValueError("a stream needs to know how late rows may come")
    rows = _watermarked(events, time, late) if late is not None else events
    counts = rows.groupBy(F.window(time, width, slide), *by).agg(F.count("*").alias("n_events"))
    bounds = counts.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n_events")
    return bounds.select(micros(bounds, "start").alias("window_start"), micros(bounds, "end").alias("window_end"), *by, "n_events")


def session_counts(events: DataFrame, time: str, gap: str, by: Sequence[str], late: str) -> DataFrame:
    """Sessions of a stream by Spark's session windows: ``by``, session_start, session_end (last time plus gap, microseconds), n_events."""
    counts = _watermarked(events, time, late).groupBy(*by, F.session_window(time, gap)).agg(F.count("*").alias("n_events"))
    bounds = counts.select(*by, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n_events")
    return bounds.select(*by, micros(bounds, "start").alias("session_start"), micros(bounds, "end").alias("session_end"), "n_events")


def _watermarked(events: DataFrame, time: str, late: str) -> DataFrame:
    """With times as instants, which watermarks ask for; those without a zone as they read."""
    return events.withColumn(time, F.timestamp_micros(micros(events, time))).withWatermark(time, late)


def event_stream(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 64) -> DataFrame:
    """Parquet files of events as a stream, in the order in which they came."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def append_available(rows: DataFrame, output: str, state: str) -> StreamingQuery:
    """Append what is final to Parquet files and stop when all present files are read; ``state`` lets the next call go on."""
    return rows.writeStream.format("parquet").outputMode("append").option("path", output).option("checkpointLocation", state).trigger(availableNow=True).start()
