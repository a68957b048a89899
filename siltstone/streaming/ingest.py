"""Trace shards as a stream: the projections are stateless, so every new shard is ingested once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.records import complete, json_line
from ..sources.traces import ingest


def stream_records(spark: SparkSession, folder: str, schema: StructType, max_tokens: int = 0, files_per_batch: int = 64) -> DataFrame:
    shards = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return ingest(shards, max_tokens=max_tokens)


def ingest_available(spark: SparkSession, folder: str, schema: StructType, output: str, state: str) -> StreamingQuery:
    """Append the complete records of all shards not seen yet as JSON lines; ``state`` remembers the shards."""
    records = stream_records(spark, folder, schema)
    lines = records.where(complete()).select(json_line().alias("value"))
    return lines.writeStream.format("text").option("path", output).option("checkpointLocation", state).trigger(availableNow=True).start()
