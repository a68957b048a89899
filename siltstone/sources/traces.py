"""Reasoning-trace shards: schema sniffing and the three projections to the record schema."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import compact_list, field_or_blank, split_trace, unicode_trim
from ..schemas import RECORD_FIELDS

HUB = "https://huggingface.co/api/datasets"  # listings are at <hub>/<repo>/parquet/<config>/<split>
USER_ROLES, ASSISTANT_ROLES = ("user", "human"), ("assistant", "gpt")


def _field(df: DataFrame, name: str, kind: type) -> bool:
    return name in df.columns and isinstance(df.schema[name].dataType, kind)


def _list_of(df: DataFrame, name: str, kind: type) -> bool:
    return _field(df, name, T.ArrayType) and isinstance(df.schema[name].dataType.elementType, kind)


def trace_layout(df: DataFrame) -> str:
    """flat, generations or messages, in this order of precedence; anything else is an error. Only the schema is looked at."""
    if {"response", "instruction"} <= set(df.columns):
        return "flat"
    if "problem" in df.columns and _field(df, "generations", T.ArrayType):
        return "generations"
    if _list_of(df, "messages", T.StructType) and "content" in df.schema["messages"].dataType.elementType.names:
        return "messages"
    raise ValueError(f"unrecognized trace schema: {df.columns}")


def optional_string(df: DataFrame, name: str) -> Column:
    """A trimmed string column; absent, of another type or null is ''."""
    return field_or_blank(name) if _field(df, name, T.StringType) else F.lit("")


def _records(df: DataFrame, keep: tuple[str, ...], **fields: Column) -> DataFrame:
    return df.select(*keep, *[fields.get(f, F.lit("")).alias(f) for f in RECORD_FIELDS])


def records_from_flat(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    parts = df.withColumn("__parts", split_trace(F.coalesce("response", F.lit(""))))
    optional = {c: optional_string(df, c) for c in ("intent", "task_category", "difficulty", "language")}
    return _records(
        parts, keep, instruction=field_or_blank("instruction"), thinking=F.col("__parts.thinking"), response=F.col("__parts.answer"), **optional
    )


def verified_generation(generations: Column, correct: Column) -> Column:
    """The first generation marked correct, else the first; null elements count neither here nor there. Null if there is none."""
    gens = compact_list(generations)
    flags = compact_list(correct)
    at = F.array_position(F.slice(flags, 1, F.greatest(F.size(gens), F.lit(0))), True)
    return F.try_element_at(gens, F.greatest(F.coalesce(at, F.lit(0)), F.lit(1)).cast("int"))


def records_from_generations(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows without a generation are dropped; an empty parsed answer falls back to the reference answer."""
    correct = F.col("correctness_math_verify") if _list_of(df, "correctness_math_verify", T.BooleanType) else F.array().cast("array<boolean>")
    chosen = df.withColumn("__generation", verified_generation(F.col("generations"), correct)).where(F.col("__generation").isNotNull())
    parts = chosen.withColumn("__parts", split_trace("__generation"))
    answer = F.when(F.col("__parts.answer") != "", F.col("__parts.answer")).otherwise(optional_string(df, "answer"))
    return _records(
        parts, keep, instruction=field_or_blank("problem"), thinking=F.col("__parts.thinking"), response=answer, task_category=optional_string(df, "problem_type")
    )


def conversation_fields(contents: Column, roles: Column) -> Column:
    """struct(instruction, thinking, response) of parallel lists.

    The last user turn gives the instruction, even a blank one; thinking and
    response are the last non-empty ones of assistant turns, which may be
    different turns. Turns beyond the list of roles are ignored.
    """
    turns = F.filter(F.zip_with(roles, contents, lambda r, c: F.struct(r.alias("role"), c.alias("content"))), lambda t: t["content"].isNotNull())
    asked = F.filter(turns, lambda t: t["role"].isin(*USER_ROLES))
    parsed = F.transform(F.filter(turns, lambda t: t["role"].isin(*ASSISTANT_ROLES)), lambda t: split_trace(t["content"]))
    last = lambda part: F.coalesce(
        F.try_element_at(F.filter(F.transform(parsed, lambda p: p[part]), lambda x: x != ""), F.lit(-1)), F.lit("")
    )
    return F.struct(
        F.coalesce(F.try_element_at(F.transform(asked, lambda t: unicode_trim(t["content"])), F.lit(-1)), F.lit("")).alias("instruction"),
        last("thinking").alias("thinking"), last("answer").alias("response"),
    )


def within_budget(df: DataFrame, most: int, column: str = "num_tokens") -> DataFrame:
    """Rows of at most so many tokens; null counts as 0, 0 or an absent column means no limit. Pushes down to the scan."""
    if most <= 0 or not _field(df, column, T.IntegralType):
        return df
    return df.where(F.col(column).isNull() | (F.col(column) <= most))


def records_from_messages(df: DataFrame, keep: tuple[str, ...] = (), max_tokens: int = 0) -> DataFrame:
    """contents and roles are compacted apart from each other, as sibling columns."""
    rows = within_budget(df, max_tokens)
    named = "role" in df.schema["messages"].dataType.elementType.names
    messages = F.coalesce("messages", F.array())
    contents = F.array_compact(F.transform(messages, lambda m: m["content"]))
    roles = F.array_compact(F.transform(messages, lambda m: m["role"])) if named else F.array().cast("array<string>")
    turns = rows.withColumn("__turns", conversation_fields(contents, roles))
    return _records(
        turns, keep, instruction=F.col("__turns.instruction"), thinking=F.col("__turns.thinking"), response=F.col("__turns.response"), source=optional_string(df, "source")
    )


def ingest(df: DataFrame, keep: tuple[str, ...] = (), max_tokens: int = 0) -> DataFrame:
    """Records of a shard or a dataset of any of the three layouts, with the columns ``keep``; blank records are dropped."""
    layout = trace_layout(df)
    if layout == "flat":
        records = records_from_flat(df, keep)
    elif layout == "generations":
        records = records_from_generations(df, keep)
    else:
        records = records_from_messages(df, keep, max_tokens)
    return records.where(~((F.col("instruction") == "") & (F.col("thinking") == "")))


def read_shards(spark: SparkSession, *paths: str) -> DataFrame:
    """Shards as one DataFrame with their place (file_path, row_index), for orders and limits that agree between runs."""
    return spark.read.parquet(*paths).select("*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("row_index"))


class ShardListReader(DataSourceReader):
    def __init__(self, options):
        self.url, self.timeout = options["url"], float(options.get("timeout", "90"))

    def partitions(self):
        return [InputPartition(self.url)]

    def read(self, partition):
        from .catalog import fetch

        shards = json.loads(fetch(partition.value, self.timeout))
        if not shards:
            raise ValueError(f"no shards at {partition.value}")
        yield from enumerate(shards)


class ShardListSource(DataSource):
    """``spark.read.format("shard_list")``: ordinal and url of the Parquet shards that a hub's JSON listing names. Options: url, timeout."""

    @classmethod
    def name(cls):
        return "shard_list"

    def schema(self):
        return "ordinal int, url string"

    def reader(self, schema):
        return ShardListReader(self.options)


def listed_shards(spark: SparkSession, url: str) -> DataFrame:
    """ordinal and url of the shards that a listing names; an empty listing is an error."""
    spark.dataSource.register(ShardListSource)
    return spark.read.format("shard_list").option("url", url).load()


def shard_plan(shards: DataFrame, slug: str) -> DataFrame:
    """ordinal, key, url and size of the shards, as a download plan."""
    key = F.format_string(f"datasets/reasoning/{slug}/shard-%05d.parquet", "ordinal")
    return shards.select("ordinal", key.alias("key"), "url", F.lit(0).cast("bigint").alias("size"))
