"""Operators on trace records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import format_document, split_trace, unicode_trim
from ..schemas import RECORD_FIELDS
from ..session import stage_table
from ..sources.traces import ASSISTANT_ROLES, USER_ROLES

ALWAYS = ("instruction", "thinking", "response")


def complete() -> Column:
    return (F.col("thinking") != "") & (F.col("response") != "")


def not_blank() -> Column:
    return ~((F.col("instruction") == "") & (F.col("thinking") == ""))


def document() -> Column:
    return format_document(F.col("instruction"), F.col("intent"), F.col("thinking"), F.col("response"))


def json_line() -> Column:
    """One JSON object; optional fields only where they are not empty."""
    return F.to_json(F.struct(*[F.col(f) if f in ALWAYS else F.nullif(F.col(f), F.lit("")).alias(f) for f in RECORD_FIELDS]))


def summary(records: DataFrame) -> DataFrame:
    """Records and complete records, in one pass."""
    return records.agg(F.count("*").alias("records"), F.count_if(complete()).alias("complete"))


def from_turns(turns: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """instruction, thinking and response of every conversation in row form: an aggregate, partial before its exchange."""
    parsed = turns.withColumn("__parts", split_trace(text))
    asked, told = F.col(role).isin(*USER_ROLES), F.col(role).isin(*ASSISTANT_ROLES)

    def last(value: Column, when: Column) -> Column:
        return F.coalesce(F.max_by(value, F.when(when, F.col(turn))), F.lit(""))

    return parsed.groupBy(conversation).agg(
        last(unicode_trim(F.coalesce(text, F.lit(""))), asked).alias("instruction"),
        last(F.col("__parts.thinking"), told & (F.col("__parts.thinking") != "")).alias("thinking"),
        last(F.col("__parts.answer"), told & (F.col("__parts.answer") != "")).alias("response"),
    )


def limited(records: DataFrame, order: list[str], most: int) -> DataFrame:
    """The first records in a given order; rows dropped before don't count."""
    return records.orderBy(*order).limit(most)


def numbered(records: DataFrame, order: str, by_range: int | None = None) -> DataFrame:
    """Add rn, the number of every row in the order of a unique column, without a window over all rows.

    Rows are dealt to ranges of the column, written once, and numbered inside
    their range; a table with one row per range tells how many come before.
    """
    n = by_range or int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage_table(records.repartitionByRange(n, order).withColumn("__block", F.spark_partition_id()))
    earlier = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("__block").agg(F.count("*").alias("__n"))
    before = counts.select("__block", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inner = F.row_number().over(Window.partitionBy("__block").orderBy(order))
    return dealt.join(F.broadcast(before), "__block").withColumn("rn", inner + F.col("__before")).drop("__block", "__before")


def chunked(records: DataFrame, order: str, per_file: int = 1000) -> DataFrame:
    """Add file_seq (from 0) and position (from 1 in its file) in the order of a unique column."""
    rows = numbered(records, order)
    return rows.select("*", F.floor((F.col("rn") - 1) / per_file).alias("file_seq"), ((F.col("rn") - 1) % per_file + 1).alias("position")).drop("rn")


def last_values(turns: DataFrame, conversation: str, turn: str, text: str) -> DataFrame:
    """Every turn with the last non-empty text of its conversation up to it."""
    frame = Window.partitionBy(conversation).orderBy(turn).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return turns.withColumn("last_text", F.last(F.nullif(F.col(text), F.lit("")), ignorenulls=True).over(frame))
