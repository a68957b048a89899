"""Table functions for SQL: traces split in a query, the state of a conversation after each turn."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.udtf import UserDefinedTableFunction

from .text import CLOSERS, OPENERS, WHITE_SPACE


def _checked(rows: AnalyzeArgument, *names: str) -> StructType:
    """The columns of a table argument, which must have those named."""
    if not rows.isTable:
        raise ValueError("the first argument is a table: TABLE(...)")
    missing = [n for n in names if n not in rows.dataType.names]
    if missing:
        raise ValueError(f"the table has no column {', '.join(missing)}")
    return rows.dataType


class SplitTraces:
    """``SELECT * FROM split_traces(TABLE(t), 'response')``: the columns of the table with thinking and answer of a response."""

    @staticmethod
    def analyze(rows: AnalyzeArgument, column: AnalyzeArgument) -> AnalyzeResult:
        if column.isTable or not isinstance(column.value, str):
            raise ValueError("the second argument names the column with the responses")
        shape = _checked(rows, column.value)
        return AnalyzeResult(StructType([*shape.fields, StructField("thinking", StringType()), StructField("answer", StringType())]))

    def eval(self, row, column: str) -> Iterator[tuple]:
        body = row[column]
        thinking = answer = None
        if body is not None:
            body = next((body.removeprefix(o) for o in OPENERS if body.startswith(o)), body)
            closer = next((c for c in CLOSERS if c in body), None)
            thinking, _, answer = body.partition(closer) if closer else (body, "", "")
            thinking, answer = thinking.strip(WHITE_SPACE), answer.strip(WHITE_SPACE)
        yield *row, thinking, answer


class ConversationState:
    """``SELECT * FROM conversation_state(TABLE(turns))``: each turn with its number and the last text of every role so far.

    Rows are partitioned by conv_id and ordered by turn for the caller; a task
    holds one text per role, not the conversation.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
        shape = _checked(rows, "conv_id", "turn", "role", "text")
        texts = [StructField(n, StringType()) for n in ("last_user", "last_assistant")]
        return AnalyzeResult(
            StructType([shape["conv_id"], shape["turn"], StructField("number", LongType()), *texts]),
            partitionBy=[PartitioningColumn("conv_id")], orderBy=[OrderingColumn("turn")],
        )

    def __init__(self) -> None:
        self.number, self.last = 0, {}

    def eval(self, row) -> Iterator[tuple]:
        self.number += 1
        if row["text"]:
            self.last[row["role"] if row["role"] in ("user", "assistant") else ""] = row["text"]
        yield row["conv_id"], row["turn"], self.number, self.last.get("user"), self.last.get("assistant")


def register(spark: SparkSession) -> None:
    """Make the functions known to the session's SQL."""
    from pyspark.sql.functions import udtf

    for name, handler in (("split_traces", SplitTraces), ("conversation_state", ConversationState)):
        made: UserDefinedTableFunction = udtf(handler)
        spark.udtf.register(name, made)
