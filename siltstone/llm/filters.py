"""Rows that may have a key of a table, found without moving them: a bit table of fixed size is broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 18  # 64-bit words of a bit table: 2 MB, whatever the number of keys


class BitFilter:
    """Bits of the hashes of keys. A key of the table always passes; others rarely, as long as there are fewer than some millions.

    Where there are more, more rows pass and take the exact way behind the
    filter: results stay the same.
    """

    def __init__(self, keys: DataFrame, key: str):
        self.table = keys.select(self._word(F.col(key)).alias("bit_word"), self._bit(F.col(key)).alias("bit"))
        self.table = F.broadcast(self.table.groupBy("bit_word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")))

    @staticmethod
    def _word(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(WORDS))

    @staticmethod
    def _bit(key: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(key), 58).cast("int")

    def mark(self, rows: DataFrame, key: str) -> DataFrame:
        """The rows with a boolean column ``maybe``. Rows have no columns bit_word, bit_place, bits and maybe."""
        marked = rows.select("*", self._word(F.col(key)).alias("bit_word"), self._bit(F.col(key)).alias("bit_place")).join(self.table, "bit_word", "left")
        return marked.withColumn("maybe", F.expr("coalesce(shiftright(bits, bit_place) & 1L, 0L) = 1L")).drop("bit_word", "bit_place", "bits")
