"""Compact columns of 64-bit numbers for exchanges of n-grams, and hashing of words to them.

An exchange of single n-gram rows moves tens of bytes for each; here the
n-grams of many documents go to a bucket as one sorted, delta-coded block of a
few bytes each.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_CACHE = 100_000
MOST_PARTITIONS = 8192  # of an exchange of blocks


def pack(numbers: np.ndarray, deltas: bool = False) -> bytes:
    """A block of unsigned 64-bit numbers, by byte planes; deltas: of sorted numbers."""
    a = np.ascontiguousarray(numbers, np.uint64)
    if deltas:
        a = np.diff(a, prepend=np.uint64(0))
    planes = a.view(np.uint8).reshape(-1, 8).T
    used = 8
    while used and not planes[used - 1].any():
        used -= 1
    return bytes([used]) + len(a).to_bytes(4, "little") + zlib.compress(np.ascontiguousarray(planes[:used]).tobytes(), 1)


def unpack(block: bytes, deltas: bool = False) -> np.ndarray:
    used, n = block[0], int.from_bytes(block[1:5], "little")
    planes = np.zeros((8, n), np.uint8)
    planes[:used] = np.frombuffer(zlib.decompress(block[5:]), np.uint8).reshape(used, n)
    a = np.ascontiguousarray(planes.T).view(np.uint64).ravel()
    return np.cumsum(a, dtype=np.uint64) if deltas else a


def mixed(a: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers (the splitmix64 finalizer) that spreads them evenly."""
    a = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))


#: Odd multipliers of the words of an n-gram by position.
FACTORS = mixed(np.arange(1, 17, dtype=np.uint64)) | np.uint64(1)


class WordHasher:
    """64-bit hashes of words, with a cache of bounded size."""

    def __init__(self) -> None:
        self.cache: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        cache = self.cache
        if len(cache) > WORD_CACHE:
            cache.clear()
        digest = xxhash.xxh3_64_intdigest
        for w in set(words):
            if w not in cache:
                cache[w] = digest(w)
        return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words, in order; none if there are fewer words."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(m, n, np.uint64)
    for k in range(n):
        total += words[k : k + m] * FACTORS[k]
    return mixed(total)


def by_bucket(sorted_keys: np.ndarray, bits: int, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, begin, end) for sorted keys of so many bits, dealt to buckets in equal ranges; empty ones are left out."""
    if not len(sorted_keys):
        return
    own = sorted_keys // np.uint64(-(-(1 << bits) // buckets))
    begin = np.flatnonzero(np.diff(own, prepend=~own[:1]))
    yield from zip(own[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(own)], strict=True)


def dealt(blocks: DataFrame, partitions: int) -> DataFrame:
    """Blocks with a column ``bucket`` (less than ``partitions``), one partition for each: even, unlike hashed numbers."""
    return blocks.repartitionById(partitions, F.col("bucket").cast("int"))


def by_range(blocks: DataFrame, bits: int, partitions: int, ranges: int, fn: Callable, schema: str) -> DataFrame:
    """Apply ``fn`` to groups of blocks (bucket, keys, more columns) whose sorted keys lie in one of ``ranges`` equal ranges.

    Blocks go to their partition first. Where there are more ranges than
    partitions, a partition merges what it has read in pieces of bounded size,
    splits the pieces at its ranges, and Spark's sort (which may spill) brings
    the ranges together; so neither blocks nor groups change with the input.
    """
    came = dealt(blocks, partitions)
    names = blocks.columns[1:]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for part in flushed(rows, lambda r: int.from_bytes(r[1][1:5], "little"), 1 << 22):
            keys = np.concatenate([unpack(r[1], True) for r in part])
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            rest = [np.concatenate([unpack(r[k]) for r in part])[order] for k in range(2, len(names) + 1)]
            out = [(b, pack(keys[lo:hi], True), *(pack(x[lo:hi]) for x in rest)) for b, lo, hi in by_bucket(keys, bits, ranges)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["bucket", *names])

    if ranges > partitions:
        came = came.mapInArrow(split, blocks.schema)
    return came.sortWithinPartitions("bucket").mapInArrow(fn, schema)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1024) -> Iterator[None]:
    """Arrow batches of so many rows in the jobs that run inside: a batch of long texts is held by the JVM and by Python at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def in_slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of so many rows, of which only one at a time becomes Python strings."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def groups(batches: Iterable[pa.RecordBatch], key: int = 0) -> Iterator[tuple[object, list[tuple]]]:
    """Runs of rows with the same value in a column, from batches sorted by it; row tuples without conversion of blobs."""
    current, rows = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns, strict=True):
            if rows and row[key] != current:
                yield current, rows
                rows = []
            current = row[key]
            rows.append(row)
    if rows:
        yield current, rows


def flushed(rows: Iterable[tuple], size_of: Callable[[tuple], int], most: int) -> Iterator[list[tuple]]:
    """Rows in lists of about so much size."""
    part, size = [], 0
    for row in rows:
        part.append(row)
        size += size_of(row)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part
