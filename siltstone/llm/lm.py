"""Stupid-backoff scores from n-gram counts of the corpus itself.

Count tables are partitioned by the hash of the n-gram. The n-grams of a chunk
of documents go to their partitions as one block for each (an exploded n-gram
join in compact form); a partition adds up all blocks, which makes its part of
the count table, joins it back to each block, and the counts return to their
chunk, where the scores are summed per document. Three exchanges, whatever the
size of the tables; no table is broadcast.

Score of a word w after u v, with counts c over all documents and N words:
c(uvw)/c(uv) if uvw is in the table, else BACKOFF * c(vw)/c(v) if vw is, else
BACKOFF^k * c(w)/N. The tables hold all words, and longer n-grams that occur at
least LEAST times; n-grams don't cross the ends of documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import input_bytes, stage_table
from . import packed

ORDER, BACKOFF, LEAST = 3, 0.4, 2
CHUNK_WORDS = 1_500_000


def _chunks(batches: Iterator[pa.RecordBatch], hasher: packed.WordHasher) -> Iterator[tuple[int, list[tuple[int | None, np.ndarray]]]]:
    """Numbered runs of (doc, word hashes) of about CHUNK_WORDS; the numbers are unique in the DataFrame."""
    from pyspark import TaskContext

    rows = ((doc, hasher((text or "").encode().split())) for b in batches for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
    base = TaskContext.get().partitionId() << 32
    for k, part in enumerate(packed.flushed(rows, lambda r: len(r[1]) + 1, CHUNK_WORDS)):
        yield base + k, part


def _keys(docs: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Keys of the 1-, 2- and 3-grams of each order, documents one after another."""
    down = np.uint64(64 - bits)
    return [np.concatenate([packed.ngrams(d, k) for d in docs] or [np.zeros(0, np.uint64)]) >> down for k in range(1, ORDER + 1)]


def _reproducible(docs: DataFrame) -> DataFrame:
    """Chunks are formed twice and must come out alike: rows that went through an exchange are written first."""
    return stage_table(docs) if "Exchange" in docs._jdf.queryExecution().executedPlan().toString() else docs


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, n_words, log_score, mean_log_score, n_backoffs), one row per row of ``docs``.

    log_score: the sum over the words of the natural logarithm of their scores,
    rounded to 6 places; n_backoffs: steps down to a shorter n-gram. Texts
    without words (null texts too) score 0, with a null mean. Counts cover all
    documents, the scored one included; rows that repeat count again.
    """
    size = max(1, input_bytes(docs))
    bits = min(64, 2 * math.ceil(math.log2(size)) + 2)
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // (2 << 20))
    rows = _reproducible(docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, part in _chunks(batches, packed.WordHasher()):
            keys, counts = np.unique(np.concatenate(_keys([d for _, d in part], bits)), return_counts=True)
            out = [(b, chunk, packed.pack(keys[lo:hi], True), packed.pack(counts[lo:hi])) for b, lo, hi in packed.by_bucket(keys, bits, buckets)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["bucket", "chunk", "ask", "cnts"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, blocks in packed.groups(batches):
            keys = [packed.unpack(r[2], True) for r in blocks]
            table, where = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(where, weights=np.concatenate([packed.unpack(r[3]) for r in blocks]).astype(float), minlength=len(table)).astype(np.uint64)
            at = 0
            for r, own in zip(blocks, keys, strict=True):
                block = packed.pack(total[where[at : at + len(own)]])
                at += len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[1]], pa.int64()), pa.array([bucket], pa.int64()), pa.array([block], pa.binary()), *(pa.array([None], pa.binary()) for _ in range(3))],
                    names=["chunk", "bucket", "b0", "b1", "b2", "b3"],
                )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, part in _chunks(batches, packed.WordHasher()):
            words = np.concatenate([d for _, d in part])
            vocabulary, ids, counts = np.unique(words, return_inverse=True, return_counts=True)
            frequent = np.argsort(-counts, kind="stable")  # small numbers for frequent words
            rank = np.empty(len(frequent), np.uint64)
            rank[frequent] = np.arange(len(frequent), dtype=np.uint64)
            names = np.array([0 if doc is None else doc for doc, _ in part], np.int64).view(np.uint64)
            sizes = np.array([2 * len(d) + (doc is None) for doc, d in part], np.uint64)
            blocks = [packed.pack(x) for x in (names, sizes, rank[ids] if len(ids) else np.zeros(0, np.uint64), vocabulary[frequent])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([-1], pa.int64()), *(pa.array([b], pa.binary()) for b in blocks)],
                names=["chunk", "bucket", "b0", "b1", "b2", "b3"],
            )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in packed.groups(batches):
            names, sizes, ids, vocabulary = (packed.unpack(x) for x in own[0][2:6])
            words = vocabulary[ids]
            ends = np.cumsum(sizes >> np.uint64(1)).astype(np.int64)
            docs = np.split(words, ends[:-1])
            keys = _keys(docs, bits)
            unique, where = np.unique(np.concatenate(keys), return_inverse=True)
            counts = np.concatenate([packed.unpack(r[2]) for r in own[1:]]) if len(own) > 1 else np.zeros(0, np.uint64)
            if len(counts) != len(unique):
                raise RuntimeError("counts of a chunk are missing: its documents came out in another order")
            c = np.split(counts[where].astype(float), np.cumsum([len(k) for k in keys])[:-1])
            lengths = np.diff(ends, prepend=0)
            place = np.arange(len(words)) - np.repeat(ends - lengths, lengths)
            doc_of = np.repeat(np.arange(len(lengths)), lengths)
            # positions of the last word of each 2-gram and 3-gram, in the order in which the keys were made
            last = [np.flatnonzero(place >= k) for k in range(ORDER)]
            value, steps = np.log(c[0]), np.where(place < ORDER - 1, place, ORDER - 1).astype(np.int64)
            whole = np.ones(len(words), bool)  # scored against all N words
            for k in range(1, ORDER):
                known = c[k] >= LEAST
                at = last[k][known]
                before = np.zeros(len(words))
                before[last[k - 1]] = c[k - 1]  # count of the k-gram that ends at a word
                value[at] = np.log(c[k][known]) - np.log(before[at - 1])
                steps[at] = np.where(place[at] < ORDER - 1, place[at], ORDER - 1) - k
                whole[at] = False
            value += steps * math.log(BACKOFF)
            n = len(lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None if s & 1 else int(v) for v, s in zip(names.view(np.int64).tolist(), sizes.tolist(), strict=True)], pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(np.bincount(doc_of, weights=value, minlength=n), pa.float64()),
                    pa.array(np.bincount(doc_of, weights=whole, minlength=n).astype(np.int64), pa.int64()),
                    pa.array(np.bincount(doc_of, weights=steps, minlength=n).astype(np.int64), pa.int64()),
                ],
                names=["doc", "n_words", "part", "n_whole", "n_backoffs"],
            )

    asked = rows.mapInArrow(ask, "bucket long, chunk long, ask binary, cnts binary")
    shape = "chunk long, bucket long, b0 binary, b1 binary, b2 binary, b3 binary"
    partitions = min(buckets, packed.MOST_PARTITIONS)  # a task goes through its buckets and chunks one by one
    answered = asked.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(answer, shape)
    encoded = rows.mapInArrow(encode, shape)
    back = encoded.unionByName(answered).repartition(partitions, "chunk").sortWithinPartitions("chunk", "bucket")
    parts = stage_table(back.mapInArrow(score, "doc long, n_words long, part double, n_whole long, n_backoffs long"))
    total = parts.agg(F.sum("n_words")).first()[0] or 1
    log_score = F.col("part") - F.col("n_whole") * F.lit(math.log(total))
    return parts.select(
        F.col("doc").alias(key), "n_words", F.round(log_score, 6).alias("log_score"),
        F.round(F.when(F.col("n_words") > 0, log_score / F.col("n_words")), 6).alias("mean_log_score"), "n_backoffs",
    )


def op6(spark, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
