"""Substring deduplication: content-defined cuts by a gear rolling hash, matches extended to the true ends of the passages.

A gear hash h = 2 h + GEAR(code point) rolls over each text; a text is cut where
it is smallest in a stretch of text. Cuts depend on the content alone, so an
insertion moves no cut outside of its own surroundings, and none is forced by a
count. What is cut is deduplicated by digest: the gear hash of the window at a
cut, mixed, names it. A passage is a run of at least ``least_run`` code points that two
documents hold; stretches are so short that every such run has a cut whose
window lies in it, which whole chunks from cut to cut would not ensure. Cuts
that several documents hold mark the places where runs are worth comparing;
there, runs are compared with those of all documents, and overlapping runs make
the passages. The smallest key that holds a run keeps it.

Long runs of twice the length, chosen alike by the smallest hash, are compared
with the cuts. A smaller key that holds a long run holds the runs in it too,
so these are known without asking; the smallest key of each run always asks.

Cuts and runs go to buckets by their hash as one block for each part of the
texts, and the answers return to the part. A part names a run once, with its
smallest and largest key, so a passage of many documents is no hot group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import input_bytes, stage_table
from . import packed
from .lm import _reproducible as reproducible

LEAST_RUN = 96
SPAN = "struct<start:bigint,end:bigint>"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
CHUNK, PIECE = 1 << 20, 1 << 18  # code points that are asked for together, and hashed together
LONGEST_WORD, FIRST_WIDE = 32, 0x2E80  # letters of a word that a span may end in; from here on scripts don't set words apart
_NULL = (1 << 63) - 1
_LETTERS = np.array([chr(c).isalnum() for c in range(FIRST_WIDE)] + [False])


def window(least_run: int) -> int:
    """Code points that the gear hash at a cut covers: half a run, as far as 64 bits remember."""
    return min(max(1, least_run // 2), 64)


def gear_hashes(points: np.ndarray, n: int) -> np.ndarray:
    """The gear hash h = 2 h + GEAR(code point) of the ``n`` code points from every place on, by doubling; n is at most 64.

    GEAR is a mixing of the code point's number, so it knows every script.
    """
    h, m = packed.mixed(points.astype(np.uint64) + np.uint64(1)), 1
    whole, done = h, 0
    while True:
        if n & m:
            whole = (whole[: len(h) - done] << np.uint64(m)) + h[done:] if done else h
            done += m
        if done == n:
            return whole
        h, m = (h[: len(h) - m] << np.uint64(m)) + h[m:], 2 * m


def run_hashes(points: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """64-bit hashes of the runs of so many code points at every place, by doubling."""
    found: dict[int, np.ndarray] = {}
    h, m = packed.mixed(points.astype(np.uint64) + np.uint64(1)), 1
    while True:
        for n in sizes:
            if m <= n < 2 * m:
                found[n] = _joined(h, n - m) if n > m else h
        if len(found) == len(set(sizes)):
            return [found[n] for n in sizes]
        h, m = _joined(h, m), 2 * m


def _joined(h: np.ndarray, by: int) -> np.ndarray:
    """Hashes of the runs at each place and ``by`` places on, as one run."""
    n = max(0, len(h) - by)
    x = h[:n] * packed.FACTORS[0]
    x += h[by : by + n] * packed.FACTORS[1]
    x ^= x >> np.uint64(29)
    x *= packed.FACTORS[2]
    x ^= x >> np.uint64(32)
    return x


def _sliding(x: np.ndarray, n: int, of: np.ufunc) -> np.ndarray:
    """Least or greatest number of every n neighbours."""
    m = 1
    while 2 * m <= n:
        x, m = of(x[:-m], x[m:]), 2 * m
    return of(x[: m - n], x[n - m :]) if m < n else x


def _room(sizes: np.ndarray) -> np.ndarray:
    """Code points from each place to the end of its piece."""
    ends = np.cumsum(sizes, dtype=np.int32)
    return np.repeat(ends, sizes) - np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)


def cuts(points: np.ndarray, room: np.ndarray, least_run: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, digests) of the windows at the cuts: in every run of ``least_run`` code points, all windows with the smallest gear hash.

    Which ones those are depends on the run alone, so that texts that share a
    run share a cut in it, whatever stands around it.
    """
    wide = window(least_run)
    if len(points) < least_run:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = gear_hashes(points, wide)
    n = least_run - wide + 1
    least = np.where(room[: len(points) - least_run + 1] >= least_run, _sliding(h, n, np.minimum), np.uint64(0))
    outside = np.zeros(n - 1, np.uint64)
    at = np.flatnonzero(_sliding(np.concatenate((outside, least, outside)), n, np.maximum) == h)
    return at, packed.mixed(h[at])  # the smallest hashes as they are would go to the first buckets


def long_runs(points: np.ndarray, room: np.ndarray, least_run: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of runs of 2 * ``least_run`` code points: in each of them starts one that the run itself decides."""
    n = least_run + 1
    if len(points) < 2 * least_run:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h, whole = run_hashes(points, least_run, 2 * least_run)
    fits = room[: len(whole)] >= 2 * least_run
    least = np.where(fits, _sliding(h, n, np.minimum), np.uint64(0))
    outside = np.zeros(n - 1, np.uint64)
    at = np.flatnonzero((_sliding(np.concatenate((outside, least, outside)), n, np.maximum) == h)[: len(whole)] & fits)
    return at, whole[at]


def _pieces(batches: Iterator[pa.RecordBatch], least_run: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(id, offset, code points) of the texts; long ones in pieces that overlap, so that each run is whole in one of them, with what stands beside it."""
    for batch in (b.slice(k, 64) for b in batches for k in range(0, len(b), 64)):  # a few texts at once as strings
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            points = np.frombuffer((text or "").encode("utf-32-le"), np.uint32)
            for at in range(0, len(points) - least_run + 1, PIECE):
                yield doc, at, points[at : at + PIECE + least_run + 1]


def _signed(block: bytes) -> np.ndarray:
    return packed.unpack(block).view(np.int64)


def _asks(chunk: int, keys: np.ndarray, ids: np.ndarray, above: np.ndarray, buckets: int) -> list[tuple[int, int, list[bytes]]]:
    """Rows that ask each bucket for keys, with the smallest and the largest id that hold them here.

    above: of each place, whether a larger id is known to hold its key, which then counts as the largest of all.
    """
    order = np.argsort(keys, kind="stable")
    begin = np.flatnonzero(np.diff(keys[order], prepend=~keys[order][:1])) if len(keys) else np.zeros(0, np.int64)
    unique = keys[order][begin]
    low, high = (of.reduceat(x[order], begin) if len(keys) else x for of, x in ((np.minimum, ids), (np.maximum, np.where(above, _NULL, ids))))
    low = low.view(np.uint64)
    spread = np.where(high == _NULL, np.uint64(0), high.view(np.uint64) - low + np.uint64(1))  # 0: to the largest of all
    return [
        (b, chunk, [packed.pack(unique[lo:hi], True), packed.pack(low[lo:hi]), packed.pack(spread[lo:hi])])
        for b, lo, hi in packed.by_bucket(unique, 64, buckets)
    ]


def _rows(rows: list[tuple[int, int, list[bytes]]]) -> pa.RecordBatch:
    buckets, chunks_, blocks = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(chunks_, pa.int64()), pa.array(blocks, pa.list_(pa.binary()))], names=["bucket", "chunk", "blocks"])


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every key that a chunk asks for: 1 if a smaller id than the chunk's holds it elsewhere, plus 2 if a larger one does."""
    for bucket, rows in packed.groups(batches):
        out = [(-1, ~r[1], r[2]) for r in rows if r[1] < 0]
        asked = [r for r in rows if r[1] >= 0]
        if not asked:
            yield _rows(out)
            continue
        keys = [packed.unpack(r[2][0], True) for r in asked]
        low = np.concatenate([_signed(r[2][1]) for r in asked])
        spread = np.concatenate([_signed(r[2][2]) for r in asked])
        high = np.where(spread == 0, _NULL, low + spread - 1)
        together = np.concatenate(keys)
        order = np.argsort(together, kind="stable")
        begin = np.flatnonzero(np.diff(together[order], prepend=~together[order][:1]))
        sizes = np.diff(np.append(begin, len(order)))
        flags = np.empty(len(order), np.uint64)
        flags[order] = (np.repeat(np.minimum.reduceat(low[order], begin), sizes) < low[order]) + 2 * (np.repeat(np.maximum.reduceat(high[order], begin), sizes) > high[order])
        at = 0
        for r, own in zip(asked, keys, strict=True):
            out.append((bucket, r[1], [packed.pack(flags[at : at + len(own)])]))
            at += len(own)
        yield _rows(out)


def _told(keys: np.ndarray, ids: np.ndarray, above: np.ndarray, answers: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Whether a smaller, and whether a larger id holds each key of a chunk."""
    unique, where = np.unique(keys, return_inverse=True)
    flags = np.concatenate([np.zeros(0, np.uint64), *(packed.unpack(r[2][0]) for r in answers)])
    if len(flags) != len(unique):
        raise RuntimeError("answers of a chunk are missing")
    low, high = np.full(len(unique), np.iinfo(np.int64).max), np.full(len(unique), np.iinfo(np.int64).min)
    np.minimum.at(low, where, ids)
    np.maximum.at(high, where, np.where(above, _NULL, ids))
    return (flags[where] & np.uint64(1) > 0) | (low[where] < ids), (flags[where] & np.uint64(2) > 0) | (high[where] > ids)


def _covered(begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in any of the spans."""
    marks = np.zeros(n + 1, np.int32)
    np.add.at(marks, begin, 1)
    np.subtract.at(marks, end, 1)
    return np.cumsum(marks, out=marks)[:n] > 0


def _split(points: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[slice, int, np.ndarray]]:
    """Whole pieces in blocks that fit the cache: (which pieces, first code point, code points)."""
    ends = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        begin = int(ends[first] - sizes[first])
        last = max(first + 1, int(np.searchsorted(ends, begin + PIECE, side="right")))
        yield slice(first, last), begin, points[begin : int(ends[last - 1])]
        first = last


def _chunks(batches: Iterator[pa.RecordBatch], least_run: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(number, ids, offsets, sizes, code points) of the pieces of a chunk; the numbers are unique in the DataFrame."""
    from pyspark import TaskContext

    base = TaskContext.get().partitionId() << 32
    for k, part in enumerate(packed.flushed(_pieces(batches, least_run), lambda r: len(r[2]), CHUNK)):
        yield base + k, *(np.array(x, np.int64) for x in ([r[0] for r in part], [r[1] for r in part], [len(r[2]) for r in part])), np.concatenate([r[2] for r in part])


def _chunk_cuts(points: np.ndarray, sizes: np.ndarray, least_run: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(places, hashes, number of cuts) of the cuts of a part, and of its long runs after them."""
    found: tuple[list, list] = ([], [])
    for part, begin, own in _split(points, sizes):
        room = _room(sizes[part])
        for kind, of in zip(found, (cuts, long_runs), strict=True):
            at, h = of(own, room, least_run)
            kind.append((at + begin, h))
    return *(np.concatenate([x[k] for kind in found for x in kind]) for k in (0, 1)), sum(len(x[0]) for x in found[0])


def _ask_cuts(batches: Iterator[pa.RecordBatch], least_run: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for chunk, ids, _, sizes, points in _chunks(batches, least_run):
        at, h, _ = _chunk_cuts(points, sizes, least_run)
        rows = _asks(chunk, h, np.repeat(ids, sizes)[at], np.zeros(len(at), bool), buckets)
        if rows:
            yield _rows(rows)


def _texts(batches: Iterator[pa.RecordBatch], least_run: int) -> Iterator[pa.RecordBatch]:
    """The pieces of each chunk, in the place of a state."""
    for chunk, ids, offsets, sizes, points in _chunks(batches, least_run):
        yield _rows([(-1, chunk, _packed(ids, offsets, sizes, points))])


def _packed(*state: np.ndarray) -> list[bytes]:
    """Signed numbers, and code points at last."""
    text = state[-1].astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    return [*(packed.pack(x.astype(np.int64).view(np.uint64)) for x in state[:-1]), zlib.compress(text, 1)]


def _unpacked(blocks: list[bytes]) -> list[np.ndarray]:
    text = zlib.decompress(blocks[-1]).decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass")
    return [*map(_signed, blocks[:-1]), np.frombuffer(text, np.uint32)]


def _ask_runs(batches: Iterator[pa.RecordBatch], least_run: int, buckets: int, most: int) -> Iterator[pa.RecordBatch]:
    """Asks for every run that holds a shared cut's window, but for those in a long run of a smaller id.

    The state keeps their text, with a code point on either side if there is
    one, and what is known of them: 1 if a smaller id holds the run, plus 2 if
    a larger one does, and the places where that changes.
    """
    for chunk, rows in packed.groups(batches, 1):
        ids, offsets, sizes, points = _unpacked(rows[0][2])
        at, h, short = _chunk_cuts(points, sizes, least_run)
        piece = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        smaller, larger = _told(h, ids[piece[at]], np.zeros(len(at), bool), rows[1:])
        room, n = _room(sizes), len(points)
        known = np.zeros(n, np.int8)
        for value, on in ((1, smaller), (2, larger)):
            begin = at[short:][on[short:]] + 1  # a run inside has a code point of the long run on either side
            known += np.int8(value) * _covered(begin, begin + least_run - 1, n)
        at = at[:short][(smaller | larger)[:short]]
        wanted = _covered(np.maximum(at - (least_run - window(least_run)), 0), at + 1, n) & (room >= least_run)
        edge = np.diff(np.concatenate(([False], wanted, [False])).astype(np.int8)) != 0
        bounds = np.flatnonzero(edge).reshape(-1, 2)  # no run starts at the end of a piece, so they are apart
        owner = piece[bounds[:, 0]]
        begin, count = bounds[:, 0], bounds[:, 1] - bounds[:, 0]
        starts = np.cumsum(sizes) - sizes
        before = (begin > starts[owner]).astype(np.int64)
        after = (room[begin] > count + least_run - 1).astype(np.int64)
        lengths = before + count + least_run - 1 + after
        text = np.concatenate([np.zeros(0, np.uint32), *(points[b - x : b - x + m] for b, x, m in zip(begin.tolist(), before.tolist(), lengths.tolist(), strict=True))])
        known = known[wanted]
        change = np.flatnonzero(np.diff(known, prepend=np.int8(0)))
        state = [ids[owner], offsets[owner] + begin - starts[owner], count, before, after, owner, change, known[change], text]
        keys, holders = _run_keys(state, least_run, most)
        own = known & 1 == 0
        yield _rows([*_asks(chunk, keys[own], holders[own], known[own] > 1, buckets), (chunk % buckets, ~chunk, _packed(*state))])


def _run_keys(state: list[np.ndarray], least_run: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of the segments of a state, and the ids that hold them.

    A run that starts or ends inside a word (of which it has fewer than ``most``
    letters) is another one than the same run with whole words.
    """
    ids, _, count, before, after, *_, text = state
    lengths = before + count + least_run - 1 + after
    found = []
    for part, _, own in _split(text, lengths):
        begin = np.cumsum(lengths[part]) - lengths[part] + before[part]
        inside = np.repeat(begin - (np.cumsum(count[part]) - count[part]), count[part]) + np.arange(int(count[part].sum()))
        h = run_hashes(own, least_run)[0]
        letter = _LETTERS[np.minimum(own, FIRST_WIDE)]
        other = np.flatnonzero(~letter)
        after_it = np.append(other, len(own) + most)  # the next place without a letter
        before_it = np.insert(other, 0, -1 - most)
        place = np.arange(len(own))
        within = np.zeros(len(own) + 1, bool)
        within[1:-1] = letter[1:] & letter[:-1]
        within[np.cumsum(lengths[part])] = within[0] = False
        within[(np.cumsum(lengths[part]) - lengths[part])] = False
        head = within[:-1] & (after_it[np.searchsorted(other, place)] - place < most)
        tail = within[1:] & (place - before_it[np.searchsorted(other, place, side="right")] < most)
        found.append(h[inside] + head[inside] * packed.FACTORS[3] + tail[inside + least_run - 1] * packed.FACTORS[4])
    return np.concatenate([np.zeros(0, np.uint64), *found]), np.repeat(ids, count)


def _spans(batches: Iterator[pa.RecordBatch], least_run: int, most: int) -> Iterator[pa.RecordBatch]:
    """owner, repeated, removed of the pieces that hold any."""
    for _, rows in packed.groups(batches, 1):
        state = _unpacked(rows[0][2])
        ids, starts, count, before, after, piece, change, value, text = state
        keys, holders = _run_keys(state, least_run, most)
        known = np.repeat(np.append(0, value), np.diff(np.concatenate(([0], change, [len(keys)]))))
        own, smaller, larger = known & 1 == 0, known & 1 > 0, known > 1
        smaller[own], larger[own] = _told(keys[own], holders[own], known[own] > 1, rows[1:])
        place = np.arange(len(keys)) - np.repeat(np.cumsum(count) - count - starts, count)
        segment = np.repeat(np.arange(len(count)), count)
        lengths = before + count + least_run - 1 + after
        # where the code point of a segment with number 0 in its document would stand in the text
        zero = np.cumsum(lengths) - lengths + before - starts
        of_piece: dict[int, tuple[list, list, int]] = {}
        for kind, on in enumerate((smaller | larger, smaller)):
            at, seg = place[on], segment[on]
            if not len(at):
                continue
            new = np.flatnonzero(np.diff(piece[seg], prepend=-1) | (np.diff(at, prepend=at[0]) > least_run))
            last = np.append(new[1:], len(at)) - 1
            for a, b, s, t in zip(at[new].tolist(), (at[last] + least_run).tolist(), seg[new].tolist(), seg[last].tolist(), strict=True):
                lo = a > starts[s] or before[s]
                hi = b < starts[t] + count[t] + least_run - 1 or after[t]
                span = _whole_words(text, a, b, int(zero[s]), int(zero[t]), bool(lo), bool(hi), most)
                of_piece.setdefault(int(piece[s]), ([], [], int(ids[s])))[kind].append({"start": span[0], "end": span[1]})
        if of_piece:
            found = list(of_piece.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[2] for x in found], pa.int64()), *(pa.array([x[k] for x in found], SPANS) for k in (0, 1))], names=["owner", "repeated", "removed"]
            )


def _letter(c: int) -> bool:
    return c < FIRST_WIDE and chr(c).isalnum()


def _whole_words(text: np.ndarray, a: int, b: int, left: int, right: int, lo: bool, hi: bool, most: int) -> tuple[int, int]:
    """The span [a, b) without the parts of words and the white space at its ends; lo, hi: there is text before, after it.

    Scripts that don't set words apart, and words of ``most``
    letters or more, are left as they are.
    """
    begin, end = a, b
    if lo:
        if _letter(int(text[left + a - 1])):
            k = next((k for k in range(most) if not _letter(int(text[left + a + k]))), 0)
            begin += k
        while begin < end and begin - a < most and chr(int(text[left + begin])).isspace():
            begin += 1
    if hi:
        if _letter(int(text[right + b])):
            k = next((k for k in range(most) if not _letter(int(text[right + b - 1 - k]))), 0)
            end -= k
        while begin < end and b - end < most and chr(int(text[right + end - 1])).isspace():
            end -= 1
    return (begin, end) if begin < end else (a, b)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of the pieces of each document, as spans that are apart from each other."""
    for batch in batches:
        columns = []
        for column in batch.columns[1:]:
            out = []
            for found in column.to_pylist():
                spans: list[dict] = []
                for x in sorted((x for part in found for x in part), key=lambda x: x["start"]):
                    if spans and x["start"] <= spans[-1]["end"]:
                        spans[-1]["end"] = max(spans[-1]["end"], x["end"])
                    else:
                        spans.append(x)
                out.append(spans)
            columns.append(out)
        total = [sum(s["end"] - s["start"] for s in spans) for spans in columns[0]]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(total, pa.int64()), *(pa.array(c, SPANS) for c in columns)], names=["owner", "repeated_chars", "repeated", "removed"]
        )


def _owned(docs: DataFrame, key: str, text: str, least_run: int) -> tuple[DataFrame, DataFrame | None]:
    """Texts by owner, a whole number in the order of the keys (nulls last), and the owners' keys and digests if numbers had to be made.

    Rows with equal keys and texts have one owner. Whole keys are their own
    numbers if none of them stands on different texts.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.length("text") >= least_run)
    if isinstance(docs.schema[key].dataType, T.ByteType | T.ShortType | T.IntegerType | T.LongType):
        hashed = rows.groupBy("key").agg(F.min(F.xxhash64("text")).alias("least"), F.max(F.xxhash64("text")).alias("most"))
        if hashed.where("least <> most").isEmpty():
            return rows.select(F.coalesce(F.col("key").cast("long"), F.lit(_NULL)).alias("owner"), "text"), None
    rows = rows.withColumn("digest", F.md5("text"))
    names = rows.select("key", "digest").distinct().orderBy(F.col("key").asc_nulls_last(), "digest")
    names = stage_table(names.select("key", "digest", F.monotonically_increasing_id().alias("owner")))
    own = names.select(F.col("key").alias("_key"), F.col("digest").alias("_digest"), "owner")
    found = rows.join(own, F.col("key").eqNullSafe(F.col("_key")) & (F.col("digest") == F.col("_digest")))
    return found.select("owner", "text"), names


def _passages(docs: DataFrame, key: str, text: str, least_run: int, whole_words: bool) -> tuple[DataFrame, bool]:
    """key, digest (of the text; null where the key alone tells the row), repeated_chars, repeated, removed; and whether digests tell rows apart."""
    if least_run < 2:
        raise ValueError("passages have at least two code points")
    rows, names = _owned(docs, key, text, least_run)
    rows = reproducible(rows)
    most = min(LONGEST_WORD, least_run // 2) if whole_words else 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), input_bytes(docs) // (8 << 20))
    shape = "bucket long, chunk long, blocks array<binary>"
    spans = f"array<{SPAN}>"

    def answered(asked: DataFrame, texts: DataFrame | None = None) -> DataFrame:
        partitions = min(buckets, packed.MOST_PARTITIONS)  # a task goes through its buckets and parts one by one
        back = packed.dealt(asked, partitions).sortWithinPartitions("bucket").mapInArrow(_answers, shape)
        return (back if texts is None else texts.unionByName(back)).repartition(partitions, "chunk").sortWithinPartitions("chunk", "bucket")

    asked = answered(rows.mapInArrow(lambda b: _ask_cuts(b, least_run, buckets), shape), rows.mapInArrow(lambda b: _texts(b, least_run), shape))
    asked = answered(asked.mapInArrow(lambda b: _ask_runs(b, least_run, buckets, most), shape))
    found = asked.mapInArrow(lambda b: _spans(b, least_run, most), f"owner long, repeated {spans}, removed {spans}")
    per_doc = found.groupBy("owner").agg(F.collect_set("repeated").alias("repeated"), F.collect_set("removed").alias("removed"))
    out = per_doc.mapInArrow(_merged, f"owner long, repeated_chars long, repeated {spans}, removed {spans}")
    if names is None:
        out = out.select(F.when(F.col("owner") != _NULL, F.col("owner")).cast(docs.schema[key].dataType).alias("key"), F.lit(None).cast("string").alias("digest"), "repeated_chars", "repeated", "removed")
    else:
        out = out.join(names, "owner").select("key", "digest", "repeated_chars", "repeated", "removed")
    return out, names is not None


def repeated_passages(docs: DataFrame, key: str, text: str = "text", least_run: int = LEAST_RUN, whole_words: bool = True) -> DataFrame:
    """Passages that other documents hold too, one row per document that has any.

    Columns: ``key``, repeated_chars, repeated (spans in code points, end
    exclusive, of every run of ``least_run`` code points that another document
    also holds, wherever it stands) and
    removed (the part of them that an earlier document holds; cutting it leaves
    every code point of a passage in the first document). Documents are in the
    order of their keys, nulls last, then of their texts' digests. ``whole_words``: a run must
    start and end alike in both documents, inside a word or not, and the parts
    of words and white space at the ends of a span are left out; without it
    spans reach to the last equal code point. Null and shorter texts have
    no passages. Rows with equal keys and equal texts count as one document, rows
    with equal (or null) keys and different texts as several; repeats inside one
    document don't count. Runs are
    compared by 64-bit hashes: one of n runs is taken for another with a chance
    of about n / 2^64.
    """
    found, _ = _passages(docs, key, text, least_run, whole_words)
    return found.select(F.col("key").alias(key), "repeated_chars", "repeated", "removed")


def cut_spans(text: Column, spans: Column) -> Column:
    """The text without the spans (sorted, apart from each other)."""
    done = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("pos")),
        lambda acc, s: F.struct(
            F.concat(acc["out"], text.substr((acc["pos"] + 1).cast("int"), (s["start"] - acc["pos"]).cast("int"))).alias("out"),
            s["end"].alias("pos"),
        ),
    )
    return F.concat(done["out"], text.substr((done["pos"] + 1).cast("int"), F.length(text)))


def deduplicated(docs: DataFrame, key: str, text: str = "text", least_run: int = LEAST_RUN) -> DataFrame:
    """The documents with every repeated passage cut from all but the first document that holds it.

    Each row loses only what its own text shares, also where rows have equal or
    null keys; rows with equal keys and texts are cut alike.
    """
    found, by_text = _passages(docs, key, text, least_run, True)
    removed = found.select("key", "digest", F.col("removed").alias("spans"))
    joined = docs.select(F.struct("*").alias("row"))
    same = F.col("row")[key].eqNullSafe(F.col("key"))
    if by_text:
        same = same & (F.md5(F.col("row")[text]) == F.col("digest"))
    else:
        same = same & (F.length(F.col("row")[text]) >= least_run)
    joined = joined.join(removed, same, "left")
    cut = F.when(F.size("spans") > 0, cut_spans(F.col("row")[text], F.col("spans"))).otherwise(F.col("row")[text])
    return joined.select(F.col("row").withField(text, cut).alias("row")).select("row.*")


def op10(spark, sf_dir: str) -> DataFrame:
    found = repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id")
    return found.withColumn("removed_chars", F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]))
