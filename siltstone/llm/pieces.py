"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The vocabulary is read from a model file that is never copied or trained here;
a file of merges has ranks in place of scores, which ``log_scores`` turns into
log scores. The best segmentation is the one with the largest sum of
scores. Characters that no piece covers become byte pieces; the marker U+2581
stands for a space, and one is put before every text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # kinds of pieces in a model file
MERGES = 2  # the kind of a model whose pieces are merged pair by pair
UNKNOWN_PENALTY = 10.0


def default_model() -> str:
    """The 32,000-piece file of the public tokenizers package, by its own path function."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def log_scores(pieces: list[tuple[str, float, int]]) -> list[tuple[str, float, int]]:
    """Pieces of a merge vocabulary, whose scores are 0, -1, -2, ... in the order of the merges, with log scores.

    Merges come in falling order of frequency, so by Zipf's law the piece of rank
    r has a probability in proportion to 1 / (r + 1). Nothing is trained.
    """
    total = math.log(sum(1 / (1 - s) for _, s, kind in pieces if kind == NORMAL) or 1)
    return [(p, -math.log(1 - s) - total if kind == NORMAL else s, kind) for p, s, kind in pieces]


def read_pieces(model: str) -> list[tuple[str, float, int]]:
    """(piece, log score, kind) by id from a SentencePiece model file: its own scores for a unigram model, else those of the merges' ranks."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(model, "rb") as f:
        proto.ParseFromString(f.read())
    found = [(p.piece, p.score, p.type) for p in proto.pieces]
    return log_scores(found) if proto.trainer_spec.model_type == MERGES else found


class DoubleArray:
    """A trie over bytes: from node s byte b leads to t = base[s] + b + 1 if check[t] = s."""

    def __init__(self, words: dict[bytes, int]):
        base, check, value = [1], [-1], [-1]
        rows = sorted(words.items())
        free = 1

        def reach(size: int) -> None:
            more = size + 1 - len(base)
            if more > 0:
                base.extend([0] * more)
                check.extend([-1] * more)
                value.extend([-1] * more)

        todo = [(0, 0, len(rows), 0)]  # node, first row, end row, depth
        while todo:
            node, lo, hi, depth = todo.pop()
            if len(rows[lo][0]) == depth if lo < hi else False:
                value[node] = rows[lo][1]
                lo += 1
            children, at = [], lo
            while at < hi:
                byte, begin = rows[at][0][depth], at
                while at < hi and rows[at][0][depth] == byte:
                    at += 1
                children.append((byte, begin, at))
            if not children:
                continue
            first, tries = children[0][0] + 1, 0
            slot = max(free, first + 1)  # where the first child would go
            while True:
                reach(slot + 257)
                if check[slot] < 0 and all(check[slot - first + b + 1] < 0 for b, _, _ in children):
                    break
                slot, tries = slot + 1, tries + 1
            if tries > 64:  # crowded: later searches begin here
                free = slot
            start = slot - first
            base[node] = start
            for b, begin, end in children:
                check[start + b + 1] = node
                todo.append((start + b + 1, begin, end, depth + 1))
        self.base, self.check, self.value = base, check, value


class Codec:
    """Encoder and decoder of one vocabulary. Ties go to the piece found first (shorter pieces first)."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        self.pieces = pieces
        usable = {p: k for k, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER)}
        self.trie = DoubleArray({p.encode(): k for p, k in usable.items()})
        normal = [s for _, s, kind in pieces if kind == NORMAL]
        self.scores = [float(np.float32(s)) for _, s, _ in pieces]
        self.unknown_score = float(np.float32(min(normal, default=0.0) - UNKNOWN_PENALTY))
        self.unknown = next((k for k, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN), 0)
        self.bytes_of = {k: int(p[3:5], 16) for k, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.byte_ids = {b: k for k, b in self.bytes_of.items()}
        # No piece continues from another character into a marker, and none joins a
        # lone character to others: the best path is made of the best paths between such places.
        inner = any(MARK in p.lstrip(MARK) for p in usable)
        joined = set("".join(p for p in usable if len(p) > 1))
        lone = "" if inner else "".join(re.escape(c) for c in "\n\t\r!\"#$%&()*+,-./0123456789:;<=>?@[\\]^_`{|}~" if c not in joined)
        self.units = None if inner else re.compile(rf"{MARK}*[^{MARK}{lone}]+|{MARK}+" + (rf"|[{lone}]" if lone else ""))
        self.cache: dict[str, tuple[int, ...]] = {}
        self.bytes_by_id = [
            bytes([self.bytes_of[k]]) if k in self.bytes_of else b"" if kind == CONTROL else p.replace(MARK, " ").encode()
            for k, (p, _, kind) in enumerate(pieces)
        ]

    def best_path(self, text: str) -> tuple[int, ...]:
        """Ids of the best segmentation of a text that already has markers."""
        data = text.encode()
        n = len(data)
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        top = len(check)
        best: list[float] = [-1e300] * (n + 1)
        via: list[tuple[int, int]] = [(-1, -1)] * (n + 1)
        best[0] = 0.0
        at = 0
        while at < n:
            byte = data[at]
            step = 1 if byte < 0x80 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
            here, node, single = best[at], 0, False
            for end in range(at, n):
                nxt = base[node] + data[end] + 1
                if nxt >= top or check[nxt] != node:
                    break
                node = nxt
                piece = value[node]
                if piece >= 0:
                    total = here + scores[piece]
                    if via[end + 1][0] < 0 or total > best[end + 1]:
                        best[end + 1], via[end + 1] = total, (at, piece)
                    single = single or end + 1 - at == step
            if not single:
                total = here + self.unknown_score
                if via[at + step][0] < 0 or total > best[at + step]:
                    best[at + step], via[at + step] = total, (at, self.unknown)
            at += step
        out: list[int] = []
        while n > 0:
            at, piece = via[n]
            if piece != self.unknown:
                out.append(piece)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in reversed(data[at:n]))
            else:
                out.append(piece)
            n = at
        return tuple(reversed(out))

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        if self.units is None:
            return list(self.best_path(marked))
        cache, out = self.cache, []
        if len(cache) > 400_000:  # bounded memory; it only saves time
            cache.clear()
        for unit in self.units.findall(marked):
            ids = cache.get(unit)
            if ids is None:
                ids = self.best_path(unit)
                if len(unit) <= 64:
                    cache[unit] = ids
            out.extend(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.bytes_by_id.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def encode_documents(docs: DataFrame, key: str, text: str = "text", model: str | None = None) -> DataFrame:
    """Token ids of every whole text, one row per row of ``docs``.

    Columns: ``key``, ids, n_ids, n_byte_ids (ids that stand for single bytes)
    and round_trip (decoding gives the text back). Null and empty texts have no
    ids. ``model`` is the path of a SentencePiece model file, read by the driver;
    its trie is broadcast, which is as large as the vocabulary whatever the input.
    A marker character in a text itself is decoded as a space (round_trip false).
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Codec(read_pieces(model or default_model())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value  # one copy per Python worker, its cache included
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                offsets, ids, single, same = [0], [], [], []
                for value in part.column(1).to_pylist():
                    own = codec.encode(value)
                    ids.append(np.array(own, np.int32))
                    offsets.append(offsets[-1] + len(own))
                    single.append(sum(map(codec.bytes_of.__contains__, own)))
                    same.append(codec.decode(own) == (value or ""))
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32())),
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.array(single, pa.int64()),
                        pa.array(same, pa.bool_()),
                    ],
                    names=[key, "ids", "n_ids", "n_byte_ids", "round_trip"],
                )

    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("n_ids", T.LongType()),
            T.StructField("n_byte_ids", T.LongType()),
            T.StructField("round_trip", T.BooleanType()),
        ]
    )
    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def op8(spark, sf_dir: str) -> DataFrame:
    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id")
