"""Benchmark decontamination: one Aho-Corasick automaton over the word windows of test items.

Windows of questions and answers become sequences of word numbers, and the
automaton reads the words of a document once. What it finds is mapped back to
code points of the original text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table, table

WINDOW = 10
MOST_WINDOWS = 200_000  # pairs of window and item in one automaton; more are searched for by several, one after another
PIECE = 1 << 20  # bytes of a text whose words are in memory together
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_BYTE = [0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)]
#: UTF-8 bytes with A-Z in lower case and a space for all that is no part of a word.
FOLD = bytes(c if _WORD_BYTE[c] else 0x20 for c in (b | 0x20 if 0x41 <= b <= 0x5A else b for b in range(256)))
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("first", pa.int64()), ("last", pa.int64())]))


def words_of(text: Column) -> Column:
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(folded, SEPARATOR), lambda w: w != "")


def windows(items: DataFrame, key: str, texts: tuple[str, ...] = ("text",), size: int = WINDOW) -> DataFrame:
    """Distinct (item, words): ``size`` consecutive words of an item's text, all of them if it has fewer; none without words."""
    parts = []
    for text in texts:
        w = words_of(F.col(text))
        found = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), w.alias("w")).where(F.size("w") > 0)
        starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
        parts.append(found.select("item", "w", F.explode(starts).alias("at")).select("item", F.array_join(F.slice("w", F.col("at"), size), " ").alias("words")))
    together = parts[0]
    for p in parts[1:]:
        together = together.unionByName(p)
    return together.distinct()


class Automaton:
    """Aho-Corasick over numbered words; made once in a Python worker."""

    def __init__(self, pairs: list[tuple[str, str]]):
        self.numbers: dict[bytes, int] = {}
        self.items: list[set[str]] = []
        self.sizes: list[int] = []
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        places: dict[str, int] = {}
        for item, window in pairs:
            if window not in places:
                places[window] = len(places)
                numbers = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in window.encode().split(b" "))
                self.items.append(set())
                self.sizes.append(len(numbers))
                self.machine.add_word(numbers, places[window])
            self.items[places[window]].add(item)
        if places:
            self.machine.make_automaton()

    def search(self, raw: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, spans of words that stand in windows, apart from each other, and the items of the windows."""
        number, n, found, reading = self.numbers.get, 0, [], None
        for piece in _pieces(raw):
            own = tuple([number(w, 0) for w in piece.split()])
            n += len(own)
            if not self.items or not own:
                continue
            if reading is None:
                reading = self.machine.iter(own)
            else:
                reading.set(own, False)  # the automaton and its count of words go on
            found += [(end + 1 - self.sizes[k], end + 1, k) for end, k in reading]
        spans: list[tuple[int, int]] = []
        for first, last, _ in sorted(found):
            if spans and first <= spans[-1][1]:
                spans[-1] = spans[-1][0], max(last, spans[-1][1])
            else:
                spans.append((first, last))
        return n, spans, set().union(*(self.items[k] for k in {k for *_, k in found}))


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A folded text in pieces of some size that end behind a word."""
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE)
        end = len(raw) if end < 0 else end
        yield raw[at:end]
        at = end


def _places(raw: bytes, spans: list[tuple[int, int]]) -> list[dict]:
    """Spans of words with their code points in the text; raw: its folded bytes."""
    out = [{"first": a, "last": b} for a, b in spans]
    firsts, lasts = np.array([a for a, _ in spans]), np.array([b - 1 for _, b in spans])
    words = points = 0
    for piece in _pieces(raw):
        data = np.frombuffer(piece, np.uint8)
        inside = np.concatenate(([False], data != 0x20, [False]))
        begin, end = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
        before = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80))) + points
        for name, own, at in (("start", firsts, begin), ("end", lasts, end)):
            for k in range(*np.searchsorted(own, (words, words + len(begin))).tolist()):
                out[k][name] = int(before[at[own[k] - words]])
        words, points = words + len(begin), int(before[-1])
    return out


_made: dict[str, Automaton] = {}


def _scan(batches: Iterator[pa.RecordBatch], name: str, shared) -> Iterator[pa.RecordBatch]:
    if name not in _made:  # a worker keeps the automaton for its next tasks, and only the latest
        _made.clear()
        _made[name] = Automaton(shared.value)
    automaton = _made[name]
    for part in (b.slice(k, 64) for b in batches for k in range(0, len(b), 64)):
        sizes, hits, places, items = [], [], [], []
        for raw in part.column(1).to_pylist():
            raw = (raw or b"").translate(FOLD)
            n, spans, found = automaton.search(raw)
            sizes.append(n)
            hits.append(sum(b - a for a, b in spans))
            places.append(_places(raw, spans) if spans else [])
            items.append(sorted(found))
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(sizes, pa.int64()), pa.array(hits, pa.int64()), pa.array(places, _SPANS), pa.array(items, pa.list_(pa.string()))],
            names=["row", "n_words", "n_hit", "spans", "items"],
        )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of several automatons over one text as spans that are apart from each other."""
    for part in batches:
        hits, places, items = [], [], []
        for spans, names in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
            out: list[dict] = []
            for s in sorted(spans, key=lambda s: s["first"]):
                if out and s["first"] <= out[-1]["last"]:
                    if s["last"] > out[-1]["last"]:
                        out[-1] |= {"last": s["last"], "end": s["end"]}
                else:
                    out.append(s)
            hits.append(sum(s["last"] - s["first"] for s in out))
            places.append(out)
            items.append(sorted(set(names)))
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(hits, pa.int64()), pa.array(places, _SPANS), pa.array(items, pa.list_(pa.string()))], names=["row", "n_words", "n_hit", "spans", "items"])


def contaminated(docs: DataFrame, key: str, items: DataFrame, item_key: str, text: str = "text", item_texts: tuple[str, ...] = ("text",), size: int = WINDOW, most: int = MOST_WINDOWS) -> DataFrame:
    """One row per row of ``docs``: ``key``, n_words, n_hit, spans (start and end in code points, of what stands in windows), items (sorted as strings).

    Words are runs of digits, a-z (A-Z are lower-cased) and code points from 128
    on. Null and empty texts have no words and no hits; items without words are
    never found; repeated items count once by their id (a null id is the empty
    string); repeated documents each have their row; other columns are left
    aside. Only one automaton of at most ``most`` windows is sent to the tasks
    at a time; texts are searched with one after another if there are more
    windows, and the findings of each row are merged.
    """
    spark = docs.sparkSession
    pairs = stage_table(windows(items, item_key, item_texts, size))
    parts = -(-pairs.count() // most) or 1
    shape = "row {}, n_words long, n_hit long, spans array<struct<start:bigint,end:bigint,first:bigint,last:bigint>>, items array<string>"

    def scanned(rows: DataFrame, part: int) -> DataFrame:
        own = pairs if parts == 1 else pairs.where(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == part)
        shared, name = spark.sparkContext.broadcast([tuple(r) for r in own.collect()]), uuid.uuid4().hex  # about ``most`` rows, no more
        return rows.select("row", F.col("text").cast("binary").alias("text")).mapInArrow(lambda batches: _scan(batches, name, shared), shape.format(rows.schema["row"].dataType.simpleString()))

    rows = docs.select(F.col(key).alias("row"), F.col(text).alias("text"))
    if parts == 1:
        keyed = scanned(rows, 0)
    else:
        rows = stage_table(docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("text")))
        each = [scanned(rows, k) for k in range(parts)]
        together = each[0]
        for e in each[1:]:
            together = together.unionByName(e.where("n_hit > 0"))
        grouped = together.groupBy("row").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
        merged = grouped.mapInArrow(_merged, shape.format("long"))
        keyed = rows.select("row", "key").join(merged, "row").drop("row").withColumnRenamed("key", "row")
    return keyed.select(F.col("row").alias(key), "n_words", "n_hit", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("spans"), "items")


def op13(spark, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "benchmark"), "item_id")
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
