"""Spelling variants: a symmetric-delete join of words, and the roots that their forms lead to.

Every word emits itself and its single deletions as 64-bit keys. Words that
share a key at the same place differ by one replaced code point, a word that is
another's deletion by one inserted or deleted; the join asks for just these, so
it makes no pairs of words that merely share a key. Each pair is verified on
the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table, table
from . import packed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT, TIMES, TYPO = 7, 2, 10, 31
SAME_PLACE, ITSELF, DELETION = range(3)  # kinds of keys
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def runs(text: Column, least: int = 1) -> Column:
    """Maximal runs of Latin letters of at least so many code points; only A-Z are lower-cased."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(f"([a-zÀ-ÿ]{{{least},}})"), F.lit(1))


def without(word: Column, place: Column) -> Column:
    """The word without the code point at a place (from 0)."""
    place = place.cast("int")
    return F.concat(word.substr(F.lit(1), place), word.substr(place + 2, F.length(word)))


def with_typos(key: Column, run: Column) -> Column:
    """The run, or it without one code point where 31 divides the crc32 of ``key:run``. A null key is empty."""
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run))
    return F.when(h % TYPO == 0, without(run, h % F.length(run))).otherwise(run)


def word_counts(docs: DataFrame, key: str, text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, typos: bool = True) -> DataFrame:
    """word and n (occurrences in all documents) of the words that are long and frequent enough.

    typos: ``with_typos`` is applied to every run. Null and empty texts have no
    words; repeated rows count each.
    """
    found = docs.select(F.col(key).alias("key"), F.explode(runs(F.col(text), least_length)).alias("run"))
    word = with_typos(F.col("key"), F.col("run")) if typos else F.col("run")
    words = found.select(word.alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _keys(batches: Iterator[pa.RecordBatch], kind: int) -> Iterator[pa.RecordBatch]:
    """(word_key, place, id) of one kind: each word's deletions by place, itself, or its distinct deletions.

    A key is a polynomial over mixed code points modulo 2^64, so all deletions
    of a word take time in proportion to its length.
    """
    for part in (b.slice(k, 4096) for b in batches for k in range(0, len(b), 4096)):
        ids, words = part.column(0).to_numpy(), part.column(1).to_pylist()
        sizes = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        begin = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(points)) - begin[owner]
        powers = np.full(int(sizes.max(initial=0)) + 1, _BASE, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        upto = np.concatenate(([np.uint64(0)], np.cumsum(packed.mixed(points.astype(np.uint64) + np.uint64(1)) * powers[place], dtype=np.uint64)))
        first, end = upto[begin], upto[begin + sizes]
        lengths = sizes.astype(np.uint64) * packed.FACTORS[0]
        if kind == ITSELF:
            keys, place, owner = packed.mixed((end - first) ^ packed.mixed(lengths)), np.zeros(len(words), np.int64), np.arange(len(words))
        else:
            cut = (upto[:-1] - first[owner]) + (end[owner] - upto[1:]) * _INVERSE
            keys = packed.mixed(cut ^ packed.mixed(lengths[owner] - packed.FACTORS[0]))
            if kind == SAME_PLACE:
                keys = packed.mixed(keys + place.astype(np.uint64) * packed.FACTORS[1])
            else:
                fresh = (place == 0) | (points != np.roll(points, 1))  # equal neighbours give the same deletion
                keys, place, owner = keys[fresh], place[fresh], owner[fresh]
        for k in range(0, len(keys), 1 << 16):
            at = slice(k, k + (1 << 16))
            columns = [pa.array(keys[at].view(np.int64)), pa.array(place[at].astype(np.int32)), pa.array(ids[owner[at]])]
            yield pa.RecordBatch.from_arrays(columns, names=["word_key", "place", "id"])


def near_pairs(words: DataFrame) -> DataFrame:
    """Words (id, word, n) that differ by exactly one inserted, deleted or replaced code point: structs a and b, each pair once."""
    rows = words.select("id", "word")
    same, itself, deleted = (rows.mapInArrow(lambda batches, kind=kind: _keys(batches, kind), "word_key long, place int, id long") for kind in (SAME_PLACE, ITSELF, DELETION))
    # both sides are one exchange, which Spark reuses
    replaced = same.alias("x").join(same.alias("y"), F.col("x.word_key") == F.col("y.word_key")).where("x.id < y.id")
    replaced = replaced.select(F.col("x.id").alias("id"), F.col("x.place").alias("at"), F.col("y.id").alias("other"), F.col("y.place").alias("other_at"))
    longer = deleted.alias("x").join(itself.alias("y"), F.col("x.word_key") == F.col("y.word_key"))
    longer = longer.select(F.col("x.id").alias("id"), F.col("x.place").alias("at"), F.col("y.id").alias("other"), F.lit(-1).alias("other_at"))
    own = F.struct("id", "word", "n")
    pairs = replaced.unionByName(longer).join(words.select("id", own.alias("a")), "id")
    pairs = pairs.join(words.select(F.col("id").alias("other"), own.alias("b")), "other")
    a, b = F.col("a.word"), F.col("b.word")
    cut_b = F.when(F.col("other_at") < 0, b).otherwise(without(b, F.col("other_at")))
    return pairs.where((a != b) & (without(a, F.col("at")) == cut_b)).select("a", "b")


def grouped(words: DataFrame, times: int = TIMES) -> DataFrame:
    """Words (word, n) with their nearest frequent form and its root: word, form, root, n, n_near, form_n.

    form: the near word with the largest n (ties: the least in code-point order),
    if it occurs at least ``times`` as often, which is at least twice; root: the
    end of the chain of forms. Words are distinct and not null; n is positive.
    Words of any length are compared in time in proportion to it.
    """
    if times < 2:
        raise ValueError("a form occurs at least twice as often as its variant")
    words = stage_table(words.select(F.monotonically_increasing_id().alias("id"), "word", "n"))
    sides = [F.struct(F.col(x)["id"].alias("id"), F.struct((-F.col(y)["n"]).alias("minus"), F.col(y)["word"].alias("word"), F.col(y)["id"].alias("form_id")).alias("best")) for x, y in ("ab", "ba")]
    near = near_pairs(words).select(F.inline(F.array(*sides))).groupBy("id").agg(F.count("*").alias("n_near"), F.min("best").alias("best"))
    near = words.join(near, "id", "left")
    best = F.col("best")
    has = -best["minus"] >= times * F.col("n")
    near = near.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *(F.when(has, c).alias(x) for x, c in (("form", best["word"]), ("form_n", -best["minus"]), ("form_id", best["form_id"]))))
    near = stage_table(near)
    # counts grow by ``times`` from form to form, so chains are short; every round doubles what a link spans
    most = near.agg(F.max("n")).first()[0] or 1
    longest, count = 0, 1
    while count * times <= most:
        longest, count = longest + 1, count * times
    links = near.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("root_id"))
    for _ in range(max(0, longest - 1).bit_length()):
        after = links.select(F.col("id").alias("root_id"), F.col("root_id").alias("next"))
        links = stage_table(links.join(after, "root_id", "left").select("id", F.coalesce("next", "root_id").alias("root_id")))
    roots = links.join(words.select(F.col("id").alias("root_id"), F.col("word").alias("root")), "root_id").select("id", "root")
    return near.join(roots, "id", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12(spark, sf_dir: str) -> DataFrame:
    return grouped(word_counts(table(spark, sf_dir, "documents"), "doc_id"))
