"""Order MinHash fingerprints, sensitive to edit distance, in DataFrame functions only.

A text is a sequence of units: words, and the code points of long words (texts
without spaces, encoded data). Its k-mers are runs of K units. Every k-mer is
numbered by its occurrence in the text, and each numbered k-mer gets a hash that
decides its bin and its rank there. Each of the BINS bins selects its two
smallest numbered k-mers, puts them back in the order of the text and hashes the
pair: texts agree in a bin if they share the same k-mers in the same order.
(One hash with bins takes the place of one hash function per entry.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import input_bytes, stage_table
from .packed import MOST_PARTITIONS

K = 3
LONG_WORD = 48  # UTF-8 bytes; a longer word counts as its code points
BIN_BITS, RANK_BITS, PLACE_BITS = 6, 30, 28  # 64 bits: bin, rank in the bin, place in the text
HASH_BITS = 64 - PLACE_BITS
KNOTS, STEP = 4096, 64  # quantiles of the keys, looked up in two steps
BLOCK_BYTES, PER_TASK, MOST_BLOCKS = 512 << 10, 16, 1 << 17
HOT = 64  # a key with more than one of so many rows is split by its texts


def _prev(a: Column, by: int = 1) -> Column:
    """The array moved right by ``by``, nulls first."""
    n = F.size(a) - by
    return F.when(n > 0, F.concat(F.array_repeat(F.lit(None).cast("bigint"), by), F.slice(a, 1, n))).otherwise(
        F.array_repeat(F.lit(None).cast("bigint"), F.size(a))
    )


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: array of longs, for each bin in use (bin << 32 | hash of its pair), by bin.

    Every step is a column of its own, so that no step is computed twice.
    """
    place = F.lit((1 << PLACE_BITS) - 1).cast("bigint")
    step = f"{name}_step"
    words = F.filter(F.split(F.col(text), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    long_word = lambda w: F.octet_length(w) > LONG_WORD
    df = df.withColumn(step, words)
    cut = F.flatten(F.transform(step, lambda w: F.when(long_word(w), F.split(w, "")).otherwise(F.array(w))))
    df = df.withColumn(step, F.when(F.exists(step, long_word), cut).otherwise(F.col(step)))
    df = df.withColumn(step, F.transform(step, lambda w: F.xxhash64(w)))
    n = F.size(step)
    kmers = F.when(
        n >= K,
        F.zip_with(
            F.zip_with(F.slice(step, 1, n - 2), F.slice(step, 2, n - 2), lambda a, b: F.xxhash64(a, b)),
            F.slice(step, 3, n - 2),
            lambda ab, c: F.xxhash64(ab, c),
        ),
    ).otherwise(F.when(n > 0, F.array(F.xxhash64(F.col(step)))).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn(step, kmers)
    # k-mers by hash and then by place: the upper bits are the k-mer's, the lower its place
    df = df.withColumn(
        step, F.sort_array(F.transform(step, lambda h, i: h.bitwiseAND(F.bitwise_not(place)).bitwiseOR(i.cast("bigint").bitwiseAND(place))))
    )
    # starts of the runs of equal k-mers, as (start, k-mer)
    starts = F.filter(
        F.transform(
            F.zip_with(F.col(step), _prev(F.col(step)), lambda x, p: F.when(p.isNull() | (F.shiftright(x, PLACE_BITS) != F.shiftright(p, PLACE_BITS)), x)),
            lambda x, i: F.when(x.isNotNull(), i),
        ),
        lambda i: i.isNotNull(),
    )
    df = df.withColumn(f"{name}_runs", starts)
    runs, sorted_ = F.col(f"{name}_runs"), F.col(step)

    def numbered(start: Column, end: Column) -> Column:
        """Hashes of the occurrences 0, 1, ... of one k-mer with their places."""
        return F.transform(
            F.slice(sorted_, start + 1, end - start),
            lambda x, o: F.xxhash64(F.shiftright(x, PLACE_BITS), o).bitwiseAND(F.bitwise_not(place)).bitwiseOR(x.bitwiseAND(place)),
        )

    ends = F.when(F.size(runs) > 0, F.concat(F.slice(runs, 2, F.size(runs)), F.array(F.size(sorted_)))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(step, F.sort_array(F.flatten(F.zip_with(runs, ends, numbered)))).drop(f"{name}_runs")
    # by bin and rank: the first two of each bin
    bin_of = lambda x: F.shiftright(x, 64 - BIN_BITS)
    df = df.withColumn(
        step,
        F.filter(
            F.zip_with(F.col(step), _prev(F.col(step), 2), lambda x, p: F.when(p.isNull() | (bin_of(x) != bin_of(p)), x)),
            lambda x: x.isNotNull(),
        ),
    )
    after = F.when(F.size(step) > 0, F.concat(F.slice(step, 2, F.size(step)), F.array(F.lit(None).cast("bigint")))).otherwise(F.col(step))
    before = F.transform(_prev(F.col(step)), lambda p: bin_of(p))
    firsts = F.zip_with(
        before,
        F.zip_with(F.col(step), after, lambda x, y: F.struct(x.alias("x"), y.alias("y"))),
        lambda p, s: F.when(p.isNull() | (p != bin_of(s["x"])), s),
    )
    head = lambda x: F.shiftright(x, PLACE_BITS)
    pair = lambda s: (
        F.when(s["y"].isNull() | (bin_of(s["y"]) != bin_of(s["x"])), F.xxhash64(head(s["x"])))
        .when(s["x"].bitwiseAND(place) < s["y"].bitwiseAND(place), F.xxhash64(head(s["x"]), head(s["y"])))
        .otherwise(F.xxhash64(head(s["y"]), head(s["x"])))
    )
    entries = F.transform(
        F.filter(firsts, lambda s: s.isNotNull()),
        lambda s: F.shiftleft(bin_of(s["x"]) + (1 << (BIN_BITS - 1)), 32).bitwiseOR(pair(s).bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))),
    )
    return df.withColumn(name, entries).drop(step)


def likeness(a: Column, b: Column) -> Column:
    """The share of the bins in use in which two fingerprints agree; two empty ones are alike."""
    bins = lambda f: F.transform(f, lambda x: F.shiftright(x, 32))
    used = F.size(F.array_union(bins(a), bins(b)))
    return F.when(used > 0, F.size(F.array_intersect(a, b)) / used).otherwise(F.lit(1.0)).cast("double")


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x)), 10, "0")), "")


def _with_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """Add ``block`` to rows (k, o, h, t): ascending in the order by o and h, with about even numbers of rows.

    Blocks lie between quantiles of o, and are cut by straight lines if there
    are more blocks than quantiles. A hot key's rows, and those of null keys,
    are split by h.
    """
    n = min(KNOTS, blocks)
    knots = rows.where("k IS NOT NULL").select(F.percentile_approx("o", [k / n for k in range(n + 1)], 10 * KNOTS).alias("q")).first()["q"] or [0]
    bounds, per = sorted(set(knots)), -(-blocks // n)
    hot = [x for x in bounds if knots.count(x) > 1 + n // HOT] if len(bounds) < len(knots) else []
    numbers = lambda x: F.split(F.lit(",".join(map(str, x))), ",").cast("array<bigint>")
    at = F.col("o")
    upper = F.greatest(F.size(F.filter(numbers(bounds[::STEP]), lambda x: x <= at)) - 1, F.lit(0)) * STEP
    rows = rows.withColumn("upper", upper)
    rows = rows.withColumn("place", F.col("upper") + F.size(F.filter(F.slice(numbers(bounds), F.col("upper") + 1, STEP), lambda x: x <= at)) - 1)
    low, high = (F.get(numbers(bounds), F.col("place") + k).cast("double") for k in (0, 1))
    inner = F.when(low.isNotNull() & high.isNotNull(), F.least(F.floor((at.cast("double") - low) * per / (high - low)), F.lit(per - 1))).otherwise(0)
    bits = max(0, blocks.bit_length() - 3)
    block = F.when(F.col("k").isNull(), F.lit(2 * MOST_BLOCKS)).otherwise(F.col("place") * per + inner).cast("long")
    split = F.when(F.col("k").isNull() | at.isin(hot), F.shiftright("h", 63 - bits)).otherwise(1 << bits)
    return rows.withColumn("block", block * ((1 << bits) + 1) + split).drop("upper", "place")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, one row per row of ``docs``.

    The edited text is the text without its last floor(n_chars / 4) code points
    and with the first as many of the next document (by ascending ``key``, then
    by a hash of the text; null keys come last, after the last comes the first).
    Columns: ``key``, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. A null text is empty; a text of fewer than K units
    has one k-mer, an empty one none and an empty fingerprint.

    Documents are dealt to blocks of neighbouring keys, so the texts move once;
    what follows the last document of a block comes from a table with one row
    per block.
    """
    blocks = min(MOST_BLOCKS, max(STEP, input_bytes(docs) // BLOCK_BYTES))
    rows = docs.select(
        F.col(key).alias("k"), F.coalesce(F.col(key), F.lit((1 << 63) - 1)).cast("long").alias("o"), F.coalesce(F.col(text), F.lit("")).alias("t")
    )
    placed = _with_blocks(rows.withColumn("h", F.shiftrightunsigned(F.xxhash64("t"), 1)), blocks)
    # the first document of every block: numbers, of about MOST_BLOCKS blocks (no more than HOT keys are split)
    firsts = stage_table(placed.groupBy("block").agg(F.min(F.struct("o", "h")).alias("first")).select("block", "first.*"))
    heads = placed.join(F.broadcast(firsts), ["block", "o", "h"]).groupBy("block").agg(F.min("t").alias("head_text"))
    in_turn = Window.orderBy("block")
    after = firsts.select("block", F.coalesce(F.lead("block").over(in_turn), F.first("block").over(in_turn)).alias("next_block"))
    heads = with_fingerprint(heads.withColumnRenamed("block", "next_block"), "head_text", "head_print")
    heads = stage_table(after.join(heads, "next_block").drop("next_block").withColumnRenamed("block", "head_block"))

    here = Window.partitionBy("block").orderBy("o", "h", "t")
    # several blocks to a task, so that hashed blocks make even tasks
    own = with_fingerprint(placed.repartition(min(MOST_PARTITIONS, -(-blocks // PER_TASK)), "block"), "t", "print")
    own = own.select("*", F.lead("t").over(here).alias("next_text"), F.lead("print").over(here).alias("next_print"))
    own = own.join(heads, (F.col("block") == F.col("head_block")) & F.col("next_text").isNull(), "left").select(
        "k", "t", "print", F.length("t").alias("n"),
        F.coalesce("next_text", "head_text").alias("next_text"), F.coalesce("next_print", "head_print").alias("next_print"),
    )
    moved = F.floor(F.col("n") / 4).cast("int")
    own = own.withColumn("edited", F.concat(F.col("t").substr(F.lit(1), F.col("n") - moved), F.col("next_text").substr(F.lit(1), moved)))
    own = with_fingerprint(own, "edited", "edited_print")
    return own.select(
        F.col("k").alias(key),
        F.col("n").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("print")).alias("fingerprint"),
        as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )


def op9(spark, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
