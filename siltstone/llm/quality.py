"""Quality rules and line labelling with a linear-chain conditional random field.

Every line that has a word is a node of a two-state chain, boilerplate (0) or
content (1). Viterbi decoding marks the lines; the share of a document's words
that stand in content lines decides whether it is kept. The field is trained
here on labelled documents: a bounded sample gives the line features, and the
label of a document stands for the labels of its lines.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
FEATURES = (
    "bias", "upper words", "symbols", "exclamations", "lone symbols", "digits", "repeated neighbours",
    "distinct words", "repeated line", "ends a sentence", "short line", "word length", "trailing junk",
)
TRAINING_RUNS = 6  # parts of a longer document that its lines for training come from
TRAINING_DOCUMENTS, TRAINING_LINES = 2000, 60  # bounds of the sample: documents, and lines of each


@dataclass(frozen=True)
class Field:
    """weights: of content against boilerplate, by feature. moves[a][b]: score of state b after a."""

    weights: tuple[float, ...]
    moves: tuple[tuple[float, float], tuple[float, float]] = field(default=((0.0, 0.0), (0.0, 0.0)))


#: Used where no labelled document is at hand: lines are content unless symbols, capitals or repeats fill them.
UNTRAINED = Field((2.0, -4.0, -12.0, -6.0, -6.0, -4.0, -6.0, 0.5, -1.0, 0.5, 0.0, 0.0, -6.0), ((0.5, -0.5), (-0.5, 0.5)))


def line_features(line: bytes, words: list[bytes], repeated: bool) -> tuple[float, ...]:
    n, size = len(words), len(line)
    return (
        1.0,
        sum(map(bytes.isupper, words)) / n,
        (size - len(line.translate(None, SYMBOLS))) / size,
        line.count(b"!") / n,
        words.count(b"|") / n,
        (size - len(line.translate(None, b"0123456789"))) / size,
        sum(map(eq, words, words[1:])) / n,
        len(set(words)) / n,
        float(repeated),
        float(line.rstrip()[-1:] in b".?!"),
        float(n < 4),
        min(sum(map(len, words)) / n / 10.0, 3.0),
        sum(w[-2:] in (b"!!", b"##", b"**", b"$$", b"%%", b"&&") for w in words) / n,
    )


def worded_lines(raw: bytes) -> tuple[list[tuple[bytes, list[bytes]]], list[bool]]:
    """The lines that have a word, with their words, and whether an earlier line is the same."""
    lines, again, seen = [], [], set()
    for line in raw.split(b"\n"):
        words = line.split()  # of bytes: splits at the six ASCII space characters only
        if words:
            lines.append((line, words))
            again.append(line in seen)
            seen.add(line)
    return lines, again


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of three words found at least twice in the text."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    at = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    kinds = len(ids)
    _, pair = np.unique(at[:-1] * kinds + at[1:], return_inverse=True)  # re-numbered, so that no product overflows
    _, window, count = np.unique(pair[:-1] * kinds + at[2:], return_inverse=True, return_counts=True)
    often = count[window] > 1
    covered = np.zeros(n, bool)
    covered[:-2] |= often
    covered[1:-1] |= often
    covered[2:] |= often
    return int(covered.sum())


def viterbi(emissions: list[float], moves) -> list[int]:
    """The best states of a chain; emissions are scores of content against boilerplate. Ties go to content."""
    (s00, s01), (s10, s11) = moves
    back = []
    low, high = 0.0, emissions[0]
    for e in emissions[1:]:
        from_low = low + s00 > high + s10
        to_high = low + s01 > high + s11
        back.append((0 if from_low else 1, 0 if to_high else 1))
        low, high = max(low + s00, high + s10), max(low + s01, high + s11) + e
    state = 1 if high >= low else 0
    states = [state]
    for choice in reversed(back):
        state = choice[state]
        states.append(state)
    return states[::-1]


def measure(text: str | None, model: Field) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    lines, again = worded_lines(raw)
    n = len(words)
    spaces = sum(map(text.count, " \t\n\v\f\r"))
    n_repeat = repeated_words(words)
    failed = n < LEAST_WORDS or 100 * n_repeat > MOST_REPEATED_PERCENT * n
    share = 0.0
    if lines:
        features = np.array([line_features(line, own, a) for (line, own), a in zip(lines, again, strict=True)])
        states = viterbi((features @ np.array(model.weights)).tolist(), model.moves)
        share = sum(len(own) for (_, own), s in zip(lines, states, strict=True) if s) / n
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return n, len(text) - spaces, symbols, sum(again), n_repeat, failed, share, not failed and share >= 0.5


def fit(chains: list[tuple[np.ndarray, int]], rounds: int = 80, penalty: float = 1e-2) -> Field:
    """Maximum likelihood of the field by gradient ascent, forward and backward sums over all chains at once.

    chains: the features of a document's lines, and its label. The number of
    rounds and the order of sums are fixed, so refits agree.
    """
    chains = [c for c in chains if len(c[0])]
    if len({label for _, label in chains}) < 2:
        return UNTRAINED
    k, longest = len(FEATURES), max(len(x) for x, _ in chains)
    x = np.zeros((longest, len(chains), k))
    live = np.zeros((longest, len(chains)), bool)
    for j, (rows, _) in enumerate(chains):
        x[: len(rows), j] = rows
        live[: len(rows), j] = True
    gold = np.array([label for _, label in chains])
    per_class = np.bincount(gold, minlength=2)
    importance = (len(chains) / (2.0 * per_class))[gold] / live.sum(0)  # classes and documents count alike
    w, moves = np.zeros(k), np.zeros((2, 2))
    speed_w, speed_m = np.zeros(k), np.zeros((2, 2))
    gold_w = np.einsum("tjk,j->k", x * live[..., None], importance * gold)
    steps = (live[1:] * importance).sum(0)
    gold_m = np.diag([steps[gold == 0].sum(), steps[gold == 1].sum()])
    for _ in range(rounds):
        emit = np.zeros((longest, len(chains), 2))
        emit[..., 1] = x @ w
        forward = np.zeros_like(emit)
        forward[0] = emit[0]
        for t in range(1, longest):
            nxt = np.logaddexp(forward[t - 1, :, 0, None] + moves[0], forward[t - 1, :, 1, None] + moves[1]) + emit[t]
            forward[t] = np.where(live[t][:, None], nxt, forward[t - 1])
        total = np.logaddexp(forward[-1, :, 0], forward[-1, :, 1])
        backward = np.zeros((len(chains), 2))
        expect_w, expect_m = np.zeros(k), np.zeros((2, 2))
        for t in range(longest - 1, -1, -1):
            p = np.exp(forward[t] + backward - total[:, None])
            expect_w += x[t].T @ (p[:, 1] * importance * live[t])
            if t:
                joint = np.exp(forward[t - 1][:, :, None] + moves + (emit[t] + backward)[:, None, :] - total[:, None, None])
                expect_m += np.einsum("jab,j->ab", joint, importance * live[t])
                before = np.logaddexp(moves[:, 0] + (emit[t, :, 0] + backward[:, 0])[:, None], moves[:, 1] + (emit[t, :, 1] + backward[:, 1])[:, None])
                backward = np.where(live[t][:, None], before, backward)
        scale = 1.0 / importance.sum()
        speed_w = 0.9 * speed_w + (gold_w - expect_w) * scale - penalty * 0.1 * w
        speed_m = 0.9 * speed_m + (gold_m - expect_m) * scale - penalty * moves
        w, moves = w + 1.0 * speed_w, moves + 0.3 * speed_m
    return Field(tuple(w.tolist()), tuple(map(tuple, moves.tolist())))


def spread(n: int, most: int, seed: int) -> list[tuple[int, int]]:
    """Runs (begin, end) of ``most`` of n lines: all, or one run at a seeded place in each of equal parts."""
    if n <= most:
        return [(0, n)] if n else []
    parts = max(1, min(TRAINING_RUNS, most))
    rng, runs = random.Random(seed), []
    for k in range(parts):
        lo, hi = n * k // parts, n * (k + 1) // parts
        size = min(most * (k + 1) // parts - most * k // parts, hi - lo)
        at = lo + rng.randint(0, hi - lo - size)
        runs.append((at, at + size))
    return runs


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", most: int = TRAINING_DOCUMENTS, most_lines: int = TRAINING_LINES) -> Field:
    """Fit the field on at most ``most`` labelled documents (a seeded sample) and ``most_lines`` lines of each.

    Longer documents give runs of lines from all their parts (``spread``). Null
    labels are ignored; where a key has several the smallest counts, and of rows
    that repeat a key one.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("label_key"))
        .agg(F.min(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("label_key", F.lit(11)), "label_key")
        .limit(most)
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(2).to_pylist():
                lines, again = worded_lines((value or "").encode())
                told = list(zip(lines, again, strict=True))
                runs = spread(len(told), most_lines, xxhash.xxh3_64_intdigest((value or "").encode()))
                rows.append([[v for (line, own), a in told[lo:hi] for v in line_features(line, own, a)] for lo, hi in runs])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.list_(pa.float64())))], names=["label_key", "label", "rows"])

    schema = T.StructType(
        [T.StructField("label_key", docs.schema[key].dataType), T.StructField("label", T.IntegerType()), T.StructField("rows", T.ArrayType(T.ArrayType(T.DoubleType())))]
    )
    # at most ``most`` rows of two numbers are broadcast
    rows = docs.select(F.col(key).alias("label_key"), F.col(text).alias("label_text")).join(F.broadcast(chosen), "label_key")
    told = rows.select("label_key", "label", "label_text").mapInArrow(features, schema)
    found = told.groupBy("label_key").agg(F.min(F.struct("label", "rows")).alias("r")).select("label_key", "r.*").collect()
    found.sort(key=lambda r: r["label_key"])
    return fit([(np.array(run).reshape(-1, len(FEATURES)), int(r["label"] > 0)) for r in found for run in r["rows"] or [[]]])


COLUMNS = (
    ("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()), ("n_dup_lines", T.LongType()),
    ("n_repeat_words", T.LongType()), ("base_failed", T.BooleanType()), ("content_share", T.DoubleType()), ("kept", T.BooleanType()),
)


def judge(docs: DataFrame, model: Field, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """The measures and the verdict of every whole text, one row per row of ``docs``, with the columns ``carry``.

    A null or empty text has no words and fails the base rules. All lines are
    decoded, of texts of any length.
    """
    schema = T.StructType([docs.schema[c] for c in (key, *carry)] + [T.StructField(*c) for c in COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                columns = zip(*(measure(value, model) for value in part.column(0).to_pylist()), strict=True)
                own = [pa.array(v, pa.int64() if isinstance(t, T.LongType) else pa.bool_() if isinstance(t, T.BooleanType) else pa.float64()) for v, (_, t) in zip(columns, COLUMNS, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *own], names=schema.names)

    return docs.select(F.col(text).alias("judged_text"), key, *carry).mapInArrow(run, schema)


def op2(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return judge(docs, train(docs, labels))
