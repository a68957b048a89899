"""Mixing overlapping sources to target weights with a min-cost flow.

Documents are aggregated by membership pattern (the set of sources that a
document belongs to). A min-cost flow routes words from patterns to source
quotas; the cost of a pattern's words is convex in how often they are repeated,
so repetition is spread before anything is repeated more. Whole documents are
then selected in a seeded order until each pattern's share is used up: a
document that is larger than what is missing is passed over, and the run goes
on behind it. What is then still missing comes from the smallest documents of
the pattern, by a subset sum.

Only aggregates reach the driver: one row per membership pattern, 1024 histogram
bins per pattern for each level of the selection, and a few hundred of its
smallest documents. None of them grows with the number of documents; tables of
too many patterns are refused.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table

WORD = r"[^\x20\x09-\x0D]+"
BIN_BITS, LEVELS = 10, 6
LAST = 1 << BIN_BITS * LEVELS  # above every order
ROUNDS = 8  # runs through the order, each behind the document at which the one before ended
NEAR = 2000  # a pattern is done if less than one in so many of its words is missing
FILLERS = 256  # smallest documents of a pattern that are chosen anew to meet its share
MOST_PATTERNS = 100_000  # sets of sources that the driver routes words between


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_order(sources: Iterable[str | None]) -> list[str | None]:
    return sorted(sources, key=lambda s: (s is None, s or ""))


def cycled_weights(sources: list[str | None]) -> dict[str | None, float]:
    return {s: float(k % 3 + 1) for k, s in enumerate(sources)}


def water_fill(total: float, weights: dict, ceilings: dict) -> dict:
    """Shares of ``total`` by weight; what exceeds a ceiling is shared again among the others."""
    capped: dict = {}
    while True:
        free = [s for s in weights if s not in capped]
        mass = sum(weights[s] for s in free)
        left = total - sum(capped.values())
        shares = {s: left * weights[s] / mass for s in free} if mass else {}
        over = [s for s in free if shares[s] > ceilings[s]]
        if not over:
            return {s: float(capped[s] if s in capped else shares[s]) for s in weights}
        capped |= {s: float(ceilings[s]) for s in over}


def min_cost_flow(supply: list[int], members: list[list[int]], quotas: list[int], most: int) -> list[list[int]]:
    """Words that each pattern gives each of its sources.

    The k-th use of a pattern's words costs k*k per word (convex in the number
    of uses, ``most`` uses at most). Successive shortest paths: every path ends
    in a source below its quota, so the quotas are filled as far as they can be
    at the least total cost.
    """
    n, m = len(supply), len(quotas)
    root, sink = n + m, n + m + 1
    head: list[list[int]] = [[] for _ in range(n + m + 2)]
    to: list[int] = []
    room: list[int] = []
    cost: list[int] = []

    def arc(a: int, b: int, capacity: int, price: int) -> int:
        head[a].append(len(to))
        head[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((capacity, 0))
        cost.extend((price, -price))
        return len(to) - 2

    for p, words in enumerate(supply):
        for k in range(1, most + 1):
            arc(root, p, words, k * k)
    flows = [[(s, arc(p, n + s, most * supply[p], 0)) for s in own] for p, own in enumerate(members)]
    for s, quota in enumerate(quotas):
        arc(n + s, sink, quota, 0)
    while True:
        best = [float("inf")] * (n + m + 2)
        via = [-1] * (n + m + 2)
        best[root], queue, waiting = 0, [root], {root}
        while queue:  # residual arcs may have negative prices
            a = queue.pop(0)
            waiting.discard(a)
            for e in head[a]:
                if room[e] and best[a] + cost[e] < best[to[e]]:
                    best[to[e]], via[to[e]] = best[a] + cost[e], e
                    if to[e] not in waiting:
                        waiting.add(to[e])
                        queue.append(to[e])
        if via[sink] < 0:
            break
        path, at = [], sink
        while at != root:
            path.append(via[at])
            at = to[via[at] ^ 1]
        pushed = min(room[e] for e in path)
        for e in path:
            room[e] -= pushed
            room[e ^ 1] += pushed
    out = []
    for own in flows:
        row = [0] * m
        for s, e in own:
            row[s] = room[e ^ 1]
        out.append(row)
    return out


@dataclass
class Share:
    """What a mix takes of a pattern: all documents ``whole`` times, and those of ``picks`` once more.

    A pick (first, stop, largest) means the documents of at most ``largest``
    words whose order lies from ``first`` to before ``stop``. missing: words of
    the share that no pick covers yet. near: so few missing words don't matter.
    Documents up to ``bound`` (size and order) are taken as ``filled`` says
    instead: size, order and copies.
    """

    whole: int
    missing: int
    near: int
    picks: list[tuple[int, int, int]] = field(default_factory=list)
    filled: list[tuple[int, int, int]] = field(default_factory=list)
    bound: tuple[int | None, int | None] = (None, None)

    def takes(self, size: int, order: int) -> int:
        return self.whole + any(first <= order < stop and size <= largest for first, stop, largest in self.picks)


class Mix:
    """How often a mix takes each document, and the sources with their sizes and targets.

    sources: array of the names of a document's sources (a null name is a
    source of its own; a null or empty array counts as [null]). size: words;
    null is 0. The sources' targets share the sum of all sizes by ``weights``;
    no target is above ``most`` times its source's size. Whole documents are
    taken 0 to ``most`` times, in an order seeded by (seed, key), so reruns
    agree; rows with equal keys, sources and sizes are taken alike. Empty tables
    give no rows.

    rows: (key, mix_pattern, mix_size, mix_order) of all documents, written.
    sources: name, size and target of each source.
    """

    def __init__(
        self,
        docs: DataFrame,
        key: str,
        sources: Column,
        size: Column,
        weights: Callable[[list[str | None]], dict] = cycled_weights,
        most: int = 3,
        seed: int = 7,
    ):
        names = F.when(F.size(sources) > 0, F.array_distinct(sources)).otherwise(F.array(F.lit(None).cast("string")))
        self._facts = [
            F.to_json(F.array_sort(names)).alias("mix_pattern"),
            F.coalesce(size, F.lit(0)).cast("long").alias("mix_size"),
            F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(seed)), 64 - BIN_BITS * LEVELS).alias("mix_order"),
        ]
        self.rows = stage_table(docs.select(F.col(key), *self._facts))
        # the number of patterns is that of distinct source sets, not of documents
        totals = [
            (r["mix_pattern"], r["names"], int(r["words"]))
            for r in self.rows.groupBy("mix_pattern")
            .agg(F.sum("mix_size").alias("words"))
            .withColumn("names", F.from_json("mix_pattern", "array<string>"))
            .limit(MOST_PATTERNS + 1)
            .collect()
        ]
        if len(totals) > MOST_PATTERNS:
            raise ValueError(f"more than {MOST_PATTERNS} different sets of sources")
        totals.sort(key=lambda r: r[0])
        sizes: dict[str | None, int] = {}
        for _, own, words in totals:
            for s in own:
                sizes[s] = sizes.get(s, 0) + words
        ordered = source_order(sizes)
        targets = water_fill(sum(r[2] for r in totals), weights(ordered), {s: most * sizes[s] for s in ordered})
        place = {s: k for k, s in enumerate(ordered)}
        flow = min_cost_flow([r[2] for r in totals], [[place[s] for s in r[1]] for r in totals], [round(targets[s]) for s in ordered], most)
        shares = {}
        for (pattern, _, words), row in zip(totals, flow, strict=True):
            whole, rest = divmod(sum(row), words) if words else (0, 0)
            shares[pattern] = Share(whole, rest, words // NEAR)
        for _ in range(ROUNDS):
            _run_on(self.rows, shares)
        _fill(self.rows, shares, most)
        self._uses = _table(self.rows, [(p, v.whole, v.picks, v.filled, *v.bound) for p, v in shares.items()], USES)
        self.sources = [(s, sizes[s], targets[s]) for s in ordered]

    def _with_copies(self, rows: DataFrame) -> DataFrame:
        size, order = F.col("mix_size"), F.col("mix_order")
        small = (size > 0) & ((size < F.col("bound_size")) | ((size == F.col("bound_size")) & (order <= F.col("bound_order"))))
        filled = F.get(F.filter("filled", lambda x: (x["size"] == size) & (x["order"] == order)), F.lit(0))["copies"]
        copies = F.when(small, F.coalesce(filled, F.lit(0))).otherwise(F.col("whole") + _picked().cast("int"))
        return rows.join(F.broadcast(self._uses), "mix_pattern").withColumn("copies", copies)

    def taken(self) -> DataFrame:
        """rows with the number of copies that the mix takes."""
        return self._with_copies(self.rows).select(*self.rows.columns, "copies").drop("mix_order")

    def documents(self, docs: DataFrame) -> DataFrame:
        """The mixed documents: every row of ``docs`` as often as it is taken, without an exchange."""
        counted = self._with_copies(docs.select(F.struct("*").alias("row"), *self._facts)).where("copies > 0")
        return counted.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


PICKS = "array<struct<first: long, stop: long, largest: long>>"
USES = f"whole int, picks {PICKS}, filled array<struct<size: long, order: long, copies: int>>, bound_size long, bound_order long"


def _picked() -> Column:
    """Whether one of the picks of its pattern takes a document."""
    order, size = F.col("mix_order"), F.col("mix_size")
    return F.exists("picks", lambda p: (order >= p["first"]) & (order < p["stop"]) & (size <= p["largest"]))


def _table(like: DataFrame, rows: list[tuple], columns: str) -> DataFrame:
    return like.sparkSession.createDataFrame(rows, f"mix_pattern string, {columns}")


def _run_on(sized: DataFrame, shares: dict[str, Share]) -> None:
    """Add a pick to each unfinished share: the documents that fit, up to the first that does not.

    The end is found in histograms of the order, each level inside the bin of
    the level before, until that bin holds one document or hardly any words.
    """
    ends = {p: [v.picks[-1][1] + 1 if v.picks else 0, v.missing, 0] for p, v in shares.items() if v.missing > v.near}
    for level in range(1, LEVELS + 1):
        if not ends:
            return
        shift = BIN_BITS * (LEVELS - level)
        at = _table(sized, [(p, *v) for p, v in ends.items()], "first long, largest long, prefix long")
        inside = sized.join(F.broadcast(at), "mix_pattern").where(
            (F.shiftright("mix_order", shift + BIN_BITS) == F.col("prefix")) & (F.col("mix_order") >= F.col("first")) & (F.col("mix_size") <= F.col("largest"))
        )
        counts = inside.groupBy("mix_pattern", F.shiftright("mix_order", shift).alias("bin")).agg(
            F.sum("mix_size").alias("words"), F.count("*").alias("documents"), F.min("mix_order").alias("least")
        )
        bins: dict[str, list] = {}
        for r in counts.collect():
            bins.setdefault(r["mix_pattern"], []).append((r["bin"], r["words"], r["documents"], r["least"]))
        for p, end in list(ends.items()):
            share, stop = shares[p], LAST
            for b, words, documents, least in sorted(bins.get(p, [])):
                if words > share.missing:
                    stop = least if documents == 1 or level == LEVELS else b << shift if share.missing <= share.near else None
                    end[2] = b
                    break
                share.missing -= words
            if stop is not None:
                share.picks.append((end[0], stop, end[1]))
                del ends[p]


def _fill(sized: DataFrame, shares: dict[str, Share], most: int) -> None:
    """Choose the smallest documents of each unfinished share anew, so that their words come as near as can be to what they have to give."""
    open_ = [(p,) for p, v in shares.items() if v.missing > v.near]
    if not open_:
        return
    own = sized.where("mix_size > 0").join(F.broadcast(sized.sparkSession.createDataFrame(open_, "mix_pattern string")), "mix_pattern", "left_semi")
    # rows of one size and order are taken alike, and have one rank
    ranked = own.withColumn("place", F.rank().over(Window.partitionBy("mix_pattern").orderBy("mix_size", "mix_order"))).where(F.col("place") <= FILLERS)
    fillers: dict[str, list[tuple[int, int, int]]] = {}
    for r in ranked.groupBy("mix_pattern", "mix_size", "mix_order").agg(F.count("*").alias("n")).collect():
        fillers.setdefault(r["mix_pattern"], []).append((r["mix_size"], r["mix_order"], r["n"]))
    for p, found in fillers.items():
        share = shares[p]
        found.sort()
        words = [size * n for size, _, n in found]
        want = share.missing + sum(w * share.takes(size, order) for w, (size, order, _) in zip(words, found, strict=True))
        whole = share.whole
        copies = nearest_copies(words, want, whole, min(whole + 1, most))
        if abs(_words(words, copies) - want) * NEAR > want:  # few documents: how often each is taken may differ more
            wide = nearest_copies(words, want, max(0, whole - 1), min(whole + 2, most))
            copies = min(copies, wide, key=lambda c: abs(_words(words, c) - want))
        share.filled = [(size, order, c) for (size, order, _), c in zip(found, copies, strict=True)]
        share.bound = found[-1][:2]
        share.missing = want - _words(words, copies)


def _words(words: list[int], copies: list[int]) -> int:
    return sum(w * c for w, c in zip(words, copies, strict=True))


def nearest_copies(words: list[int], want: int, low: int, high: int) -> list[int]:
    """How often to take each of some numbers, from ``low`` to ``high`` times, so that the sum comes as near to ``want`` as can be.

    A subset sum over a bit set of reachable sums, in units that keep it below
    some 4 million bits (beyond, the result is near by that unit).
    """
    want -= low * sum(words)
    if want <= 0 or high <= low:
        return [low] * len(words)
    unit = max(1, want >> 22)
    steps = [k for k in range(len(words)) for _ in range(high - low)]
    sizes = [round(words[k] / unit) for k in steps]
    aim = round(want / unit)
    mask = (1 << aim + max(sizes) + 1) - 1
    reached = [1]
    for size in sizes:
        reached.append((reached[-1] | reached[-1] << size) & mask)
    last = reached[-1]
    below = (last & ((1 << aim + 1) - 1)).bit_length() - 1
    above = last >> aim
    at = below if not above or aim - below <= (over := (above & -above).bit_length() - 1) else aim + over
    copies = [low] * len(words)
    for k in range(len(steps) - 1, -1, -1):
        if not reached[k] >> at & 1:
            copies[steps[k]] += 1
            at -= sizes[k]
    return copies


def mixed_report(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """The columns of op7: one source per document."""
    mix = Mix(docs, key, F.array(F.col(source)), n_words(F.col(text)))
    facts = docs.sparkSession.createDataFrame(mix.sources, "source_name string, source_size long, target double")
    named = mix.taken().withColumn("source_name", F.from_json("mix_pattern", "array<string>")[0])
    return named.join(F.broadcast(facts), named["source_name"].eqNullSafe(facts["source_name"])).select(
        key, F.col("mix_size").alias("size"), "source_size", "target", (F.col("mix_size") * F.col("copies")).alias("taken")
    )


def op7(spark, sf_dir: str) -> DataFrame:
    return mixed_report(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "source", "text")
