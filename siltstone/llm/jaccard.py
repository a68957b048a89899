"""Exact similarity join of documents on word shingles, with prefix filters and tries.

A document's set is its distinct shingles, hashed to 64 bits. Two documents can
only reach the threshold if the prefixes of their sets share a shingle, in any
global order of shingles; the order here puts frequent shingles last, so that
passages which many documents share don't bring them together. Prefixes hold
more than one shingle of a similar pair, so a pair must also share so many of
them (``least_shared``) before its texts are read.

Candidates are verified in units of bounded size by a prefix-tree join: one side
of a unit is a trie of sets in the global order, which is walked once for all
sets of the other side; common paths share their overlaps, and a subtree is left
when the remaining lengths cannot reach the threshold with any of them.

Shingles of few documents (groups of HEAVY at most) are dealt to buckets in packed
form. Frequent ones are rows: their groups are only aggregated and joined by
Spark, and cut in blocks, so no task holds a whole group.

Components need no link inside of what is already one component. A first round
verifies each document against the leader of every group that it is in, the one
with the smallest share of rare shingles, which is nearest to what a group of
near copies has in common. The last round takes what the first one left apart:
pairs of small groups, and pairs of blocks of large ones, where a unit returns
a spanning forest of its links only. ``jaccard_links`` runs the last round alone
and returns every link between different texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_table, input_bytes, stage_table
from . import packed
from .filters import BitFilter

SHINGLE, PERCENT = 5, 80
HEAVY, MOST_HEAVY = 32, 1 << 20  # documents that make a shingle frequent; how many of these the order knows at most
TOKEN_BITS = 48
LEADER_BLOCK, GROUP_BLOCK = 256, 512  # members of a leader, and documents of a large group, in one unit
STEP = 64  # shingles of a path between two nodes
HELD = 1 << 25  # bytes of a unit's table of shingles by sets


def shingles(text: str | None, hasher: packed.WordHasher, n: int = SHINGLE) -> tuple[np.ndarray, list[bytes]]:
    """The sorted set of a text, and its words. bytes.lower and bytes.split know ASCII only, as the contract asks."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64), words
    hashed = hasher(words)
    return np.unique(packed.ngrams(hashed, min(n, len(words)))), words


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def least_overlap(total: int, percent: int) -> int:
    """Shingles that two sets with so many in all must share."""
    return -(-percent * total // (100 + percent))


class Plan:
    """Sizes that follow the input: bits of a counted shingle, and buckets of about 8 MB of text in a bounded number of partitions."""

    def __init__(self, docs: DataFrame):
        size = max(1, input_bytes(docs))
        self.bits = min(56, max(30, math.ceil(math.log2(size)) + 6))
        self.buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // (8 << 20))
        self.partitions = min(self.buckets, packed.MOST_PARTITIONS)


def frequent_shingles(docs: DataFrame, plan: Plan) -> tuple[np.ndarray, bool]:
    """Counted shingles (upper bits) of at least HEAVY documents: all, or the most frequent ones up to MOST_HEAVY; and whether these are all.

    Every shingle of every document is counted. The result is bounded, so it may
    be gathered and broadcast; leaving some out changes only how many candidates
    there are, not the links.
    """
    bits, partitions = plan.bits, plan.partitions

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = packed.WordHasher()
        down = np.uint64(64 - bits)
        texts = ((shingles(t, hasher)[0] >> down,) for b in packed.in_slices(batches) for t in b.column(0).to_pylist())
        for part in packed.flushed(texts, lambda r: len(r[0]), 2 << 20):
            values, counts = np.unique(np.concatenate([r[0] for r in part]), return_counts=True)
            rows = [(b, packed.pack(values[lo:hi], True), packed.pack(counts[lo:hi])) for b, lo, hi in packed.by_bucket(values, bits, partitions)]
            if rows:
                yield _batch(rows, ("bucket", pa.int64()), ("vals", pa.binary()), ("cnts", pa.binary()))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in packed.groups(batches):
            values = np.concatenate([packed.unpack(r[1], True) for r in rows])
            counts = np.concatenate([packed.unpack(r[2]) for r in rows])
            order = np.argsort(values, kind="stable")
            values, counts = values[order], counts[order]
            first = np.flatnonzero(np.diff(values, prepend=~values[:1]))
            sums = np.add.reduceat(counts, first)
            often = sums >= HEAVY
            values, levels = values[first][often], (np.log2(sums[often].astype(float)) * 4).astype(np.int64)
            out = [(int(k), int((levels == k).sum()), packed.pack(values[levels == k], True)) for k in np.unique(levels)]
            if out:
                yield _batch(out, ("level", pa.int64()), ("n", pa.int64()), ("vals", pa.binary()))

    counted = docs.select("text").mapInArrow(count, "bucket long, vals binary, cnts binary")
    heavy = stage_table(packed.by_range(counted, bits, partitions, plan.buckets, add, "level long, n long, vals binary"))
    least, total, whole = None, 0, True
    for level, n in sorted(((r["level"], r["n"]) for r in heavy.groupBy("level").agg(F.sum("n").alias("n")).collect()), reverse=True):
        total += n
        if total > MOST_HEAVY:
            whole = False
            break
        least = level
    if least is None:
        return np.zeros(0, np.uint64), whole
    known = heavy.where(F.col("level") >= least).select("vals").collect()
    drop_table(heavy)
    return np.sort(np.concatenate([packed.unpack(r["vals"], True) for r in known])), whole


def _batch(rows: list[tuple], *columns: tuple[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), columns, strict=True)], names=[n for n, _ in columns])


def in_order(own: np.ndarray, frequent: np.ndarray, bits: int) -> np.ndarray:
    """A set in the global order: as numbers whose upper bit marks the frequent shingles."""
    upper = own >> np.uint64(64 - bits)
    often = np.zeros(len(own), bool)
    if len(frequent):
        often = frequent[np.minimum(np.searchsorted(frequent, upper), len(frequent) - 1)] == upper
    return np.sort((own >> np.uint64(1)) | (often.astype(np.uint64) << np.uint64(63)))


def digest(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def describe(docs: DataFrame, heavy, plan: Plan, percent: int) -> DataFrame:
    """doc, sig (digest of the word sequence), n (set size), share (of rare shingles, of 255), and the prefix in the global order.

    prefix: its rare shingles, packed; often: its frequent ones. Shingles are
    mixed to TOKEN_BITS here, so that prefixes, which start with the smallest
    numbers, spread over all buckets.
    """
    bits, down = plan.bits, np.uint64(64 - TOKEN_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, frequent = packed.WordHasher(), heavy.value
        for batch in packed.in_slices(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own, words = shingles(text, hasher)
                n, share, prefix, often = len(own), 0, b"", []
                if n:
                    ordered = in_order(own, frequent, bits)
                    rare = int(np.searchsorted(ordered, np.uint64(1 << 63)))
                    share = 255 * rare // n
                    tokens = packed.mixed(ordered[: prefix_length(n, percent)]) >> down
                    prefix, often = packed.pack(tokens[:rare]), tokens[rare:].tolist()
                rows.append((doc, digest(words), n, share, prefix, often))
            yield _batch(rows, *columns)

    columns = (("doc", pa.int64()), ("sig", pa.binary()), ("n", pa.int32()), ("share", pa.int32()), ("prefix", pa.binary()), ("often", pa.list_(pa.int64())))
    return docs.select("doc", "text").mapInArrow(run, "doc long, sig binary, n int, share int, prefix binary, often array<bigint>")


PAIRS = "kind int, a long, b long, na int, nb int, c int, fit int, h int"


def _pairs_batch(kind: int, *columns: np.ndarray) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), *[pa.int32()] * 5)
    arrays = [pa.array(np.asarray(c).astype(t.to_pandas_dtype()), t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), kind), pa.int32()), *arrays], names=["kind", "a", "b", "na", "nb", "c", "fit", "h"])


def _fits(na, nb, ia, ib, percent: int):
    """Length filter, and position filter: what is left after the shared shingle must reach the least overlap. Arrays or columns."""
    least = np.minimum if isinstance(na, np.ndarray) else F.least
    need = least_overlap(na + nb, percent) if isinstance(na, np.ndarray) else F.ceil(percent * (na + nb) / (100 + percent))
    return (na * 100 >= nb * percent) & (nb * 100 >= na * percent) & (least(na - ia, nb - ib) >= need)


def _counted(a, b, na, nb, fit, h) -> Iterator[pa.RecordBatch]:
    """Rows of pairs, with how often each occurs."""
    if not len(a):
        return
    swap = a > b
    a, b, na, nb = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    begin = np.flatnonzero((np.diff(a, prepend=~a[:1]) != 0) | (np.diff(b, prepend=~b[:1]) != 0))
    at = order[begin]
    yield _pairs_batch(0, a[begin], b[begin], na[at], nb[at], np.diff(begin, append=len(a)), np.maximum.reduceat(fit[order], begin), h[at])


def rare_groups(classes: DataFrame, plan: Plan, percent: int) -> DataFrame:
    """Of every rare prefix shingle that more than one class has: kind 0, the pairs with its leader; kind 1, all its classes.

    classes: cid, n, share, h, prefix. Kind 1 has the shingle in a, the class in
    b, its size in na, the place in its set in nb, and h.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def documents():
            for b in batches:
                for *own, prefix in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    yield own, packed.unpack(prefix)

        for part in packed.flushed(documents(), lambda r: len(r[1]), 1 << 20):
            sizes = [len(r[1]) for r in part]
            tokens = np.concatenate([r[1] for r in part])
            order = np.argsort(tokens, kind="stable")
            tokens = tokens[order]
            spread = [np.repeat(np.array([r[0][k] for r in part], np.int64), sizes)[order].view(np.uint64) for k in range(4)]
            places = np.concatenate([np.arange(s, dtype=np.uint64) for s in sizes])[order]
            rows = [
                (b, packed.pack(tokens[lo:hi], True), *(packed.pack(x[lo:hi]) for x in (*spread, places)))
                for b, lo, hi in packed.by_bucket(tokens, TOKEN_BITS, plan.partitions)
            ]
            if rows:
                yield _batch(rows, ("bucket", pa.int64()), *((c, pa.binary()) for c in ("tok", "cid", "n", "share", "h", "at")))

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in packed.groups(batches):
            tok = np.concatenate([packed.unpack(r[1], True) for r in rows]).view(np.int64)
            cid, n, share, h, at = (np.concatenate([packed.unpack(r[k]) for r in rows]).view(np.int64) for k in range(2, 7))
            order = np.argsort(tok, kind="stable")
            same = np.diff(tok[order]) == 0
            order = order[np.append(same, False) | np.append(False, same)]
            if not len(order):
                continue
            tok, cid, n, share, h, at = (x[order] for x in (tok, cid, n, share, h, at))
            yield _pairs_batch(1, tok, cid, n, at, h, np.zeros(len(tok)), h)
            order = np.lexsort((cid, share, tok))
            begin = np.flatnonzero(np.diff(tok[order], prepend=~tok[order[:1]]))
            lead = np.repeat(order[begin], np.diff(begin, append=len(order)))
            lead, order = lead[cid[lead] != cid[order]], order[cid[lead] != cid[order]]
            fit = _fits(n[lead], n[order], at[lead], at[order], percent).astype(np.int64)
            yield from _counted(cid[lead], cid[order], n[lead], n[order], fit, h[order])

    own = classes.select("cid", "n", "share", "h", "prefix").where("octet_length(prefix) > 0")
    dealt = own.mapInArrow(deal, "bucket long, tok binary, cid binary, n binary, share binary, h binary, at binary")
    return packed.by_range(dealt, TOKEN_BITS, plan.partitions, plan.buckets, group, PAIRS)


def frequent_groups(classes: DataFrame) -> DataFrame:
    """tok, cid, n, share, h, at of every frequent prefix shingle of every class."""
    exploded = classes.where("h > 0").select("cid", "n", "share", "h", "n_rare", F.posexplode("often").alias("place", "tok"))
    return exploded.select("tok", "cid", "n", "share", "h", (F.col("n_rare") + F.col("place")).alias("at"))


def frequent_leaders(often: DataFrame, percent: int) -> DataFrame:
    """The pairs of every class with the leaders of its frequent shingles."""
    # written, so that adaptive execution may split a hot shingle's side of the join
    lead = stage_table(often.groupBy("tok").agg(F.min(F.struct("share", "cid", "n", "at")).alias("l"), F.count("*").alias("m")).where("m > 1"))
    pairs = often.join(lead, "tok").where("cid <> l.cid")
    fit = _fits(F.col("n"), F.col("l.n"), F.col("at"), F.col("l.at"), percent).cast("int")
    swap = F.col("cid") > F.col("l.cid")
    own, other = F.struct("cid", "n"), F.struct(F.col("l.cid").alias("cid"), F.col("l.n").alias("n"))
    ends = pairs.select(F.when(swap, other).otherwise(own).alias("x"), F.when(swap, own).otherwise(other).alias("y"), fit.alias("fit"))
    return ends.select(F.lit(0).alias("kind"), F.col("x.cid").alias("a"), F.col("y.cid").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb"), F.lit(1).alias("c"), "fit", F.lit(0).alias("h"))


def with_partners(often: DataFrame, percent: int) -> DataFrame:
    """The rows of a large group that may have a partner there, by the length and position filters.

    often: tok, cid, n, at, comp. Rows are compared with what groups have in
    bands of length: the most that is left after the shingle, the shortest set,
    and the components. A partner is at most two bands away.
    """
    band = F.floor(F.log("n") / math.log(100 / percent) * 1.96).alias("band")
    rows = often.select("tok", "cid", "n", "share", (F.col("n") - F.col("at")).alias("left"), "comp", band)
    told = rows.groupBy("tok", "band").agg(F.max("left").alias("left"), F.min("n").alias("n"), F.min("comp").alias("x"), F.max("comp").alias("y"))
    near = told.select("tok", F.explode(F.sequence(F.col("band") - 2, F.col("band") + 2)).alias("band"), F.struct("left", "n", "x", "y").alias("s"))
    near = stage_table(near.groupBy("tok", "band").agg(F.collect_list("s").alias("near")))

    def fits(s: Column) -> Column:
        shortest = F.greatest(s["n"], F.ceil(percent * F.col("n") / 100))
        need = F.ceil(percent * (F.col("n") + shortest) / (100 + percent))
        return ((s["x"] != F.col("comp")) | (s["y"] != F.col("comp"))) & (F.least("left", s["left"]) >= need)

    return rows.join(near, ["tok", "band"]).where(F.exists("near", fits)).select("tok", "cid", "share")


def merged_groups(rows: DataFrame) -> DataFrame:
    """(grp, cid): the groups tok of the rows, those with the same leader as one.

    Groups of what many near copies have in common hold about the same classes,
    and mostly the same leader, so each class is verified in few groups instead
    of one for each shingle. Any pair of one group stays in one.
    """
    lead = stage_table(rows.groupBy("tok").agg(F.min(F.struct("share", "cid"))["cid"].alias("grp")))
    return rows.join(lead, "tok").select("grp", "cid").distinct()


def least_shared(na: Column, nb: Column, percent: int) -> Column:
    """Prefix shingles that a similar pair must share: beyond the prefix that ends first, there are too few left for the overlap."""
    need = F.ceil(percent * (na + nb) / (100 + percent))
    rest = lambda n: F.ceil(percent * n / 100) - 1
    return need - F.greatest(rest(na), rest(nb))


def candidates(found: DataFrame, percent: int, unseen: Column) -> DataFrame:
    """(a, b) of the pairs that may reach the threshold. unseen: prefix shingles that a pair may share beside the counted ones."""
    pairs = found.where("kind = 0").groupBy("a", "b").agg(F.sum("c").alias("c"), F.max("fit").alias("fit"), *(F.max(x).alias(x) for x in ("na", "nb", "h")))
    return pairs.where((F.col("fit") > 0) & (F.col("c") + unseen >= least_shared(F.col("na"), F.col("nb"), percent))).select("a", "b")


def rare_pairs(live: DataFrame, plan: Plan, percent: int) -> DataFrame:
    """Kind 0: pairs of different components in groups of HEAVY classes at most; kind 1: the classes of larger groups.

    live: tok, cid, n, at, h, comp. Kind 1 has the shingle in a, the class in b, and the group's size in c.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def joined(last: bool) -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            tok = columns[0]
            cut = len(tok) if last else int(np.searchsorted(tok, tok[-1]))  # the last group may go on
            held[:] = [[c[cut:] for c in columns]]
            tok, cid, n, at, h, comp = (c[:cut] for c in columns)
            if not cut:
                return
            begin = np.flatnonzero(np.diff(tok, prepend=~tok[:1]))
            size = np.diff(begin, append=cut)
            apart = np.minimum.reduceat(comp, begin) != np.maximum.reduceat(comp, begin)
            large = np.flatnonzero(np.repeat(apart & (size > HEAVY), size))
            if len(large):
                yield _pairs_batch(1, tok[large], cid[large], n[large], at[large], np.repeat(size, size)[large], np.zeros(len(large)), h[large])
            rows = np.flatnonzero(np.repeat(apart & (size <= HEAVY), size))
            tok, cid, n, at, h, comp = (x[rows] for x in (tok, cid, n, at, h, comp))
            ends = []
            for by in range(1, HEAVY):  # rows of a group stand together: pairs at every distance
                a = np.flatnonzero((tok[by:] == tok[:-by]) & (comp[by:] != comp[:-by]))
                if len(tok) <= by or not (tok[by:] == tok[:-by]).any():
                    break
                ends.append((a, a + by))
            if ends:
                a, b = (np.concatenate(x) for x in zip(*ends, strict=True))
                fit = _fits(n[a], n[b], at[a], at[b], percent).astype(np.int64)
                yield from _counted(cid[a], cid[b], n[a], n[b], fit, np.minimum(h[a], h[b]))

        for batch in batches:
            held.append([c.to_numpy() for c in batch.columns[1:]])
            if sum(len(x[0]) for x in held) >= 1 << 18:
                yield from joined(False)
        if held:
            yield from joined(True)

    bucket = F.shiftright(F.col("tok") * plan.partitions, TOKEN_BITS).alias("bucket")
    rows = live.select(bucket, "tok", "cid", *(F.col(c).cast("bigint") for c in ("n", "at", "h")), "comp")
    return packed.dealt(rows, plan.partitions).sortWithinPartitions("tok").mapInArrow(run, PAIRS)


def trie_join(probes: list[np.ndarray], members: list[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(m, ps): member m reaches the threshold with the probes ps. All sets sorted in the same order, none empty.

    The members in lexicographic order are the leaves of a trie in the order of
    a traversal; ``grown`` holds the overlaps of all probes with the beginnings of
    the current path. A member takes over the part of the path that it shares
    with the one before. Where no probe can reach the threshold with
    the longest set below a node, the whole subtree is left.
    """
    vocabulary, inverse = np.unique(np.concatenate(probes), return_inverse=True)
    sizes = np.array([len(p) for p in probes], np.int64)
    held = np.zeros((len(vocabulary) + 1, len(probes)), np.uint8)  # the last row: shingles that no probe has
    held[inverse, np.repeat(np.arange(len(probes)), sizes)] = 1
    order = sorted(range(len(members)), key=lambda m: members[m].astype(">u8").tobytes())
    lengths = np.array([len(members[m]) for m in order])
    shared = np.zeros(len(order) + 1, np.int64)  # with the member before
    for k in range(1, len(order)):
        a, b = members[order[k - 1]], members[order[k]]
        same = a[: len(b)] == b[: len(a)]
        shared[k] = len(same) if same.all() else int(np.argmin(same))
    # overlaps at every STEP-th node of the path; a path that leaves the one before inside of a step takes the step anew
    grown = np.zeros((int(lengths.max(initial=0)) // STEP + 2, len(probes)), np.int32)
    k, done = 0, 0
    while k < len(order):
        own = members[order[k]]
        at = np.searchsorted(vocabulary, own)
        rows = np.where(vocabulary[np.minimum(at, len(vocabulary) - 1)] == own, at, len(vocabulary))
        n, step = len(own), min(int(shared[k]), done) // STEP
        depth, following = step * STEP, k + 1
        while depth < n:
            part = rows[depth : depth + STEP]
            step += 1
            depth += len(part)
            np.add(grown[step - 1], held[part].sum(axis=0, dtype=np.int32), out=grown[step])
            if (grown[step] + (n - depth) >= least_overlap(sizes + n, percent)).any():
                continue
            end = k + 1  # of the subtree below this node
            while end < len(order) and shared[end] >= depth:
                end += 1
            longest = int(lengths[k:end].max())
            if not (grown[step] + (longest - depth) >= least_overlap(sizes + longest, percent)).any():
                following = end
            break
        if depth == n:
            hits = np.flatnonzero(grown[step] >= least_overlap(sizes + n, percent))
            if len(hits):
                yield order[k], hits
        # the path stays valid for the next member as far as it is shared with all between
        done = depth if following == k + 1 else min(depth, int(shared[k + 1 : following + 1].min()))
        k = following


def unit_links(ids: np.ndarray, comps: np.ndarray, sets: list[np.ndarray], roles: np.ndarray, percent: int, forest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links between classes of different components in a unit: of role 0 with role 1, or of role 2 with each other.

    forest: only as many as connect what they connect, one less than classes at most.
    """
    left, right = np.flatnonzero(roles != 1), np.flatnonzero(roles != 0)
    found: list[tuple[int, int]] = []
    _, label = np.unique(comps, return_inverse=True)
    room = 1
    begin = 0
    while begin < len(left):
        words, end = 0, begin
        while end < len(left) and (end == begin or (words + len(sets[left[end]])) * (end - begin + 1) <= HELD):
            words += len(sets[left[end]])
            end += 1
        probes = left[begin:end]
        for m, hits in trie_join([sets[p] for p in probes], [sets[m] for m in right], percent):
            y = right[m]
            xs = probes[hits]
            xs = xs[label[xs] != label[y]]
            if not forest:
                found += [(x, y) for x in xs.tolist() if ids[x] < ids[y] or roles[x] == 0]
                continue
            while len(xs):
                found.append((int(xs[0]), int(y)))
                label[label == label[xs[0]]] = label[y]
                xs = xs[label[xs] != label[y]]
        begin = end
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return ids[pairs[:, 0]], ids[pairs[:, 1]]


def leader_units(pairs: DataFrame) -> DataFrame:
    """Units of pairs (a, b): the members of every a, in parts of about LEADER_BLOCK."""
    sized = pairs.join(stage_table(pairs.groupBy("a").agg(F.count("*").alias("m"))), "a")
    part = sized.select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("m") / LEADER_BLOCK)).cast("int").alias("u1"))
    leaders = part.select("a", "u1").distinct().select(F.col("a").alias("u0"), "u1", F.lit(-1).alias("u2"), F.lit(0).alias("role"), F.col("a").alias("cid"))
    return leaders.unionByName(part.select(F.col("a").alias("u0"), "u1", F.lit(-1).alias("u2"), F.lit(1).alias("role"), F.col("b").alias("cid")))


def block_units(members: DataFrame) -> DataFrame:
    """Units of large groups (grp, cid, m): every pair of blocks of about GROUP_BLOCK classes, and every block with itself."""
    blocks = F.ceil(F.col("m") / GROUP_BLOCK).cast("int")
    rows = members.select("grp", "cid", blocks.alias("k"), F.pmod(F.xxhash64("cid"), blocks).cast("int").alias("own"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    role = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return rows.select(F.col("grp").alias("u0"), F.least("own", "other").alias("u1"), F.greatest("own", "other").alias("u2"), role.alias("role"), "cid")


def verify(docs: DataFrame, units: DataFrame, classes: DataFrame, heavy, plan: Plan, percent: int, forest: bool = True) -> DataFrame:
    """Links (a, b) of the units. units: u0, u1, u2, role, cid; classes: cid, doc, sig, comp."""
    asked = units.join(classes.select("cid", "doc", "sig", "comp"), "cid")
    texts = BitFilter(asked.select("doc"), "doc").mark(docs.select("doc", "text"), "doc").where("maybe")
    rows = texts.join(asked, "doc").select("u0", "u1", "u2", "role", "cid", "comp", "sig", "text")
    bits = plan.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, frequent = packed.WordHasher(), heavy.value
        key, unit = None, {}

        def linked() -> Iterator[pa.RecordBatch]:
            comps = np.array([x[1] for x in unit.values()], np.int64)
            if len(unit) > 1 and (comps != comps[0]).any():
                ids, roles = np.array(list(unit), np.int64), np.array([x[0] for x in unit.values()])
                a, b = unit_links(ids, comps, [x[2] for x in unit.values()], roles, percent, forest)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in packed.in_slices(batches):
            for u0, u1, u2, role, cid, comp, sig, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (u0, u1, u2) != key:
                    yield from linked()
                    key, unit = (u0, u1, u2), {}
                own, words = shingles(text, hasher)
                if digest(words) == sig:  # else another text of the same key
                    unit[cid] = role, comp, in_order(own, frequent, bits)
        yield from linked()

    unit = ("u0", "u1", "u2")
    return rows.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(run, "a long, b long")


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, comp) for every node of the links (a, b): the smallest node that it is connected with.

    With so many rounds only, nodes of one comp are connected, but comps may be
    parts of components.

    Alternating large and small stars; every round is a written table, and only
    its row count and checksum reach the driver.
    """
    edges = stage_table(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = stage_table(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v")))
        edges = stage_table(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.shiftright(F.xxhash64("u", "v"), 16))).first())
        rounds = None if rounds is None else rounds - 1
        if now == state or rounds == 0:
            break
        state = now
    both = edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")))
    return both.groupBy("node").agg(F.min("comp").alias("comp"))


class Classes:
    """Different word sequences of a table, their groups, and the links between them.

    table: cid, sig, doc (the smallest key), n, share, h, n_rare, prefix, often; told: doc, sig, n of every row.
    """

    def __init__(self, docs: DataFrame, key: str, text: str, percent: int):
        self.percent, self.plan = percent, Plan(docs)
        self.rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
        frequent, self.whole = frequent_shingles(self.rows, self.plan)
        self.heavy = docs.sparkSession.sparkContext.broadcast(frequent)
        told = stage_table(describe(self.rows, self.heavy, self.plan, percent))
        self.told = stage_table(told.select("doc", "sig", "n"))
        # copies of a word sequence are one class; min() is pre-aggregated, so a large class is no hot group
        first = F.min(F.struct("doc", "n", "share", "prefix", "often")).alias("c")
        own = told.where("n > 0 AND doc IS NOT NULL").groupBy("sig").agg(first).select("sig", "c.*")
        length = F.col("n") - F.ceil(percent * F.col("n") / 100).cast("int") + 1
        own = own.withColumn("h", F.size("often")).withColumn("n_rare", length - F.col("h")).withColumn("cid", F.monotonically_increasing_id())
        self.table = stage_table(own)
        drop_table(told)
        self.often = frequent_groups(self.table)
        self.rare = stage_table(rare_groups(self.table, self.plan, percent))

    def _named(self, comps: DataFrame | None) -> DataFrame:
        named = self.table.select("cid", "doc", "sig")
        if comps is None:
            return named.withColumn("comp", F.col("cid"))
        return named.join(comps.withColumnRenamed("node", "cid"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))

    def leader_links(self) -> DataFrame:
        """Links of classes with the leaders of their groups."""
        pairs = candidates(self.rare.unionByName(frequent_leaders(self.often, self.percent)), self.percent, F.lit(0))
        return stage_table(verify(self.rows, leader_units(stage_table(pairs)), self._named(None), self.heavy, self.plan, self.percent))

    def other_links(self, comps: DataFrame | None, forest: bool) -> DataFrame:
        """Links between classes that are in different components."""
        named = self._named(comps)
        comp = named.select("cid", "comp")
        live = self.rare.where("kind = 1").select(F.col("a").alias("tok"), F.col("b").alias("cid"), F.col("na").alias("n"), F.col("nb").alias("at"), "h")
        rare = stage_table(rare_pairs(live.join(comp, "cid"), self.plan, self.percent))
        # beside the counted shingles, a pair may share those of large groups, which are frequent ones if all of these are known
        pairs = stage_table(candidates(rare, self.percent, F.col("h") if self.whole else F.lit(1 << 30)))
        large = stage_table(merged_groups(stage_table(with_partners(self.often.join(comp, "cid"), self.percent))))
        large = large.join(stage_table(large.groupBy("grp").agg(F.count("*").alias("m"))), "grp")
        # beyond what the order knows, large groups of rare shingles come from their buckets
        unknown = rare.where("kind = 1").select((-1 - F.col("a")).alias("grp"), F.col("b").alias("cid"), F.col("c").cast("bigint").alias("m"))
        units = stage_table(leader_units(pairs).unionByName(block_units(large.unionByName(unknown))))
        return stage_table(verify(self.rows, units, named, self.heavy, self.plan, self.percent, forest))


def jaccard_links(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(a, b), a < b: every link between different word sequences, each under its smallest ``key``.

    With ``jaccard_components``, which tells equal texts, this is the whole join.
    """
    with packed.small_batches(docs.sparkSession):
        own = Classes(docs, key, text, percent)
        links = own.other_links(None, False).select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct()
    names = own.table.select("cid", "doc")
    ends = links.join(names.select(F.col("cid").alias("x"), F.col("doc").alias("p")), "x").join(names.select(F.col("cid").alias("y"), F.col("doc").alias("q")), "y")
    return ends.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))


def class_components(own: Classes) -> DataFrame:
    """(sig, component): the smallest key that the links of every class reach."""
    comps = stage_table(components(own.leader_links(), rounds=1))
    links = own.other_links(comps, True).unionByName(comps.select(F.col("node").alias("a"), F.col("comp").alias("b")))
    comps = stage_table(components(links))
    named = own._named(comps)
    least = named.groupBy("comp").agg(F.min("doc").alias("component"))
    return stage_table(named.join(least, "comp").select("sig", "component"))


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(``key``, n_shingles, component_id), one row per row of ``docs``.

    Documents are linked when 100 * intersection >= ``percent`` * union of their
    shingle sets; component_id is the smallest key that links reach. A null or
    wordless text has an empty set and is linked with nothing; so is a null key.
    Rows that repeat a key count as one document each, with one component for
    equal texts. Shingles are compared by 64-bit hashes, word sequences by 128.
    """
    with packed.small_batches(docs.sparkSession):
        own = Classes(docs, key, text, percent)
        out = own.told.join(class_components(own), "sig", "left")
    component: Column = F.when((F.col("n") > 0) & F.col("doc").isNotNull(), F.col("component")).otherwise(F.col("doc"))
    return out.select(F.col("doc").alias(key), F.col("n").cast("bigint").alias("n_shingles"), component.alias("component_id"))


def one_of_each_component(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row of each component of ``jaccard_components``, with all columns: of those with the smallest key, one with the smallest text.

    Rows are taken apart by their own text, also where they repeat a key. A row
    without words or key is linked with nothing and stays. Documents that are
    alone in their component stay where they are; only the others move.
    """
    place = docs.columns.index(text)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in packed.in_slices(batches):
            words = ((t or "").encode().lower().split() for t in batch.column(0).field(place).to_pylist())
            sigs = pa.array([digest(w) if w else None for w in words], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), sigs], names=["row", "sig"])

    rows = docs.select(F.struct("*").alias("row"))
    shape = T.StructType([*rows.schema.fields, T.StructField("sig", T.BinaryType())])
    with packed.small_batches(docs.sparkSession):
        own = Classes(docs, key, text, percent)
        named = class_components(own).select("sig", "component")
        sizes = own.told.where("n > 0 AND doc IS NOT NULL").groupBy("sig").agg(F.count("*").alias("m")).join(named, "sig")
        shared = stage_table(sizes.withColumn("all", F.sum("m").over(Window.partitionBy("component"))).where("all > 1").select("sig", "component"))
        marked = BitFilter(shared, "sig").mark(rows.mapInArrow(sign, shape), "sig")
        # written, as two parts of the result read it
        moved = stage_table(marked.where("maybe").join(shared, "sig", "left").select("row", "component"))
    here = F.col("row")[key]
    grouped = F.col("component").isNotNull() & here.isNotNull()
    # rows with equal words under the smallest key: the smallest of them, pre-aggregated
    first = moved.where(grouped & (here == F.col("component"))).groupBy("component").agg(F.min_by("row", F.struct(F.col("row")[text], F.to_json("row"))).alias("row"))
    rest = marked.where("NOT maybe").select("row").unionByName(moved.where(~F.coalesce(grouped, F.lit(False))).select("row"))
    return rest.unionByName(first.select("row")).select("row.*")


def op5(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
