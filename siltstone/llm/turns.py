"""Repair of the turn structure of conversations: A* on the edit lattice.

A lattice node is (rows read, role written last). Edits are Keep, Rerole, Delete
and Insert, by their initials; the cheapest ones that leave role initials
``(s?(ua)+)?`` are wanted, the ASCII-least where several cost the same. A* is
keyed by (cost + heuristic, edits so far). The heuristic is the suffix sum of
what no repair avoids: deletions of blank and duplicate rows, and one for every
truncated row. It is consistent, so the first visit of a node is the cheapest
one and, among equals, the ASCII-least: edits name their path, so that no edits
of one path to a node begin the edits of another.

Spark sorts the rows of each conversation, and a task streams them. Long
conversations are searched segment by segment from all states that may still
win; what the surviving states agree on is decided and leaves the memory.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import input_bytes, table
from .filters import BitFilter

WHITE = " \t\n\x0b\x0c\r"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {NOTHING: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
LEGAL = frozenset(("su", "ua", "au"))
DELETE, REROLE, INSERT, CUT_OFF = 3, 2, 2, 1
SPREAD = 5  # a state that costs more than another by over this much cannot win: that many edits lead from any state to any other
SEGMENT, SEGMENT_CHARS = 512, 4 << 20  # rows and code points that are searched together
LARGE = 100_000  # rows of a conversation whose duplicates are found by a join, not by a set in memory
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def search(symbols: str, live: dict[int, tuple[int, str]], last: bool) -> dict[int, tuple[int, str]]:
    """(cost, edits) of the states behind the rows, from those before them; with ``last`` only of the cheapest accepted state.

    symbols: s, u, a, or x of each row's role, upper case if it is truncated, or - if it must be deleted.
    """
    n = len(symbols)
    rest = [0] * (n + 1)
    for k in range(n - 1, -1, -1):
        rest[k] = rest[k + 1] + (DELETE if symbols[k] == "-" else CUT_OFF if symbols[k].isupper() else 0)
    heap = [(cost + rest[0], audit, 0, state) for state, (cost, audit) in live.items()]
    heapify(heap)
    visited: set[tuple[int, int]] = set()
    found: dict[int, tuple[int, str]] = {}
    least = 0
    while heap:
        f, audit, at, state = heappop(heap)
        if (at, state) in visited:
            continue
        visited.add((at, state))
        if at == n and not last:
            if not found:
                least = f
            elif f > least + SPREAD:
                break
            found[state] = f, audit
            continue
        if at == n and state in (NOTHING, ASSISTANT):
            return {state: (f, audit)}
        cost = f - rest[at]
        if at < n:
            symbol, ahead = symbols[at], rest[at + 1]
            heappush(heap, (cost + DELETE + ahead, audit + "D", at + 1, state))
            if symbol != "-":
                kept = cost + ahead + (CUT_OFF if symbol.isupper() else 0)
                follow = KEPT[state].get(symbol.lower())
                if follow is not None:
                    heappush(heap, (kept, audit + "K", at + 1, follow))
                heappush(heap, (kept + REROLE, audit + "R", at + 1, NEXT[state]))
        heappush(heap, (f + INSERT, audit + "I", at, NEXT[state]))
    return found


@lru_cache(1 << 16)
def _short(symbols: str) -> dict[int, tuple[int, str]]:
    return search(symbols, {NOTHING: (0, "")}, True)


class _Conversation:
    """One conversation as its rows come in; edits leave as soon as they are decided."""

    def __init__(self, segment: int):
        self.segment = segment
        self.live, self.state = {NOTHING: (0, "")}, NOTHING
        self.rows: deque[tuple[str, str]] = deque()
        self.symbols, self.chars = [], 0
        self.seen: set[bytes] = set()
        self.before: tuple | None = None
        self.gaps = [None, None, 0]
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}

    def add(self, turn: int | None, role: str, text: str, blank: bool, cut_off: bool, repeats: bool | None) -> Iterator[tuple]:
        """repeats: whether an earlier turn has role and text; None if only this conversation's memory knows."""
        if len(self.symbols) >= self.segment or self.chars >= SEGMENT_CHARS:
            yield from self._searched(False)
        low, high, turns = self.gaps
        if turn is not None and turn != high:
            self.gaps = [turn if low is None else low, turn, turns + 1]
        own = hashlib.md5(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()
        if self.before is not None:
            self.counts["illegal"] += self.before[2][:1] + role[:1] not in LEGAL
            repeats = repeats or self.before[:2] == (own, turn)
        self.before = own, turn, role
        if repeats is None or (repeats is False and self.seen):
            repeats = bool(repeats) or own in self.seen
            self.seen.add(own)
        fault = "blank" if blank else "duplicate" if repeats else "truncated" if cut_off else None
        if fault:
            self.counts[fault] += 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        gone = fault in ("blank", "duplicate")
        self.symbols.append("-" if gone else initial.upper() if fault else initial)
        self.rows.append((role, "" if gone else text))
        self.chars += 0 if gone else len(text)

    def end(self) -> Iterator[tuple]:
        yield from self._searched(True)

    def report(self) -> dict:
        low, high, turns = self.gaps
        return {"gaps": 0 if low is None else high - low + 1 - turns, **self.counts}

    def _searched(self, last: bool) -> Iterator[tuple]:
        symbols = "".join(self.symbols)
        whole = last and len(symbols) <= 64 and self.live == {NOTHING: (0, "")}
        self.live = _short(symbols) if whole else search(symbols, self.live, last)
        self.symbols, self.chars = [], 0
        audits = [a for _, a in self.live.values()]
        low, high = min(audits), max(audits)
        same = next((k for k, (x, y) in enumerate(zip(low, high, strict=False)) if x != y), min(len(low), len(high)))
        self.live = {s: (c, a[same:]) for s, (c, a) in self.live.items()}
        for edit in low[:same]:
            yield self._edit(edit)

    def _edit(self, edit: str) -> tuple:
        role, text = (None, "") if edit == "I" else self.rows.popleft()
        if edit == "D":
            return edit, None, None
        if edit == "K":
            self.state = KEPT[self.state][role[0]]
            return edit, role, text
        self.state = NEXT[self.state]
        return edit, NAMES[self.state], text


def _repairs(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[tuple]:
    """(key, edit, role, text, None) in order, and behind each conversation (key, None, None, None, (report, cost))."""
    key, own = None, None
    for part in (b.slice(k, 64) for b in batches for k in range(0, len(b), 64)):
        for found, kept, *row in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if own is None or found != key:
                if own is not None:
                    yield from _ended(key, own)
                key, own = found, _Conversation(segment)
            if kept:
                yield from ((key, *e, None) for e in own.add(*row))
    if own is not None:
        yield from _ended(key, own)


def _ended(key: object, own: _Conversation) -> Iterator[tuple]:
    yield from ((key, *e, None) for e in own.end())
    yield key, None, None, None, (own.report(), next(iter(own.live.values()))[0])


def _written(rows: Iterator[tuple], schema: pa.Schema, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    part, size = [], 0
    for row in rows:
        part.append(row)
        size += 100 + sum(len(x) for x in row if isinstance(x, str))
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)
            part, size = [], 0
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)


def _turns(batches: Iterator[pa.RecordBatch], segment: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        step = 0
        for key, edit, role, text, ended in _repairs(batches, segment):
            if ended is None:
                yield key, step, edit, role, text
            step = step + 1 if ended is None else 0

    return _written(rows(), pa.schema([("key", kind), ("step", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))


def _reports(batches: Iterator[pa.RecordBatch], segment: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        audit, digest, first = [], hashlib.sha256(), True
        for key, edit, role, text, ended in _repairs(batches, segment):
            if ended is not None:
                report, cost = ended
                yield key, *report.values(), cost, "".join(audit), digest.hexdigest()
                audit, digest, first = [], hashlib.sha256(), True
                continue
            audit.append(edit)
            if role is not None:
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
                first = False

    names = [("key", kind), *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))]
    return _written(rows(), pa.schema([*names, ("audit", pa.string()), ("repaired_sha256", pa.string())]))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after a reproducible damage, and a column ``kept`` that is false for those that it drops.

    By crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2
    removes its full stops, exclamation and question marks, 3 repeats it, 4
    makes its role user. Null roles, texts, and ids and turns in the hashed
    string are one space. Columns: conv_id, turn, role, text, kept.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20).alias("fate")
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), fate)
    fate = F.col("fate")
    text = F.when(fate == 1, "").when(fate == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(fate == 4, "user").otherwise(F.col("role"))
    copies = F.when(fate == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(fate != 0))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("kept"))


def _ordered(turns: DataFrame, key: str, turn: str, role: str, text: str, kept: str | None, large: int) -> tuple[DataFrame, T.DataType]:
    """The rows of each conversation one after another in a task, by turn (nulls first), role and text."""
    end = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    rows = turns.select(F.col(key).alias("key"), (F.coalesce(kept, F.lit(False)) if kept else F.lit(True)).alias("kept"), F.col(turn).cast("long").alias("turn"), _string(role).alias("role"), _string(text).alias("text"))
    rows = rows.select("*", (end == "").alias("blank"), ((end != "") & ~end.isin(".", "!", "?")).alias("cut_off"))
    many = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > large).select("key")
    if many.isEmpty():
        rows = rows.withColumn("repeats", F.lit(None).cast("boolean"))
    else:
        marked = BitFilter(many, "key").mark(rows, "key")
        own = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
        place = F.struct(F.col("turn").isNotNull().alias("some"), F.coalesce("turn", F.lit(0)).alias("turn"))
        some = marked.where("maybe").select("*", own.alias("own"), place.alias("place"))
        first = some.where("kept").groupBy(F.col("key").alias("of"), F.col("own").alias("same")).agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
        told = some.join(first, F.col("key").eqNullSafe(F.col("of")) & (F.col("own") == F.col("same")), "left")
        told = told.select(*rows.columns, F.coalesce(F.col("first") < F.col("place"), F.lit(False)).alias("repeats"))
        rows = marked.where("NOT maybe").select(*rows.columns, F.lit(None).cast("boolean").alias("repeats")).unionByName(told)
    partitions = max(int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")), input_bytes(turns) // (64 << 20))
    order = [F.col("key"), F.col("turn").asc_nulls_first(), "role", "text"]
    return rows.repartition(partitions, "key").sortWithinPartitions(*order), turns.schema[key].dataType


def _string(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def _apply(fn, turns: DataFrame, key: str, turn: str, role: str, text: str, kept: str | None, segment: int, large: int, columns: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    rows, kind = _ordered(turns, key, turn, role, text, kept, large)
    arrow = to_arrow_type(kind)
    schema = T.StructType([T.StructField("key", kind), *T._parse_datatype_string(columns).fields])
    return rows.mapInArrow(lambda batches: fn(batches, segment, arrow), schema).withColumnRenamed("key", key)


def repaired_turns(turns: DataFrame, key: str, turn: str = "turn", role: str = "role", text: str = "text", kept: str | None = None, segment: int = SEGMENT, large: int = LARGE) -> DataFrame:
    """The edits of every conversation in order: ``key``, step (from 0), edit (K, R, D, I), role and text (null for deleted rows).

    Rows are taken by turn (nulls first), then role, then text; other columns,
    whatever their names, are left aside. A blank row (only ASCII white space),
    and one whose role and text stood earlier in the conversation, is deleted;
    one that doesn't end in a full stop, exclamation or question mark is
    truncated, which costs 1 unless it is deleted. ``kept``: a boolean column;
    rows where it isn't true only name their conversation. Null roles and texts
    are one space; all rows with a null key are one conversation; repeated rows
    are duplicates; no rows give no rows.
    """
    return _apply(_turns, turns, key, turn, role, text, kept, segment, large, "step long, edit string, role string, text string")


def repair_report(turns: DataFrame, key: str, turn: str = "turn", role: str = "role", text: str = "text", kept: str | None = None, segment: int = SEGMENT, large: int = LARGE) -> DataFrame:
    """One row per conversation: ``key``, gaps in its turns, faults, neighbours that don't follow each other, the repair's cost, edits and digest.

    audit: the initials of the edits of ``repaired_turns``; repaired_sha256: of
    its ``role:text``, joined by newlines. Rows as there; a conversation of
    which no row is ``kept`` has zeros, no edits and the empty string's digest.
    A digest is made from first to last, so one task reads a conversation; it
    holds a few segments of it, and the edits.
    """
    return _apply(_reports, turns, key, turn, role, text, kept, segment, large, REPORT)


def op11(spark, sf_dir: str) -> DataFrame:
    return repair_report(damaged(table(spark, sf_dir, "conversations")), "conv_id", kept="kept")
