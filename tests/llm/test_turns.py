"""Conversation repair against exhaustive search and a plain dynamic program."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from siltstone.llm import turns

COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}


def outcome(symbols, audit):
    """(cost, roles) of a sequence of edits, or None if it can't be applied."""
    cost, at, roles = 0, 0, ""
    for edit in audit:
        cost += COSTS[edit]
        if edit != "I":
            if at == len(symbols):
                return None
            symbol, at = symbols[at], at + 1
            if edit == "D":
                continue
            if symbol == "-":
                return None
            cost += symbol.isupper()
            if edit == "K":
                roles += symbol.lower()
                continue
        roles += "u" if roles in ("", "s") or roles[-1] == "a" else "a"
    return (cost, roles) if at == len(symbols) and re.fullmatch("(s?(ua)+)?", roles) else None


def exhaustive(symbols):
    found = [(outcome(symbols, a)[0], "".join(a)) for n in range(len(symbols) + 4) for a in itertools.product("DIKR", repeat=n) if outcome(symbols, a)]
    return min(found)


def plain(symbols):
    """Cheapest (cost, edits) by a table over rows and states."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    keeps = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(live):
        for _ in range(4):
            for state, (cost, audit) in list(live.items()):
                live[follow[state]] = min(live.get(follow[state], (1 << 60, "")), (cost + 2, audit + "I"))
        return live

    live = inserted({"": (0, "")})
    for symbol in symbols:
        after = {}

        def reach(state, cost, audit, after=after):
            after[state] = min(after.get(state, (1 << 60, "")), (cost, audit))

        for state, (cost, audit) in live.items():
            reach(state, cost + 3, audit + "D")
            if symbol != "-":
                reach(follow[state], cost + 2 + symbol.isupper(), audit + "R")
                if (state, symbol.lower()) in keeps:
                    reach(keeps[state, symbol.lower()], cost + symbol.isupper(), audit + "K")
        live = inserted(after)
    return min(live[s] for s in ("", "a") if s in live)


def whole(symbols, segment):
    """The edits of a conversation that is searched in segments."""
    own = turns._Conversation(segment)
    edits = []
    for k, symbol in enumerate(symbols):
        role = {"s": "system", "u": "user", "a": "assistant", "x": "tool", "-": "user"}[symbol.lower()]
        edits += [e for e, *_ in own.add(k, role, f"text {k}" + ("" if symbol.isupper() else "."), symbol == "-", symbol.isupper(), False)]
    edits += [e for e, *_ in own.end()]
    return next(iter(own.live.values()))[0], "".join(edits), own


def test_search_equals_exhaustive_search():
    for n in range(4):
        for symbols in itertools.product("suax-UA", repeat=n):
            symbols = "".join(symbols)
            assert next(iter(turns.search(symbols, {turns.NOTHING: (0, "")}, True).values())) == exhaustive(symbols) == plain(symbols)


@pytest.mark.parametrize("segment", [1, 3, 512])
def test_long_conversations_equal_a_plain_table(segment):
    rng = random.Random(segment)
    for _ in range(300):
        symbols = "".join(rng.choices("suaxSUAX-", (1, 9, 9, 1, 1, 2, 2, 1, 3), k=rng.randint(0, 40)))
        assert whole(symbols, segment)[:2] == plain(symbols)


def test_memory_of_a_long_conversation_stays_small():
    own = turns._Conversation(64)
    for k in range(20_000):
        for _ in own.add(k, ("user", "assistant")[k % 2], f"{k}.", False, False, False):
            pass
        assert len(own.rows) <= 130 and all(len(a) <= 130 for _, a in own.live.values())


def brute(rows):
    """op11's row of one conversation from its undamaged rows, in plain Python."""
    after = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        after += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, symbols, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in after:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        symbols += "-" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(after))
    turns_ = [t for t, *_ in after if t is not None]
    cost, audit = plain(symbols)
    lines, at, roles = [], 0, ""
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        role, text = (None, "") if edit == "I" else after[at][1:]
        at += edit != "I"
        if edit != "K":
            role = "user" if roles in ("", "s") or roles[-1] == "a" else "assistant"
        roles += role[0]
        lines.append(f"{role}:{text}")
    gaps = max(turns_) - min(turns_) + 1 - len(set(turns_)) if turns_ else 0
    return (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def compare(df, rows, key="conv_id"):
    got = {r[key]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in df.collect()}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    assert got == {k: brute(v) for k, v in by.items()}


def test_op11_equals_plain_python(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    compare(turns.op11(spark, sf_dir), rows)


def odd_rows():
    rng = random.Random(5)
    rows = [(None, None, None, None), (None, 3, "user", "x"), (7, None, "user", None), (8, 5, None, "Hi."), (8, 5, None, "Hi."), (9, 2, "", "é "), (9, 1, "system", ". \t\x0b"), (10, 0, "user", "long " * 100_000)]
    for conv in range(20, 60):
        for k in range(rng.randint(1, 30)):
            rows.append((conv, rng.choice((None, k, k, k + 5)), rng.choice(("user", "assistant", "system", "tool", "Über", None)), rng.choice(("One.", "Two?", "cut", " ", "", None, f"own {k}!"))))
    return rows


@pytest.mark.parametrize(("segment", "large"), [(512, 100_000), (2, 3)])
def test_odd_conversations(spark, segment, large):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn int, role string, text string, key int, kept string")
    report = turns.repair_report(turns.damaged(df), "conv_id", kept="kept", segment=segment, large=large)
    assert report.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    compare(report, rows)


def test_turns_are_what_the_report_digests(spark):
    df = spark.createDataFrame([(str(r[0]), *r[1:]) for r in odd_rows()], "own string, turn int, role string, text string")
    report = {r["own"]: r for r in turns.repair_report(df, "own").collect()}
    by = {}
    for r in turns.repaired_turns(df, "own").orderBy("own", "step").collect():
        by.setdefault(r["own"], []).append(r)
    for key, r in report.items():
        edits = by.get(key, [])
        assert r["audit"] == "".join(e["edit"] for e in edits) and [e["step"] for e in edits] == list(range(len(edits)))
        text = "\n".join(f"{e['role']}:{e['text']}" for e in edits if e["edit"] != "D")
        assert r["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert re.fullmatch("(s?(ua)+)?", "".join(e["role"][0] for e in edits if e["role"] is not None))


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert turns.repair_report(turns.damaged(df), "conv_id", kept="kept").count() == 0 and turns.repaired_turns(df, "conv_id").count() == 0
