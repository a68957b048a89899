"""Decontamination against SQL and a plain search of all windows."""

import random
import re

import pytest

from siltstone.llm import leaks, queries
from tests.test_entry import same

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_op13_equals_sql(spark, sf_dir):
    same(spark, sf_dir, queries.QUERIES["op13_decontamination"], queries.ORACLE_SQL["op13_decontamination"])


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain(text, items, size):
    """(n_words, n_hit, spans, items) of a text by comparing every window with every place."""
    text = low(text)
    places = [m.span() for m in WORD.finditer(text)]
    words = [text[a:b] for a, b in places]
    hit, names = set(), set()
    for item, t in items:
        own = WORD.findall(low(t))
        for w in {tuple(own[k : k + size]) for k in range(max(1, len(own) - size + 1))} - {()}:
            for k in range(len(words) - len(w) + 1):
                if tuple(words[k : k + len(w)]) == w:
                    hit |= set(range(k, k + len(w)))
                    names.add(item)
    runs = []
    for k in sorted(hit):
        if runs and runs[-1][1] == k:
            runs[-1][1] = k + 1
        else:
            runs.append([k, k + 1])
    return len(words), len(hit), [(places[a][0], places[b - 1][1]) for a, b in runs], sorted(names)



ITEMS = [(1, "One two three, four five six"), (2, "two THREE four five"), (10, "zwölf Äpfel"), (11, "Ä"), (12, "ä"), (3, None), (4, " .-"), (None, "seven eight nine ten"), (2, "a b c d e"), (5, "one two three four")]


def documents():
    rng = random.Random(3)
    pool = ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "zwölf", "Äpfel", "a", "b", "c", "d", "e", "Ä", "ä"]
    texts = [None, "", "  ..\n", "One, two; (THREE) four... five - six", "x" * 50 + " zwölf Äpfel zwölf Äpfel!", "Ä"]
    texts += [" ".join(rng.choice(pool) + rng.choice(("", ",", "  ", "—")) for _ in range(rng.randint(1, 80))) for _ in range(60)]
    texts += [" ".join(rng.choices(pool[:10], k=60_000)), texts[3]]
    return [(k % 50, t, k, "x") for k, t in enumerate(texts)]


@pytest.mark.parametrize("most", [200_000, 4])
@pytest.mark.parametrize("piece", [1 << 20, 40])
def test_contaminated_equals_all_windows(spark, most, piece, monkeypatch):
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long, items string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    if piece == 40:  # in this process: tasks import the module anew
        monkeypatch.setattr(leaks, "PIECE", piece)
        pairs = [tuple(r) for r in leaks.windows(items, "item_id", size=4).collect()]
        own = leaks.Automaton(pairs)
        for _, text, *_ in rows:
            raw = (text or "").encode().translate(leaks.FOLD)
            n, spans, names = own.search(raw)
            found = n, sum(b - a for a, b in spans), [(p["start"], p["end"]) for p in leaks._places(raw, spans)], sorted(names)
            assert found == plain(text, [("" if k is None else str(k), t) for k, t in ITEMS], 4)
        return
    found = leaks.contaminated(docs, "doc_id", items, "item_id", size=4, most=most)
    assert found.columns == ["doc_id", "n_words", "n_hit", "spans", "items"]
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], [tuple(s) for s in r["spans"]], r["items"]) for r in found.collect()), key=repr)
    names = [("" if k is None else str(k), t) for k, t in ITEMS]
    assert got == sorted(((k, *plain(t, names, 4)) for k, t, *_ in rows), key=repr)


def test_empty_tables(spark, no_documents, odd_documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert leaks.contaminated(no_documents, "doc_id", none, "item_id").count() == 0
    found = leaks.contaminated(odd_documents, "doc_id", none, "item_id").collect()
    assert len(found) == odd_documents.count() and not any(r["n_hit"] or r["items"] for r in found)
