"""Spelling variants against SQL and a plain comparison of all words."""

import random
import re
import zlib

import pytest

from siltstone.llm import queries, spelling
from tests.test_entry import same


def test_op12_equals_sql(spark, sf_dir):
    same(spark, sf_dir, queries.QUERIES["op12_spelling_variants"], queries.ORACLE_SQL["op12_spelling_variants"])


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(counts, times):
    out = {}
    for w, n in counts.items():
        near = [(-counts[v], v) for v in counts if one_apart(w, v)]
        best = min(near, default=None)
        form = best[1] if best and -best[0] >= times * n else None
        out[w] = [form, n, len(near), -best[0] if form else None]
    for w, row in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        row.append(root)
    return {w: tuple(r) for w, r in out.items()}


def told(df):
    return {r["word"]: (r["form"], r["n"], r["n_near"], r["form_n"], r["root"]) for r in df.collect()}


@pytest.mark.parametrize("times", [2, 10])
def test_groups_equal_all_comparisons(spark, times):
    rng = random.Random(times)
    words = {"".join(rng.choices("abé", k=rng.randint(1, 7))): rng.choice((1, 2, 2, 9, 20, 100, 2000)) for _ in range(400)}
    words |= {"a" * 30_000: 5, "a" * 30_001: 50, "a" * 15_000 + "b" + "a" * 14_999: 1, "": 3}
    words |= {"chain" + "x" * k: 2 * times**k for k in range(8)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert told(spelling.grouped(df, times)) == plain(words, times)


def test_counts_of_words(spark, odd_documents):
    extra = spark.createDataFrame([(None, "Straßenbahn STRASSENBAHN été-Élégante×÷ÿ abcdefg"), (9, "aaaaaaaa" * 2000 + " " + "Überfällig " * 200)], "doc_id long, text string")
    docs = odd_documents.unionByName(extra, allowMissingColumns=True)
    want = {}
    for r in docs.collect():
        low = re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{run}".encode())
            word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
            if len(word) >= 4:
                want[word] = want.get(word, 0) + 1
    found = spelling.word_counts(docs, "doc_id", least_length=4, least_count=1)
    assert {r["word"]: r["n"] for r in found.collect()} == want


def test_no_words(spark, no_documents):
    assert spelling.grouped(spelling.word_counts(no_documents, "doc_id")).count() == 0
