"""The pipeline and the registered queries against plain versions."""

import collections

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from siltstone.llm import mixing, pieces, quality
from siltstone.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.test_free import plain_components
from tests.llm.test_native import base_spans
from tests.test_entry import same


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    same(spark, sf_dir, QUERIES[name], ORACLE_SQL[name])


def test_all_queries_are_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def redacted(text):
    """Base kinds only: the test documents hold no others."""
    out, at = "", 0
    for s in base_spans(text):
        _, a, b = s.split(":")
        if int(a) >= at:
            out += text[at : int(a)] + "[secret]"
        at = max(at, int(b))
    return out + text[at:]


def test_pipeline_stage_by_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = docs.columns
    stages = [f for _, f in corpus_pipeline.STAGES]

    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = stages[0](spark, docs, sf_dir)
    assert kept.columns == names
    want = {k for k, t in texts.items() if quality.measure(t, model)[7]}
    assert {r["doc_id"] for r in kept.collect()} == want

    single = stages[1](spark, kept, sf_dir)
    groups = plain_components({k: texts[k] for k in want})
    want = {k for k in want if groups[k][1] == k}
    assert single.columns == names and sorted(r["doc_id"] for r in single.collect()) == sorted(want)

    clean = stages[2](spark, single, sf_dir)
    got = {r["doc_id"]: r for r in clean.collect()}
    assert clean.columns == names and {k: r["text"] for k, r in got.items()} == {k: redacted(texts[k]) for k in want}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())

    mixed = stages[3](spark, clean, sf_dir)
    copies = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == names and set(copies) <= want and max(copies.values()) <= 3
    size = {k: len(r["text"].encode().split()) for k, r in got.items()}
    sources = collections.Counter()
    for k, r in got.items():
        sources[r["source"]] += size[k]
    order = mixing.source_order(sources)
    targets = mixing.water_fill(sum(sources.values()), mixing.cycled_weights(order), {s: 3 * sources[s] for s in order})
    taken = collections.Counter()
    for k, n in copies.items():
        taken[got[k]["source"]] += n * size[k]
    largest = max(size.values())
    assert all(abs(taken[s] - targets[s]) <= largest / 2 for s in order)

    codec = pieces.Codec(pieces.read_pieces(pieces.default_model()))
    tokens = stages[4](spark, mixed, sf_dir).collect()
    assert len(tokens) == sum(copies.values())
    assert all(r["ids"] == codec.encode(got[r["doc_id"]]["text"]) for r in tokens)

    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, tokens))


def test_pipeline_on_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
