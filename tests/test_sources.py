"""Footers as a table, the sink of numbered files, and table functions in SQL."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from siltstone import cli
from siltstone.functions import table_functions
from siltstone.functions.text import split_trace
from siltstone.sources import chunk_files, footers


def test_row_groups(spark, tmp_path):
    for k in range(3):
        data = pa.table({"n": list(range(100 * k, 100 * k + 100)), "s": [f"t{k}"] * 100, "none": pa.array([None] * 100, pa.string())})
        pq.write_table(data, tmp_path / f"p{k}.parquet", row_group_size=30)
    pq.write_table(pa.table({"n": pa.array([], pa.int64())}), tmp_path / "p9.parquet")
    paths = [str(p) for p in sorted(tmp_path.glob("*.parquet"))]
    groups = footers.row_groups(spark, paths, ["n", "s", "none"])
    rows = sorted(groups.where("n_rows > 0").collect())
    assert [(r["path"][-10:], r["row_group"], r["first_row"], r["n_rows"]) for r in rows] == [(f"p{k}.parquet", j, 30 * j, 30 if j < 3 else 10) for k in range(3) for j in range(4)]
    assert rows[5]["bounds"]["n"]["low"] == "130" and rows[5]["bounds"]["s"]["high"] == "t1" and rows[5]["bounds"]["none"]["nulls"] == 30
    kept = groups.where(footers.may_hold("n", 129, 130))
    assert sorted((r["path"][-10:], r["row_group"]) for r in kept.where("n_rows > 0").collect()) == [("p1.parquet", 0), ("p1.parquet", 1)]
    assert groups.where("n_rows > 0").where(footers.may_hold("none", 1)).count() == 12
    assert sorted((r["path"][-10:], r["row_group"]) for r in footers.first_groups(groups.where("n_rows > 0"), 131).collect()) == [*((f"p0.parquet", k) for k in range(4)), ("p1.parquet", 0), ("p1.parquet", 1)]
    (tmp_path / "bad.parquet").write_text("no")
    with pytest.raises(Exception, match="arquet"):
        footers.row_groups(spark, [str(tmp_path / "bad.parquet")]).collect()


def test_a_limit_reads_as_many_shards_as_it_needs(spark, tmp_path, monkeypatch):
    for k in range(5):
        rows = [(f"q{k}-{j}", "" if k == 0 else f"<think>t</think>a{j}") for j in range(4)]
        if k == 0:
            rows = [(" ", "")] * 3 + rows[:1]
        spark.createDataFrame(rows, "instruction string, response string").coalesce(1).write.parquet(str(tmp_path / f"s{k}"))
    read = []
    own = cli.traces.read_shards
    monkeypatch.setattr(cli.traces, "read_shards", lambda spark, *paths: (read.extend(paths), own(spark, *paths))[1])
    out = cli.main(["--root", str(tmp_path), "reasoning", *(str(tmp_path / f"s{k}") for k in range(5)), "--slug", "x", "--limit", "7"], spark).first()
    assert out["records"] == 7 and out["shards"] == len(read) == len(set(read)) == 3  # two by the footers, one more for the blank rows


def numbered(spark, n, per_file):
    return spark.range(n).select((F.col("id") / per_file).cast("long").alias("file_seq"), (F.col("id") % per_file).alias("position"), F.concat(F.lit("é"), F.col("id").cast("string")).alias("value"))


def test_chunk_files_replace_their_own(spark, tmp_path):
    folder = tmp_path / "m"
    chunk_files.write_chunk_files(numbered(spark, 95, 10), str(folder), "s")
    assert sorted(p.name for p in folder.iterdir()) == [f"s-{k:05d}.md" for k in range(10)]
    assert (folder / "s-00009.md").read_text() == "".join(f"é{k}\n" for k in range(90, 95))
    (folder / "t-00000.md").write_text("other")
    (folder / "sub").mkdir()
    chunk_files.write_chunk_files(numbered(spark, 15, 10), str(folder), "s")
    assert sorted(p.name for p in folder.iterdir()) == ["s-00000.md", "s-00001.md", "sub", "t-00000.md"]
    chunk_files.write_chunk_files(numbered(spark, 0, 10), str(folder), "s")
    assert sorted(p.name for p in folder.iterdir()) == ["sub", "t-00000.md"] and [p.name for p in tmp_path.iterdir()] == ["m"]


def test_an_aborted_write_leaves_nothing(spark, tmp_path):
    chunk_files.write_chunk_files(numbered(spark, 30, 10), str(tmp_path / "m"), "s")
    before = {p.name: p.read_text() for p in (tmp_path / "m").iterdir()}
    broken = numbered(spark, 90, 10).withColumn("value", F.when(F.col("file_seq") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="broken"):
        chunk_files.write_chunk_files(broken, str(tmp_path / "m"), "s")
    assert {p.name: p.read_text() for p in (tmp_path / "m").iterdir()} == before and [p.name for p in tmp_path.iterdir()] == ["m"]


def test_many_files_are_placed_at_once(spark, tmp_path, monkeypatch):
    chunk_files.write_chunk_files(numbered(spark, 3000, 1), str(tmp_path / "m"), "s")
    assert len(list((tmp_path / "m").iterdir())) == 3000


def test_table_functions(spark):
    table_functions.register(spark)
    rows = [("<think>a</think>b",), ("plain  ",), (None,), ("",), ("x</think>y</think>z",), ("<|think_start|>t<|think_end|> u",)]
    df = spark.createDataFrame(rows, "response string")
    got = spark.sql("SELECT * FROM split_traces(TABLE({t}), 'response')", t=df).collect()
    want = df.where("response IS NOT NULL").select("response", split_trace("response").alias("p")).select("response", "p.thinking", "p.answer").collect()
    assert sorted(r for r in map(tuple, got) if r[0] is not None) == sorted(map(tuple, want)) and (None, None, None) in map(tuple, got)
    with pytest.raises(Exception, match="no column"):
        spark.sql("SELECT * FROM split_traces(TABLE({t}), 'nothing')", t=df)
    assert spark.sql("SELECT * FROM split_traces(TABLE({t}), 'response')", t=df.limit(0)).count() == 0
