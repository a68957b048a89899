import os

import duckdb
import pytest

import __spark_entry__ as entry
from siltstone import event_queries, queries

QUERIES, ORACLE_SQL = queries.QUERIES | event_queries.QUERIES, queries.ORACLE_SQL | event_queries.ORACLE_SQL


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def same(spark, sf_dir, query, sql):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
    cur = con.execute(sql)
    have = [d[0] for d in cur.description]
    assert sorted(have) == names
    want = sorted((tuple(plain(r[have.index(n)]) for n in names) for r in cur.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    same(spark, sf_dir, QUERIES[name], ORACLE_SQL[name])


ODD_TITLES = [
    "cut off &am", "AT&T & a &quot;q&quot; &#1; &nope; &", "&", "a]]> b > c", " both ends  ", "\n\tlines\n", "\u00a0wide\u3000", "in\r\nside\rit", "\t", " ", "",
    "bell \x07 and \x0b", "\ufffe\uffff", "50% + %41 \x01", "50% + %41", "\U0001f600 \ue000", "null", "12", "&" * 70_000, "a&amp;b",
]


def test_titles_that_are_no_xml(spark, tmp_path):
    pages = [(k, f"<html><title>{t}</title></html>") for k, t in enumerate(ODD_TITLES)] + [(100, None), (101, ""), (102, "<p>no title</p>"), (103, "<title>open")]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = sorted(con.execute(ORACLE_SQL["catalog_categories"]).fetchall())
    got = QUERIES["catalog_categories"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == want and len(want) == len(ODD_TITLES) - 2 + 1 and (0, "cut off &am") in want


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "document" in df.columns


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL) and set(QUERIES) <= set(entry.queries())
