import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators import catalog, manifest, records, sinks
from siltstone.operators.markdown import html_to_markdown
from siltstone.plans import work
from siltstone.sources import catalog as feeds
from siltstone.sources import files, manifests, traces
from siltstone.streaming import ingest as streaming

MANIFEST = "key string, model string, categories array<string>, size bigint, site string, kind string"


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [
            ("datasets/base/a.zim", "lm-base", ["base"], 10, "wikibooks", ""),
            ("datasets/physics/b.zim", "lm-physics", ["physics"], 0, "phet", "zim"),
            ("datasets/programming/c.zim", "lm-programming", ["programming"], -5, "other", "reasoning"),
            ("bad/key", "", ["base"], None, None, None),
        ],
        MANIFEST,
    )


def keys_of(df):
    return [r["key"].split("/")[-1] for r in df.collect()]


def test_selection_is_a_union(rows):
    assert len(keys_of(manifest.select(rows))) == 4
    assert keys_of(manifest.select(rows, models=["lm-physics"])) == ["b.zim"]
    assert keys_of(manifest.select(rows, categories=["base", "programming"])) == ["key", "a.zim", "c.zim"]
    assert keys_of(manifest.select(rows, sites=["physics"])) == ["b.zim"]
    assert keys_of(manifest.select(rows, models=["lm-base"], categories=["physics"])) == ["a.zim", "b.zim"]


def test_sizes_and_sets(rows):
    assert manifest.total_size(rows).first()[0] == 5
    assert manifest.selection_size(rows).first()[0] == 10
    assert manifest.total_size(rows.where("false")).first()[0] == 0
    assert {r[0] for r in manifest.category_set(rows).collect()} == {"base", "physics", "programming"}
    assert manifest.exceeds_budget(rows, 9).first()["exceeds"] and not manifest.exceeds_budget(rows, 0).first()["exceeds"]
    with pytest.raises(ValueError, match="exceeds"):
        manifest.guard_budget(rows, 9)


def test_kinds(rows):
    assert set(keys_of(manifest.only_archives(rows))) == {"a.zim", "b.zim", "key"}
    assert keys_of(manifest.reasoning_items(rows)) == ["c.zim"]


def test_merge_replaces_whole_rows(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "key string, size bigint, url string")
    over = spark.createDataFrame([("b", None, "z"), ("c", 3, None)], "key string, size bigint, url string")
    assert sorted(tuple(r) for r in manifest.merge(base, over).collect()) == [("a", 1, "x"), ("b", None, "z"), ("c", 3, None)]


def test_stale_categories(spark, rows):
    managed = spark.createDataFrame([("base",), ("physics",), ("chemistry",)], "category string")
    assert [r[0] for r in manifest.stale_categories(rows, managed).collect()] == ["chemistry"]


def test_manifest_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"k1": {"url": "u", "size": 3}, "k2": {"url": "old"}}))
    (tmp_path / "b.json").write_text(json.dumps({"k2": {"url": "new", "categories": ["c"]}}))
    (tmp_path / "c.json").write_text("  \n")
    (tmp_path / "d.json").write_text("null")
    (tmp_path / "e.txt").write_text("no manifest")
    got = {r["key"]: r for r in manifests.read_manifests(spark, str(tmp_path)).collect()}
    assert set(got) == {"k1", "k2"} and got["k2"]["url"] == "new" and got["k1"]["size"] == 3
    assert manifests.read_manifests(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "f.json").write_text("{broken")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        manifests.read_manifest(spark, str(tmp_path / "f.json")).collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        manifests.read_manifest(spark, str(tmp_path / "g.json"))


FEED = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom" xmlns:dc="http://purl.org/dc/terms/"><totalResults>41</totalResults>
<entry><id>urn:1</id><title> T </title><name>n</name><language>eng</language><articleCount>342</articleCount><dc:issued>2026-01-01T00:00:00Z</dc:issued>
<author><name>other</name></author><link rel="acq" href="h.zim" type="application/x-zim" length="246517760"/></entry><entry><title> </title></entry></feed>"""


def test_feed(spark):
    row = feeds.feed_entries(spark.createDataFrame([(FEED,)], "value string")).where("position = 0").first()
    assert (row["name"], row["articleCount"], row["issued"], row["link"][0]["_length"]) == ("n", 342, "2026-01-01T00:00:00Z", 246517760)
    assert [r["category"] for r in feeds.category_titles(spark.createDataFrame([(FEED,)], "value string")).collect()] == ["T"]


@pytest.mark.parametrize("page", ["<html><body>are you a robot?</body></html>", "<feed><entry></feed>"])
def test_feed_refuses_other_pages(spark, page):
    with pytest.raises(Exception, match="(?i)not a catalog feed|malformed"):
        feeds.feed_entries(spark.createDataFrame([(page,)], "value string")).collect()


def pages(total, size, ignore_start=False):
    asked = []

    def get(start):
        asked.append(start)
        at = 0 if ignore_start else start
        entries = "".join(f"<entry><title>{k}</title></entry>" for k in range(at, min(total, at + size)))
        return f"<feed><totalResults>{total}</totalResults><startIndex>{at}</startIndex>{entries}</feed>"

    return get, asked


def test_paging():
    get, asked = pages(5, 2)
    assert len(list(feeds.walk_pages(get))) == 3 and asked == [0, 2, 4]
    get, asked = pages(5, 2, ignore_start=True)
    assert len(list(feeds.walk_pages(get))) == 2 and asked == [0, 2]
    get, asked = pages(0, 2)
    assert list(feeds.walk_pages(get)) == []
    assert feeds.page_urls("http://x/", "a b", 0, 10, "eng") == "http://x/entries?start=0&count=10&lang=eng&category=a+b"


def entry(k, site, name, flavour, language, href, length):
    return (k, site, f"urn:{k}", name, flavour, language, [("http://opds-spec.org/acquisition/open-access", href, "application/x-zim", length)])


ENTRY = "ordinal int, site string, id string, name string, flavour string, language string, link array<struct<_rel:string,_href:string,_type:string,_length:bigint>>"


def test_catalog_to_manifest(spark):
    rows = [
        entry(0, "wikipedia", "wikipedia_en_physics", "maxi", "eng", "https://x/wikipedia_en_physics_maxi.zim.meta4", 1900),
        entry(1, "wikipedia", "wikipedia_en_physics", "nopic", "eng", "https://x/wikipedia_en_physics_nopic.zim.meta4", 900),
        entry(2, "wikipedia", "wikipedia_en_football", "nopic", "eng", "https://x/wikipedia_en_football.zim", 1),
        entry(3, "wikipedia", "wikipedia_en_all", "nopic", "eng,deu", "https://x/a.zim", 1),
        entry(4, "stack_exchange", "cooking.stackexchange.com_en_all", "", "eng", "https://x/c.zim", 1),
        entry(5, "stack_exchange", "physics.stackexchange.com_en_all", "", "ENG ", "https://x/p.zim", 500),
        entry(6, "other", "planetmath.org_en_all", "", "eng", "https://x/planetmath.zim", 200),
        entry(7, "other", "planetmath.org_en_all", "", "eng", "https://x/later.zim", 201),
        entry(8, "ted", "wikibooks", "", "eng", "https://x/t.zim", 1),
        entry(9, "wikibooks", "b", "", "eng", "https://x/page.html", 1),
    ]
    got = {r["key"]: (r["size"], r["url"]) for r in catalog.catalog_to_manifest(spark.createDataFrame(rows, ENTRY)).collect()}
    assert got == {
        "datasets/physics/wikipedia_en_physics_nopic.zim": (900, "https://x/wikipedia_en_physics_nopic.zim"),
        "datasets/physics/p.zim": (500, "https://x/p.zim"),
        "datasets/math/planetmath.zim": (200, "https://x/planetmath.zim"),
    }


def test_select_flavour_ignores_row_order(spark):
    rows = [entry(k, "s", n, f, "eng", "", 1) for k, (n, f) in enumerate([("a", "mini"), ("a", ""), ("a", "odd"), ("b", "maxi"), ("b", "nopic"), ("c", "x"), ("c", "y"), ("", "")])]
    for order in (rows, rows[::-1]):
        got = sorted(r["ordinal"] for r in catalog.select_flavour(spark.createDataFrame(order, ENTRY)).collect())
        assert got == [0, 4, 5, 7]


def test_flat_traces(spark):
    df = spark.createDataFrame([(" q ", "<think>t</think>a", None, 5), (None, None, "x", 5), ("", "", "x", 5)], "instruction string, response string, intent string, difficulty int")
    got = [(r["instruction"], r["thinking"], r["response"], r["intent"], r["difficulty"]) for r in traces.ingest(df).collect()]
    assert got == [("q", "t", "a", "", "")]


def test_generation_traces(spark):
    rows = [
        (1, "p", ["<think>a</think>b", "<think>c</think>d"], [False, True], " ans "),
        (2, "p", [None, "<think>x", "y"], [None, False, False, True], " ans "),  # nulls are dropped first, then marks beyond the list
        (3, "p", [None], [True], None),
        (4, "p", None, None, None),
        (5, "p", ["<think>e"], None, None),
    ]
    df = spark.createDataFrame(rows, "k int, problem string, generations array<string>, correctness_math_verify array<boolean>, answer string")
    got = {r["k"]: (r["thinking"], r["response"]) for r in traces.ingest(df, keep=("k",)).collect()}
    assert got == {1: ("c", "d"), 2: ("x", "ans"), 5: ("e", "")}


def test_message_traces(spark):
    rows = [
        (1, [("system", "s"), ("user", "u1"), ("assistant", "<think>t1</think>a1"), ("human", " "), ("gpt", "<think>t2")], 10),
        (2, [("user", "u"), ("assistant", "<think>t</think>a")], 100),
        (3, [("user", None), ("assistant", "<think>t</think>a")], None),
        (4, None, 1),
    ]
    df = spark.createDataFrame(rows, "k int, messages array<struct<role:string,content:string>>, num_tokens bigint")
    got = {r["k"]: (r["instruction"], r["thinking"], r["response"]) for r in traces.ingest(df, keep=("k",), max_tokens=50).collect()}
    # a blank user turn clears, a blank answer doesn't; a null content moves contents against roles
    assert got[1] == ("", "t2", "a1") and 2 not in got and 4 not in got and got[3][0] == "<think>t</think>a"


def test_unknown_layout(spark):
    with pytest.raises(ValueError, match="unrecognized"):
        traces.trace_layout(spark.range(1))


def record_rows(spark, n):
    return spark.createDataFrame([(k, f"q{k}", "t", "a" if k % 2 else "", "", "", "", "", "") for k in range(n)], "place int, instruction string, thinking string, response string, intent string, task_category string, difficulty string, language string, source string")


def test_json_lines(spark, tmp_path):
    rows = record_rows(spark, 3)
    sinks.write_json_lines(rows, str(tmp_path / "j"))
    lines = [r[0] for r in spark.read.text(str(tmp_path / "j")).collect()]
    assert lines == ['{"instruction":"q1","thinking":"t","response":"a"}']
    assert tuple(records.summary(rows).first()) == (3, 1)


def test_markdown_chunks(spark, tmp_path):
    rows = record_rows(spark, 23).orderBy(F.rand(3))
    got = sorted((r["place"], r["file_seq"], r["position"]) for r in records.chunked(rows, "place", 5).collect())
    assert got == [(k, k // 5, k % 5 + 1) for k in range(23)]
    (tmp_path / "m").mkdir()
    (tmp_path / "m/s-00009.md").write_text("of an earlier run")
    assert sinks.write_markdown(rows, str(tmp_path / "m"), "s", "place", 5) == 5
    assert [r["path"].rsplit("/", 1)[1] for r in files.markdown_files(spark, str(tmp_path / "m")).collect()] == [f"s-0000{k}.md" for k in range(5)]
    assert sinks.write_markdown(rows, str(tmp_path / "m"), "s", "place", 5) == 5
    parts = sorted(p for p in (tmp_path / "m").iterdir() if p.suffix == ".md")
    assert parts[0].read_text().startswith("### Question\n\nq0\n\n### Reasoning\n\nt\n\n---\n\n### Question\n\nq1")


def test_many_ranges(spark):
    rows = record_rows(spark, 3000).orderBy(F.rand(3))
    assert records.numbered(rows, "place", 2000).where("rn <> place + 1").count() == 0
    assert records.numbered(rows.limit(0), "place", 4).count() == 0


def test_manifests_by_category(spark, tmp_path):
    rows = [("datasets/math/b.zim", "u", ["math"], 5), ("datasets/math/a.zim", "v", [], 0), ("datasets/base/c.zim", "w", None, None), ("bad", "x", [], 1)]
    found = spark.createDataFrame(rows, "key string, url string, categories array<string>, size bigint")
    for name in ("physics", "reasoning"):
        (tmp_path / f"{name}.json").write_text("{}")
    sinks.write_manifests(found, str(tmp_path))
    assert sorted(p.name for p in tmp_path.glob("*.json")) == ["base.json", "math.json", "reasoning.json"]
    assert json.loads((tmp_path / "math.json").read_text()) == {"datasets/math/a.zim": {"url": "v"}, "datasets/math/b.zim": {"url": "u", "categories": ["math"], "size": 5}}
    back = manifests.read_manifests(spark, str(tmp_path))
    assert {(r["key"], r["url"], r["size"]) for r in back.collect()} == {("datasets/math/b.zim", "u", 5), ("datasets/math/a.zim", "v", None), ("datasets/base/c.zim", "w", None)}


def test_required_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no checkpoint"):
        files.require_checkpoint(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError, match="no Markdown"):
        files.require_markdown(spark, str(tmp_path / "none"))
    for k in (2, 10):
        (tmp_path / f"model_{k:06d}.gn").write_text("")
    assert files.require_checkpoint(spark, str(tmp_path)) == str(tmp_path / "model_000010.gn")


def test_limit_after_filters(spark):
    rows = record_rows(spark, 10).where("place >= 3")
    assert [r["place"] for r in records.limited(rows, ["place"], 2).collect()] == [3, 4]


def test_plans(spark, rows):
    here = spark.createDataFrame([("datasets/base/a.zim", 10), ("datasets/physics/b.zim", 7), ("datasets/programming/c.zim", 1)], "path string, length bigint")
    actions = {r["key"].split("/")[-1]: r["action"] for r in work.download_plan(rows.withColumn("url", F.lit("u")), here).collect()}
    assert actions == {"a.zim": "skip", "b.zim": "skip", "c.zim": "download", "key": "download"}
    waits = [r["wait_ms"] for r in work.retry_schedule(spark.range(1), F.lit(4), F.lit(1000)).orderBy("attempt").collect()]
    assert waits == [0, 1000, 2000, 4000, 8000]
    done = spark.createDataFrame([("datasets/base/markdown/a",)], "path string")
    good = rows.where("key <> 'bad/key'")
    assert {r["action"] for r in work.extract_plan(good, done, force=True).collect()} == {"extract"}
    plan = {r["key"].split("/")[-1]: r for r in work.extract_plan(good, done).collect()}
    assert plan["a.zim"]["action"] == "skip" and plan["b.zim"]["argv"][-2:] == ["--no-clobber", "datasets/physics/b.zim"]
    with pytest.raises(Exception, match="malformed key"):
        work.extract_plan(rows, done).collect()


def test_train_plan(rows):
    plan = work.train_plan(rows).collect()
    assert [(r["stage"], r["model"]) for r in plan] == [("tokenizer", ""), ("base", "lm-base"), ("specialty", "lm-physics"), ("specialty", "lm-programming")]
    argv = plan[2]["argv"]
    assert argv[argv.index("--init-model") + 1].endswith("checkpoints/domains/base/base_checkpoints/d20/model_000200.gn") and argv[argv.index("--domain") + 1] == "physics"
    reused = work.train_plan(rows, work.TrainSettings(reuse_base=True, tokenizer_present=True)).collect()
    assert [r["stage"] for r in reused] == ["specialty", "specialty"]


def test_corpus_files(spark, tmp_path):
    for name in ("b/x.md", "a.MD", "c.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("# t")
    assert [r["path"].rsplit("/", 1)[1] for r in files.markdown_files(spark, str(tmp_path)).collect()] == ["a.MD", "x.md"]
    assert files.read_markdown(spark, str(tmp_path)).count() == 2
    names = spark.createDataFrame([("model_999999.gn",), ("model_1000000.gn",), ("other.gn",)], "path string")
    assert files.latest_checkpoint(names).first()[0] == "model_1000000.gn"


def test_html_to_markdown(spark):
    page = "<html><head><title>x</title></head><body><nav>no</nav><h1>Head &amp; y</h1><p>a <b>b</b><br>c <a href=\"/u\">l</a></p><ul><li>i<li>j</ul><script>z</script><!-- c --></body></html>"
    got = spark.createDataFrame([(page,)], "h string").select(html_to_markdown(F.col("h"))).first()[0]
    assert got == "# Head & y\n\na **b**\nc [l](/u)\n\n- i\n- j"


def test_streaming_ingest(spark, tmp_path):
    schema = T.StructType([T.StructField("instruction", T.StringType()), T.StructField("response", T.StringType())])
    shards = str(tmp_path / "shards")
    spark.createDataFrame([("q1", "<think>t</think>a"), ("q2", "none")], schema).write.parquet(shards)
    args = (spark, shards, schema, str(tmp_path / "out"), str(tmp_path / "state"))
    streaming.ingest_available(*args).awaitTermination()
    spark.createDataFrame([("q3", "<think>t</think>a")], schema).write.mode("append").parquet(shards)
    streaming.ingest_available(*args).awaitTermination()
    assert sorted(json.loads(r[0])["instruction"] for r in spark.read.text(str(tmp_path / "out")).collect()) == ["q1", "q3"]
