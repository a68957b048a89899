import pytest
from pyspark.sql import functions as F

from siltstone.functions import keys, rules, text


def values(spark, rows, schema, **columns):
    return [r.asDict() for r in spark.createDataFrame(rows, schema).select(*[c.alias(n) for n, c in columns.items()]).collect()]


def test_trim_knows_all_white_space(spark):
    assert len(text.WHITE_SPACE) == 25
    rows = [(w + " a b " + w,) for w in text.WHITE_SPACE] + [("​x",), ("",), (None,)]
    got = [r["t"] for r in values(spark, rows, "s string", t=text.unicode_trim("s"))]
    assert got == ["a b"] * 25 + ["​x", "", None]


@pytest.mark.parametrize("case", [0])
def test_split_trace(spark, case):
    cases = [
        ("<|think_start|>plan<|think_end|> answer ", "plan", "answer"),
        ("<think>\nplan\n</think>\n\nanswer", "plan", "answer"),
        (" thinking plan<｜end▁of▁thinking｜>answer", "plan", "answer"),
        ("<think>cut off", "cut off", ""),
        ("just an answer", "just an answer", ""),
        ("a</think>b<|think_end|>c", "a</think>b", "c"),  # priority beats position
        ("x</think>y</think>z", "x", "y</think>z"),
        (" <think>kept</think>a", "<think>kept", "a"),  # an opener counts at the very start only
        ("<think> thinking x</think>y", "thinking x", "y"),
        ("", "", ""),
        (None, "", ""),
    ]
    got = values(spark, [(c[0],) for c in cases], "s string", p=text.split_trace("s"))
    assert [(g["p"]["thinking"], g["p"]["answer"]) for g in got] == [c[1:] for c in cases]


def test_format_document(spark):
    rows = [("q", "", "t", "a"), ("q", "i", "", "")]
    got = values(spark, rows, "q string, i string, t string, a string", d=text.format_document(F.col("q"), F.col("i"), F.col("t"), F.col("a")))
    assert got[0]["d"] == "### Question\n\nq\n\n### Reasoning\n\nt\n\n### Answer\n\na\n\n---\n\n"
    assert got[1]["d"] == "### Question\n\nq\n\n### What the user wants\n\ni\n\n---\n\n"


def test_keys(spark):
    rows = [("datasets/base/foo.zim",), ("",), ("foo.zim",), ("datasets/foo.zim",), ("datasets/a/b/c.zim",), ("other/a/b.zim",)]
    got = values(spark, rows, "k string", c=keys.key_category(F.col("k")), f=keys.key_filename(F.col("k")))
    assert [(g["c"], g["f"]) for g in got] == [("base", "foo.zim")] + [("", "")] * 5


def test_archive_filename(spark):
    cases = {
        "https://x/zim/a_en_all.zim.meta4": "a_en_all.zim",
        "https://x/zim/a_en_all.zim": "a_en_all.zim",
        "https://x/zim/a.zim?x=1#y": "a.zim",
        "https://x/zim/a.zim/": "a.zim",
        "https://x/zim/a.ZIM": "a.ZIM",
        "https://x/zim/a.zim//": "",
        "https://x/page.html": "",
        "": "",
    }
    got = values(spark, [(k,) for k in cases], "h string", f=keys.archive_filename(F.col("h")))
    assert [g["f"] for g in got] == list(cases.values())


def test_archive_and_model_names(spark):
    got = values(spark, [("a.zim.zim", "lm-math"), ("a.ZIM", "math"), ("a.zim\n", "")], "f string, m string", a=keys.archive_name(F.col("f")), c=keys.model_category(F.col("m")))
    assert [(g["a"], g["c"]) for g in got] == [("a.zim", "math"), ("a.ZIM", "math"), ("a.zim\n", "")]


def test_acquisition(spark):
    link = "array<struct<_rel:string,_href:string,_type:string,_length:bigint>>"
    rows = [
        ([("acquisition", "a", "text/html", 1), ("x", "b", "application/x-zim", 2)],),
        ([("image", "i", "image/png", 1), ("http://opds-spec.org/acquisition/open-access", "c", "application/octet", 3)],),
        ([("image", "i", "image/png", 1)],),
        (None,),
    ]
    got = values(spark, rows, f"l {link}", h=keys.acquisition(F.col("l"))["_href"])
    assert [g["h"] for g in got] == ["b", "c", None, None]


CLASSIFY = [
    ("wikipedia", "wikipedia_en_history_maxi", "history"),
    ("wikipedia", "Wikipedia_EN_Physics", "physics"),
    ("wikipedia", "wikipedia_en_top1m", "base"),
    ("wikipedia", "wikipedia_en_all_football wikipedia_en_football", None),
    ("wikipedia", "wikipedia_fr_all", None),
    ("stack_exchange", "math.stackexchange.com_en_all", "math"),
    ("stack_exchange", "MathOverflow.net_en_all", "math"),
    ("stack_exchange", "stackoverflow.com_en_all", "programming"),
    ("stack_exchange", "robotics.stackexchange.com_en", "engineering"),
    ("stack_exchange", "cooking.stackexchange.com_en", None),
    ("stack_exchange", "xmath.stackexchange.com_en", None),
    ("other", "learningstatisticswithr_en", "math"),
    ("other", "armypubs_en_all", "cyberstrategy"),
    ("other", "100r.co_en_all", "base"),
    ("other", "nothing", None),
    ("wikibooks", "x", "base"),
    ("iFixit", "x", "engineering"),
    ("ifixit", "x", None),
    ("phet", "x", "physics"),
    ("psiram", "x", "science"),
    ("ted", "x", None),
]


def test_classify(spark):
    got = values(spark, [c[:2] for c in CLASSIFY], "s string, n string", c=rules.classify(F.col("s"), F.col("n")))
    assert [g["c"] for g in got] == [c[2] for c in CLASSIFY]


def test_classify_by_join_agrees(spark):
    rows = [(k, *c[:2]) for k, c in enumerate(CLASSIFY) if c[0] == "other"]
    df = spark.createDataFrame(rows, "k int, s string, n string")
    joined = {r["k"]: r["category"] for r in rules.classify_by_join(df, "s", "n", "k").collect()}
    assert joined == {k: c[2] for k, c in enumerate(CLASSIFY) if c[0] == "other" and c[2]}


def test_rule_tables():
    assert len(rules.substring_rules()) == 16 + 54
    hosts = rules.HOSTS
    assert len(hosts) == len({h for h, _ in hosts}) == 27 + 45 + 10
    assert {c for _, c in hosts} | {r[3] for r in rules.substring_rules()} <= set(rules.CATEGORIES)


def test_env_with(spark):
    got = values(spark, [(["A=1", "GOX=2", "GO=3", "GO=4"],)], "e array<string>", e=keys.env_with(F.col("e"), "GO", "simd"))
    assert got[0]["e"] == ["A=1", "GOX=2", "GO=simd"]
