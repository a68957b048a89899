"""Views of the driver's tables in the shapes that the operators take, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .session import table


def _wrap(text, form):
    """The five shapes of a model's answer, thinking and answer parted at the first line end or in the middle."""
    at = F.instr(text, "\n")
    half = F.floor(F.length(text) / 2).cast("int")
    a = F.when(at > 0, text.substr(F.lit(1), at - 1)).otherwise(text.substr(F.lit(1), half))
    b = F.when(at > 0, text.substr(at + 1, F.length(text))).otherwise(text.substr(half + 1, F.length(text)))
    return (
        F.when(form == 0, F.concat(F.lit("<|think_start|>"), a, F.lit("<|think_end|>"), b))
        .when(form == 1, F.concat(F.lit("<think>"), a, F.lit("</think>"), b))
        .when(form == 2, F.concat(F.lit(" thinking"), a, F.lit("<｜end▁of▁thinking｜>"), b))
        .when(form == 3, F.concat(F.lit("<think>"), a))
        .otherwise(text)
    )


_WRAP_SQL = """CASE f WHEN 0 THEN '<|think_start|>' || a || '<|think_end|>' || b WHEN 1 THEN '<think>' || a || '</think>' || b
  WHEN 2 THEN ' thinking' || a || '<｜end▁of▁thinking｜>' || b WHEN 3 THEN '<think>' || a ELSE t END"""
_PARTS_SQL = """CASE WHEN strpos(t, chr(10)) > 0 THEN substr(t, 1, strpos(t, chr(10)) - 1) ELSE substr(t, 1, CAST(floor(length(t) / 2) AS INTEGER)) END AS a,
  CASE WHEN strpos(t, chr(10)) > 0 THEN substr(t, strpos(t, chr(10)) + 1) ELSE substr(t, CAST(floor(length(t) / 2) AS INTEGER) + 1) END AS b"""


def traces_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn with the assistant turn after it, in the flat layout."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", F.lead("role").over(w).alias("r2"), F.lead("text").over(w).alias("t2"))
    pairs = turns.where("role = 'user' AND r2 = 'assistant'")
    return pairs.select(
        "conv_id", "turn", F.col("text").alias("instruction"), _wrap(F.col("t2"), F.col("conv_id") % 5).alias("response"),
        F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit(" intent "), F.col("conv_id").cast("string"))).alias("intent"), F.lit("en").alias("language"),
    )


TRACES_FLAT = f"""traces_flat AS (SELECT conv_id, turn, instruction, {_WRAP_SQL} AS response,
  CASE WHEN conv_id % 2 = 0 THEN ' intent ' || conv_id END AS intent, 'en' AS language FROM (
    SELECT *, {_PARTS_SQL} FROM (SELECT conv_id, turn, text AS instruction, conv_id % 5 AS f, role, lead(role) OVER w AS r2, lead(text) OVER w AS t
      FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND r2 = 'assistant'))"""


def traces_gen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four documents to a problem, some generations null, marks from the labels (null where there is none)."""
    docs, labels, bench = (table(spark, sf_dir, t) for t in ("documents", "labels", "benchmark"))
    gen = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("<think>"), "source", F.lit("</think>"), "text")).when(F.col("doc_id") % 3 == 1, F.col("text"))
    rows = docs.join(labels, "doc_id", "left").select(F.floor(F.col("doc_id") / 4).alias("bucket"), "doc_id", gen.alias("gen"), (F.col("quality") == 1).alias("ok"))
    lists = rows.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("doc_id", "gen", "ok"))).alias("x"))
    out = lists.select(
        "bucket", F.transform("x", lambda x: x["gen"]).alias("generations"), F.transform("x", lambda x: x["ok"]).alias("correctness_math_verify"),
        F.concat(F.lit(" answer "), F.col("bucket").cast("string")).alias("answer"), (F.col("bucket") % 40).alias("item_id"),
    )
    return out.join(bench.select("item_id", F.col("text").alias("problem")), "item_id", "left").drop("item_id")


TRACES_GEN = """traces_gen AS (SELECT x.*, b.text AS problem FROM (
  SELECT doc_id // 4 AS bucket, list(CASE doc_id % 3 WHEN 0 THEN '<think>' || source || '</think>' || text WHEN 1 THEN text END ORDER BY doc_id) AS generations,
    list(quality = 1 ORDER BY doc_id) AS correctness, ' answer ' || (doc_id // 4) AS answer, (doc_id // 4) % 40 AS item_id
  FROM documents LEFT JOIN labels USING (doc_id) GROUP BY doc_id // 4) x LEFT JOIN benchmark b USING (item_id))"""


def traces_msgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation as one list of messages, answers in the five shapes, with a token count."""
    rows = table(spark, sf_dir, "conversations")
    text = F.when(F.col("role") == "assistant", _wrap(F.col("text"), (F.col("conv_id") + F.col("turn")) % 5)).otherwise(F.col("text"))
    tokens = F.size(F.split(F.trim("text"), "[ \t\n]+"))
    lists = rows.select("conv_id", "turn", "role", text.alias("content"), tokens.alias("k")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "content"))).alias("x"), F.sum("k").alias("num_tokens")
    )
    messages = F.transform("x", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    return lists.select("conv_id", messages.alias("messages"), F.when(F.col("conv_id") % 10 != 9, F.col("num_tokens")).alias("num_tokens"), F.concat(F.lit("src"), (F.col("conv_id") % 3).cast("string")).alias("source"))


TURNS = f"""turns AS (SELECT conv_id, turn, role, CASE WHEN role = 'assistant' THEN {_WRAP_SQL} ELSE t END AS content, t FROM (
  SELECT *, {_PARTS_SQL} FROM (SELECT conv_id, turn, role, text AS t, (conv_id + turn) % 5 AS f FROM conversations)))"""
BUDGETS = r"""budgets AS (SELECT conv_id, CASE WHEN conv_id % 10 <> 9 THEN CAST(sum(len(string_split_regex(trim(text), '[ \t\n]+'))) AS BIGINT) END AS num_tokens
  FROM conversations GROUP BY conv_id)"""


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the rows of a manifest; some keys malformed, some sizes negative or null."""
    d = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        F.when(d % 17 == 0, F.concat("lang", F.lit("/"), d.cast("string"))).otherwise(F.concat(F.lit("datasets/"), "lang", F.lit("/"), d.cast("string"), F.lit(".zim"))).alias("key"),
        F.concat(F.lit("https://example.org/"), d.cast("string")).alias("url"),
        F.array("lang", "source").alias("categories"),
        F.concat(F.lit("lm-"), "lang").alias("model"),
        F.when(d % 13 == 0, -F.col("n_chars")).when(d % 11 != 0, F.col("n_chars")).alias("size"),
        F.col("source").alias("site"),
        F.when(d % 5 == 0, "").when(d % 5 == 1, "zim").when(d % 5 == 2, "reasoning").when(d % 5 == 3, "other").alias("kind"),
        F.when(d % 5 == 2, F.concat(F.lit("org/r"), d.cast("string"))).alias("repo"),
        F.lit(None).cast("string").alias("config"),
        F.lit(None).cast("string").alias("split"),
    )


MANIFEST = """manifest AS (SELECT CASE WHEN doc_id % 17 = 0 THEN lang || '/' || doc_id ELSE 'datasets/' || lang || '/' || doc_id || '.zim' END AS key,
  'https://example.org/' || doc_id AS url, [lang, source] AS categories, 'lm-' || lang AS model,
  CASE WHEN doc_id % 13 = 0 THEN -n_chars WHEN doc_id % 11 <> 0 THEN n_chars END AS size, source AS site,
  CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'zim' WHEN 2 THEN 'reasoning' WHEN 3 THEN 'other' END AS kind,
  CASE WHEN doc_id % 5 = 2 THEN 'org/r' || doc_id END AS repo FROM documents)"""
KEY_CATEGORY = "CASE WHEN len(string_split(key, '/')) = 3 AND string_split(key, '/')[1] = 'datasets' THEN string_split(key, '/')[2] ELSE '' END"
KEY_FILENAME = "CASE WHEN len(string_split(key, '/')) = 3 AND string_split(key, '/')[1] = 'datasets' THEN string_split(key, '/')[3] ELSE '' END"


def catalog_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as the entries of a catalog: seven kinds of names, variants, languages and links."""
    p = F.col("page_id")
    group = F.floor(p % 50 / 7).cast("string")
    host = F.regexp_extract("url", r"://([^/]+)", 1)
    plain = F.regexp_replace("url", r"[?#].*|/$", "")
    named = F.concat(plain, F.lit("_"), p.cast("string"))
    site = F.when(p % 7 <= 1, "wikipedia").when(p % 7 <= 3, "stack_exchange").when(p % 7 == 5, "iFixit").otherwise("other")
    name = (
        F.when(p % 7 == 0, F.concat(F.lit("Wikipedia_en_physics_"), group))
        .when(p % 7 == 1, F.concat(F.lit("wikipedia_en_football_all_"), group))
        .when(p % 7 == 2, F.concat(F.lit("Physics.stackexchange.com_en_all_"), group))
        .when(p % 7 == 3, F.concat(host, F.lit("_en_"), group))
        .when(p % 7 == 4, F.concat(F.lit("Planetmath.org_en_all_"), group))
        .when(p % 7 == 5, F.concat(F.lit("ifixit_en_"), group))
        .otherwise(F.concat(host, F.lit("_khanacademy_"), group))
    )
    href = (
        F.when(p % 4 == 0, F.concat(named, F.lit(".zim")))
        .when(p % 4 == 1, F.concat(named, F.lit(".zim.meta4")))
        .when(p % 4 == 2, F.concat(named, F.lit(".ZIM/?x=1#top")))
        .otherwise(F.concat("url", F.lit(".zim")))
    )
    image = F.struct(F.lit("image").alias("_rel"), F.lit("x.png").alias("_href"), F.lit("image/png").alias("_type"), F.lit(1).cast("bigint").alias("_length"))
    get = F.struct(
        F.when(p % 3 == 0, "next").otherwise("http://opds-spec.org/acquisition/open-access").alias("_rel"), href.alias("_href"),
        F.when(p % 3 <= 1, "application/x-zim").otherwise("application/octet-stream").alias("_type"), F.length("html").cast("bigint").alias("_length"),
    )
    return table(spark, sf_dir, "pages").select(
        p.alias("ordinal"), site.alias("site"), F.concat(F.lit("urn:"), p.cast("string")).alias("id"),
        F.when(p % 11 == 0, "").otherwise(name).alias("name"),
        F.when(p % 5 == 0, "mini").when(p % 5 == 1, "nopic").when(p % 5 == 2, "").when(p % 5 == 3, "maxi").otherwise("text").alias("flavour"),
        F.when(p % 9 == 0, "eng,deu").when(p % 9 == 1, " ENG ").when(p % 9 == 2, "fra").otherwise("eng").alias("language"),
        F.when(p % 19 == 0, F.array(image)).otherwise(F.array(image, get)).alias("link"), href.alias("href"), "url",
    )


ENTRIES = r"""entries AS (SELECT *, CASE WHEN page_id % 4 = 0 THEN named || '.zim' WHEN page_id % 4 = 1 THEN named || '.zim.meta4'
    WHEN page_id % 4 = 2 THEN named || '.ZIM/?x=1#top' ELSE url || '.zim' END AS href FROM (
  SELECT page_id, page_id AS ordinal, url, length(html) AS len, 'urn:' || page_id AS id,
    regexp_replace(url, '[?#].*|/$', '') || '_' || page_id AS named,
    CASE WHEN page_id % 7 <= 1 THEN 'wikipedia' WHEN page_id % 7 <= 3 THEN 'stack_exchange' WHEN page_id % 7 = 5 THEN 'iFixit' ELSE 'other' END AS site,
    CASE WHEN page_id % 11 = 0 THEN '' ELSE CASE page_id % 7 WHEN 0 THEN 'Wikipedia_en_physics_' || g WHEN 1 THEN 'wikipedia_en_football_all_' || g
      WHEN 2 THEN 'Physics.stackexchange.com_en_all_' || g WHEN 3 THEN host || '_en_' || g WHEN 4 THEN 'Planetmath.org_en_all_' || g
      WHEN 5 THEN 'ifixit_en_' || g ELSE host || '_khanacademy_' || g END END AS name,
    CASE page_id % 5 WHEN 0 THEN 'mini' WHEN 1 THEN 'nopic' WHEN 2 THEN '' WHEN 3 THEN 'maxi' ELSE 'text' END AS flavour,
    CASE page_id % 9 WHEN 0 THEN 'eng,deu' WHEN 1 THEN ' ENG' || chr(160) WHEN 2 THEN 'fra' ELSE 'eng' END AS language,
    page_id % 19 <> 0 AS has_link
  FROM (SELECT *, (page_id % 50) // 7 AS g, regexp_extract(url, '://([^/]+)', 1) AS host FROM pages)))"""
