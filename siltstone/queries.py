"""One query per operator over the driver's tables, with the same query in SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import views as V
from .functions import keys, rules, text
from .operators import catalog, manifest, records
from .operators.markdown import html_to_markdown, html_to_markdown_sql
from .plans import work
from .session import table
from .sources import catalog as feeds
from .sources import manifests, traces

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

quote = lambda s: "'" + s.replace("'", "''") + "'"
WS = quote(text.WHITE_SPACE)
TRIM = lambda c: f"trim({c}, {WS})"
PER_FILE, TOKEN_BUDGET, FIRST = 25, 400, 40
BYTE_BUDGET = 100_000


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def parse_sql(c: str) -> tuple[str, str]:
    """thinking and answer of a response in SQL."""
    body = f"(CASE {' '.join(f'WHEN starts_with({c}, {quote(o)}) THEN substr({c}, {len(o) + 1})' for o in text.OPENERS)} ELSE {c} END)"
    thinking = " ".join(f"WHEN strpos({body}, {quote(x)}) > 0 THEN {TRIM(f'substr({body}, 1, strpos({body}, {quote(x)}) - 1)')}" for x in text.CLOSERS)
    answer = " ".join(f"WHEN strpos({body}, {quote(x)}) > 0 THEN {TRIM(f'substr({body}, strpos({body}, {quote(x)}) + {len(x)})')}" for x in text.CLOSERS)
    return f"(CASE {thinking} ELSE {TRIM(body)} END)", f"(CASE {answer} ELSE '' END)"


THINKING, ANSWER = parse_sql("response")
FLAT_RECORDS = f"""flat AS (SELECT conv_id, turn, {TRIM('instruction')} AS instruction, {THINKING} AS thinking, {ANSWER} AS response,
  coalesce({TRIM('intent')}, '') AS intent, '' AS task_category, '' AS difficulty, {TRIM('language')} AS language, '' AS source FROM traces_flat)"""
RECORDS = f"WITH {V.TRACES_FLAT}, {FLAT_RECORDS}, records AS (SELECT * FROM flat WHERE NOT (instruction = '' AND thinking = ''))"
DOCUMENT_SQL = """'### Question' || chr(10) || chr(10) || instruction || chr(10) || chr(10)
  || CASE WHEN intent <> '' THEN '### What the user wants' || chr(10) || chr(10) || intent || chr(10) || chr(10) ELSE '' END
  || CASE WHEN thinking <> '' THEN '### Reasoning' || chr(10) || chr(10) || thinking || chr(10) || chr(10) ELSE '' END
  || CASE WHEN response <> '' THEN '### Answer' || chr(10) || chr(10) || response || chr(10) || chr(10) ELSE '' END || '---' || chr(10) || chr(10)"""
FIELDS = "instruction, thinking, response, intent, task_category, difficulty, language, source"
M, E = f"WITH {V.MANIFEST}", f"WITH {V.ENTRIES}"


def flat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.ingest(V.traces_flat(spark, sf_dir), keep=("conv_id", "turn"))


# --- text and traces ---


@query(f"""SELECT doc_id, {TRIM("p || text || p")} AS trimmed, CAST(length(p || text || p) AS BIGINT) AS n_before FROM (
  SELECT doc_id, text, substr({WS}, CAST(1 + doc_id % 25 AS INTEGER), 1) AS p FROM documents)""")
def unicode_trim(spark, d):
    padded = table(spark, d, "documents").select("doc_id", F.lit(text.WHITE_SPACE).substr((F.col("doc_id") % 25 + 1).cast("int"), F.lit(1)).alias("p"), "text")
    both = F.concat("p", "text", "p")
    return padded.select("doc_id", text.unicode_trim(both).alias("trimmed"), F.length(both).cast("long").alias("n_before"))


@query(f"WITH {V.TRACES_FLAT} SELECT conv_id, turn, {THINKING} AS thinking, {ANSWER} AS answer FROM traces_flat")
def parse_reasoning(spark, d):
    return V.traces_flat(spark, d).select("conv_id", "turn", text.split_trace("response").alias("p")).select("conv_id", "turn", "p.thinking", "p.answer")


@query(f"{RECORDS} SELECT conv_id, turn, {DOCUMENT_SQL} AS document FROM records")
def format_document(spark, d):
    return flat_records(spark, d).select("conv_id", "turn", records.document().alias("document"))


T_CONTENT, A_CONTENT = parse_sql("content")
EXTRACT = f"""WITH {V.TURNS}, p AS (SELECT *, {T_CONTENT} AS th, {A_CONTENT} AS an FROM turns),
  extracted AS (SELECT conv_id, coalesce(max_by({TRIM('content')}, turn) FILTER (WHERE role IN ('user', 'human')), '') AS instruction,
    coalesce(max_by(th, turn) FILTER (WHERE role IN ('assistant', 'gpt') AND th <> ''), '') AS thinking,
    coalesce(max_by(an, turn) FILTER (WHERE role IN ('assistant', 'gpt') AND an <> ''), '') AS response FROM p GROUP BY conv_id)"""


@query(f"{EXTRACT} SELECT * FROM extracted")
def conversation_extract(spark, d):
    turns = V.traces_msgs(spark, d).select("conv_id", F.posexplode("messages").alias("turn", "m")).select("conv_id", "turn", "m.role", "m.content")
    return records.from_turns(turns, "conv_id", "turn", "role", "content")


@query(f"""{EXTRACT} SELECT conv_id, instruction, thinking, response, thinking <> '' AND response <> '' AS complete,
  {DOCUMENT_SQL} AS document FROM (SELECT *, '' AS intent FROM extracted) WHERE NOT (instruction = '' AND thinking = '')""")
def conversation_documents(spark, d):
    found = conversation_extract(spark, d).where(records.not_blank())
    doc = text.format_document(F.col("instruction"), F.lit(""), F.col("thinking"), F.col("response"))
    return found.select("conv_id", "instruction", "thinking", "response", records.complete().alias("complete"), doc.alias("document"))


@query("""SELECT conv_id, turn, last_value(nullif(CASE WHEN role = 'user' THEN text END, '') IGNORE NULLS) OVER (
  PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_text FROM conversations""")
def conversation_last_value_window(spark, d):
    turns = table(spark, d, "conversations").withColumn("own", F.when(F.col("role") == "user", F.col("text")))
    return records.last_values(turns, "conv_id", "turn", "own").select("conv_id", "turn", "last_text")


GEN_T, GEN_A = parse_sql("g")
GENERATED = f"""WITH {V.TRACES_GEN}, compacted AS (SELECT *, list_filter(generations, lambda x: x IS NOT NULL) AS gs,
    list_filter(correctness, lambda x: x IS NOT NULL) AS cs FROM traces_gen),
  chosen AS (SELECT bucket, answer, problem, gs[coalesce(nullif(list_position(cs[1:len(gs)], true), 0), 1)] AS g FROM compacted WHERE len(gs) > 0)"""


@query(f"{GENERATED} SELECT bucket, g AS generation FROM chosen")
def verified_generation(spark, d):
    chosen = traces.verified_generation(F.col("generations"), F.col("correctness_math_verify"))
    return V.traces_gen(spark, d).select("bucket", chosen.alias("generation")).where("generation IS NOT NULL")


@query(f"{RECORDS} SELECT conv_id, turn, {FIELDS} FROM records")
def ingest_flat(spark, d):
    return flat_records(spark, d)


@query(f"""{GENERATED}, r AS (SELECT bucket, coalesce({TRIM('problem')}, '') AS instruction, {GEN_T} AS thinking,
    CASE WHEN {GEN_A} <> '' THEN {GEN_A} ELSE {TRIM('answer')} END AS response, '' AS intent, '' AS task_category, '' AS difficulty, '' AS language, '' AS source FROM chosen)
  SELECT bucket, {FIELDS} FROM r WHERE NOT (instruction = '' AND thinking = '')""")
def ingest_generations(spark, d):
    return traces.ingest(V.traces_gen(spark, d), keep=("bucket",))


@query(f"""{EXTRACT}, {V.BUDGETS} SELECT conv_id, instruction, thinking, response, '' AS intent, '' AS task_category, '' AS difficulty, '' AS language,
  'src' || (conv_id % 3) AS source FROM extracted JOIN budgets USING (conv_id)
  WHERE coalesce(num_tokens, 0) <= {TOKEN_BUDGET} AND NOT (instruction = '' AND thinking = '')""")
def ingest_messages(spark, d):
    return traces.ingest(V.traces_msgs(spark, d), keep=("conv_id",), max_tokens=TOKEN_BUDGET)


@query(f"WITH {V.BUDGETS} SELECT conv_id, num_tokens FROM budgets WHERE coalesce(num_tokens, 0) <= {TOKEN_BUDGET}")
def token_budget(spark, d):
    return traces.within_budget(V.traces_msgs(spark, d), TOKEN_BUDGET).select("conv_id", "num_tokens")


@query(f"WITH {V.TRACES_FLAT}, {FLAT_RECORDS} SELECT conv_id, turn FROM flat WHERE NOT (instruction = '' AND thinking = '')")
def emit_filter(spark, d):
    rows = traces.records_from_flat(V.traces_flat(spark, d), keep=("conv_id", "turn"))
    return rows.where(records.not_blank()).select("conv_id", "turn")


@query(f"""{RECORDS} SELECT conv_id, turn, instruction, thinking, response, nullif(intent, '') AS intent, nullif(language, '') AS language,
  CAST(length(instruction) + length(thinking) + length(response) AS BIGINT) AS n_chars FROM records WHERE thinking <> '' AND response <> ''""")
def jsonl_records(spark, d):
    lines = flat_records(spark, d).where(records.complete()).select("conv_id", "turn", records.json_line().alias("line"))
    parsed = lines.select("conv_id", "turn", F.from_json("line", "instruction string, thinking string, response string, intent string, language string").alias("r"))
    size = F.length("r.instruction") + F.length("r.thinking") + F.length("r.response")
    return parsed.select("conv_id", "turn", "r.*", size.cast("long").alias("n_chars"))


@query(f"{RECORDS} SELECT count(*) AS records, count(*) FILTER (WHERE thinking <> '' AND response <> '') AS complete FROM records")
def reasoning_summary(spark, d):
    return records.summary(flat_records(spark, d))


@query(f"{RECORDS} SELECT conv_id, turn, {FIELDS} FROM records ORDER BY conv_id, turn LIMIT {FIRST}")
def limited_ingest(spark, d):
    return records.limited(flat_records(spark, d), ["conv_id", "turn"], FIRST)


@query(f"""{RECORDS} SELECT conv_id, turn, (rn - 1) // {PER_FILE} AS file_seq, (rn - 1) % {PER_FILE} + 1 AS position, {DOCUMENT_SQL} AS document
  FROM (SELECT *, row_number() OVER (ORDER BY conv_id, turn) AS rn FROM records)""")
def markdown_chunks(spark, d):
    rows = flat_records(spark, d).withColumn("place", F.col("conv_id") * 1000 + F.col("turn"))
    return records.chunked(rows, "place", PER_FILE).select("conv_id", "turn", "file_seq", "position", records.document().alias("document"))


# --- manifests ---


@query("SELECT 'datasets/' || lang || '/' || doc_id || '.zim' AS key, 'u' || doc_id AS url, n_chars AS size, [lang, source] AS categories FROM documents")
def manifest_scan(spark, d):
    docs = table(spark, d, "documents")
    entry = F.concat(
        F.lit('{"datasets/'), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit('.zim": {"url": "u'), F.col("doc_id").cast("string"),
        F.lit('", "size": '), F.col("n_chars").cast("string"), F.lit(', "categories": ["'), "lang", F.lit('", "'), "source", F.lit('"]}}'),
    )
    files = docs.select(F.explode(F.array(entry, F.lit("  "), F.lit("null"))).alias("value"))
    return manifests.manifest_rows(files).select("key", "url", "size", "categories")


@query(f"{M} SELECT key, {V.KEY_CATEGORY} AS key_category, {V.KEY_FILENAME} AS key_filename, regexp_replace({V.KEY_FILENAME}, '\\.zim$', '') AS archive FROM manifest")
def key_parts(spark, d):
    parts = manifest.with_key_parts(V.manifest(spark, d))
    return parts.select("key", "key_category", "key_filename", keys.archive_name(F.col("key_filename")).alias("archive"))


@query(f"{M} SELECT DISTINCT site, 'lm-' || site AS model, regexp_replace(model, '^lm-', '') AS category FROM manifest")
def model_names(spark, d):
    rows = V.manifest(spark, d)
    return rows.select("site", keys.model_name(F.col("site")).alias("model"), keys.model_category(F.col("model")).alias("category")).distinct()


@query(f"{M} SELECT CAST(coalesce(sum(size), 0) AS BIGINT) AS total_size FROM manifest")
def manifest_total_size(spark, d):
    return manifest.total_size(V.manifest(spark, d))


@query(f"{M} SELECT CAST(coalesce(sum(greatest(size, 0)), 0) AS BIGINT) AS selection_size FROM manifest WHERE site IN ('src1', 'src2')")
def selection_size(spark, d):
    return manifest.selection_size(manifest.select(V.manifest(spark, d), sites=["src1", "src2"]))


@query(f"{M} SELECT DISTINCT unnest(categories) AS category FROM manifest")
def category_set(spark, d):
    return manifest.category_set(V.manifest(spark, d))


@query(f"""{M}, k AS (SELECT *, {V.KEY_CATEGORY} AS category FROM manifest)
  SELECT category, count(*) AS n_datasets, CAST(coalesce(sum(size), 0) AS BIGINT) AS total_bytes FROM k WHERE category <> '' GROUP BY category""")
def manifest_partition_counts(spark, d):
    return manifest.partition_counts(V.manifest(spark, d))


@query(f"""{M}, o AS (SELECT key, 'new' AS url, 7 AS size FROM manifest WHERE kind = 'zim' UNION ALL SELECT 'datasets/xx/new.zim', 'new', 7)
  SELECT coalesce(o.key, m.key) AS key, CASE WHEN o.key IS NULL THEN m.url ELSE o.url END AS url, CASE WHEN o.key IS NULL THEN m.size ELSE o.size END AS size
  FROM manifest m FULL JOIN o ON o.key = m.key""")
def manifest_merge(spark, d):
    base = V.manifest(spark, d).select("key", "url", "size")
    changed = base.join(V.manifest(spark, d).where("kind = 'zim'").select("key"), "key", "left_semi").select("key", F.lit("new").alias("url"), F.lit(7).cast("long").alias("size"))
    added = spark.range(1).select(F.lit("datasets/xx/new.zim").alias("key"), F.lit("new").alias("url"), F.lit(7).cast("long").alias("size"))
    return manifest.merge(base, changed.unionByName(added))


@query(f"""{M}, managed AS (SELECT DISTINCT lang AS category FROM documents UNION ALL SELECT unnest(['physics', 'base']))
  SELECT category FROM managed WHERE category NOT IN (SELECT {V.KEY_CATEGORY} FROM manifest WHERE site <> 'src0' AND categories[1] <> 'en')""")
def manifest_stale_categories(spark, d):
    extra = spark.createDataFrame([("physics",), ("base",)], "category string")
    managed = table(spark, d, "documents").select(F.col("lang").alias("category")).distinct().unionByName(extra)
    return manifest.stale_categories(V.manifest(spark, d).where("site <> 'src0' AND categories[0] <> 'en'"), managed)


@query(f"""{M} SELECT key, model, site FROM manifest WHERE model = 'lm-fr' OR list_has_any(categories, ['src3', 'zz']) OR site IN ('src5', 'de')
  OR {V.KEY_CATEGORY} IN ('src5', 'de') ORDER BY key""")
def select_union_filter(spark, d):
    return manifest.select(V.manifest(spark, d), models=["lm-fr"], categories=["src3", "zz"], sites=["src5", "de"]).select("key", "model", "site")


@query(f"{M} SELECT key FROM manifest WHERE list_has_any(categories, ['en', 'src7'])")
def category_semi(spark, d):
    wanted = spark.createDataFrame([("en",), ("src7",)], "category string")
    exploded = V.manifest(spark, d).select("key", F.explode("categories").alias("category"))
    return exploded.join(F.broadcast(wanted), "category", "left_semi").select("key").distinct()


@query(f"{M} SELECT key, kind FROM manifest WHERE coalesce(kind, '') IN ('', 'zim')")
def only_zim(spark, d):
    return manifest.only_archives(V.manifest(spark, d)).select("key", "kind")


@query(f"{M} SELECT key, repo, regexp_replace({V.KEY_FILENAME}, '\\.zim$', '') AS slug FROM manifest WHERE kind = 'reasoning' ORDER BY key")
def reasoning_items(spark, d):
    rows = manifest.require_repo(manifest.reasoning_items(V.manifest(spark, d)))
    return rows.select("key", "repo", keys.archive_name(keys.key_filename(F.col("key"))).alias("slug"))


@query(f"{M}, s AS (SELECT CAST(sum(greatest(size, 0)) AS BIGINT) AS total_bytes FROM manifest) SELECT total_bytes, total_bytes > {BYTE_BUDGET} AS exceeds FROM s")
def byte_budget(spark, d):
    return manifest.exceeds_budget(V.manifest(spark, d), BYTE_BUDGET)


@query(f"""{M}, f AS (SELECT 'datasets/' || lang || '/' || doc_id || '.zim' AS key, CASE WHEN doc_id % 4 = 0 THEN n_chars ELSE n_chars + 1 END AS present_size
    FROM documents WHERE doc_id % 3 = 0)
  SELECT key, url, size, present_size, CASE WHEN present_size IS NOT NULL AND (coalesce(size, 0) = 0 OR present_size = size) THEN 'skip' ELSE 'download' END AS action
  FROM manifest LEFT JOIN f USING (key)""")
def download_plan(spark, d):
    docs = table(spark, d, "documents").where("doc_id % 3 = 0")
    path = F.concat(F.lit("datasets/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".zim"))
    files = docs.select(path.alias("path"), F.when(F.col("doc_id") % 4 == 0, F.col("n_chars")).otherwise(F.col("n_chars") + 1).alias("length"))
    return work.download_plan(V.manifest(spark, d), files)


@query("""SELECT page_id, attempt, CAST(CASE WHEN attempt = 0 THEN 0 ELSE 1000 * pow(2, attempt - 1) END AS BIGINT) AS wait_ms
  FROM (SELECT page_id, unnest(range(0, CAST(page_id % 6 + 1 AS BIGINT))) AS attempt FROM pages)""")
def retry_schedule(spark, d):
    pages = table(spark, d, "pages").select("page_id")
    rows = work.retry_schedule(pages, (F.col("page_id") % 6).cast("int"), F.lit(1000))
    return rows.select("page_id", F.col("attempt").cast("long").alias("attempt"), "wait_ms")


@query(f"""{M}, k AS (SELECT *, {V.KEY_CATEGORY} AS c, regexp_replace({V.KEY_FILENAME}, '\\.zim$', '') AS a FROM manifest)
  SELECT key, 'datasets/' || c || '/markdown/' || a AS output, CASE WHEN CAST(a AS BIGINT) % 2 = 0 THEN 'skip' ELSE 'extract' END AS action,
    ['archive-to-markdown', '--output', 'datasets/' || c || '/markdown', '--workers', '2', '--quiet', '--no-clobber', key] AS argv FROM k WHERE c <> ''""")
def extract_plan(spark, d):
    rows = V.manifest(spark, d).where(keys.key_category(F.col("key")) != "")
    here = table(spark, d, "documents").where("doc_id % 2 = 0").select(F.concat(F.lit("datasets/"), "lang", F.lit("/markdown/"), F.col("doc_id").cast("string")).alias("path"))
    return work.extract_plan(rows, here, workers=2)


@query(f"""{M}, f AS (SELECT lang AS category, count(*) AS n FROM documents WHERE lang <> 'de' GROUP BY lang), m AS (SELECT DISTINCT regexp_replace(model, '^lm-', '') AS category FROM manifest)
  SELECT category, coalesce(n, 0) AS n_files, coalesce(n, 0) > 0 AS present FROM m LEFT JOIN f USING (category)""")
def corpus_presence(spark, d):
    models = work.requested_models(V.manifest(spark, d)).select(keys.model_category(F.col("model")).alias("category"))
    return work.corpus_presence(models, table(spark, d, "documents").where("lang <> 'de'").select(F.col("lang").alias("category")))


@query(f"{M} SELECT DISTINCT model FROM manifest WHERE model <> '' AND model <> 'lm-base' ORDER BY model")
def train_specialties(spark, d):
    return work.requested_models(V.manifest(spark, d))


_S = work.TrainSettings()
_SIZE = f"'--device-batch-size', '{_S.device_batch_size}', '--num-iterations', '{_S.num_iterations}'"


@query(f"""{M}, m AS (SELECT DISTINCT model, regexp_replace(model, '^lm-', '') AS category FROM manifest)
  SELECT 0 AS step, 'tokenizer' AS stage, '' AS model, 'base' AS category, ['run', './cmd/tok_train', '--data-dir', 'datasets/base', '--data-format', 'markdown',
    '--vocab-size', '131072', '--max-chars', '2000000', '--base-dir', 'checkpoints'] AS argv
  UNION ALL SELECT 1, 'base', 'lm-base', 'base', ['run', './cmd/base_train', '--domain', 'base', '--data-dir', 'datasets/base', '--data-format', 'markdown',
    '--base-dir', 'checkpoints', '--model-tag', 'd20', '--depth', '20', '--preset', 'flash', '--vocab-size', '131072', '--max-seq-len', '512', {_SIZE}]
  UNION ALL SELECT 2, 'specialty', model, category, ['run', './cmd/base_train', '--domain', category, '--init-model', 'checkpoints/domains/base/base_checkpoints/d20/model_000200.gn',
    '--data-dir', 'datasets/' || category, '--data-format', 'markdown', '--base-dir', 'checkpoints', '--model-tag', 'd20', {_SIZE}] FROM m""")
def train_plan(spark, d):
    return work.train_plan(V.manifest(spark, d))


# --- catalog ---

LINK_SQL = """CASE WHEN NOT has_link THEN NULL WHEN page_id % 3 <= 1 THEN href WHEN page_id % 3 <> 0 THEN href END"""
KEEP_SQL = f"lower({TRIM('language')}) = 'eng' AND site <> 'ted'"
RANK_SQL = "CASE flavour WHEN 'nopic' THEN 0 WHEN 'maxi' THEN 1 WHEN 'mini' THEN 2 WHEN '' THEN 3 ELSE 4 END"
FILE_SQL = r"""CASE WHEN lower(b) LIKE '%.zim' THEN b ELSE '' END"""
BASE_SQL = r"""regexp_replace(regexp_extract(regexp_replace(regexp_extract(href, '^([^?#]*)', 1), '/$', ''), '([^/]*)$', 1), '\.meta4$', '')"""
SUBSTRING_SQL = lambda site: "(CASE " + " ".join(f"WHEN contains(lower(name), {quote(p)}) THEN '{c}'" for s, _, p, c in rules.substring_rules() if s == site) + " END)"
NO_XML = r"[^\t\n\r\x20-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]"
HOSTS_SQL = "(CASE " + " ".join(f"WHEN split_part(lower(name), '_', 1) = '{h}' THEN '{c}'" for h, c in rules.HOSTS) + " END)"
SKIP_SQL = " OR ".join(f"contains(lower(name), {quote(s)})" for s in rules.WIKIPEDIA_SKIP)
CLASS_SQL = f"""(CASE WHEN site = 'wikipedia' THEN CASE WHEN NOT ({SKIP_SQL}) THEN {SUBSTRING_SQL('wikipedia')} END
  WHEN site = 'stack_exchange' THEN {HOSTS_SQL} WHEN site = 'other' THEN {SUBSTRING_SQL('other')}
  {' '.join(f"WHEN site = '{s}' THEN '{c}'" for s, c in rules.SITE_CATEGORY.items())} END)"""


@query(r"""SELECT page_id, trim(regexp_extract(html, '<title>([^<]*)', 1), ' ') AS category FROM (
  SELECT page_id, replace(html, '&amp;', 'and') AS html FROM pages) WHERE trim(regexp_extract(html, '<title>([^<]*)', 1), ' ') <> ''""")
def catalog_categories(spark, d):
    found = F.regexp_extract(F.replace("html", F.lit("&amp;"), F.lit("and")), "<title>([^<]*)", 1)
    pages = table(spark, d, "pages").where("html IS NOT NULL").select("page_id", found.alias("title"))
    # The SQL trims spaces alone: titles with other white space at their ends, or with characters that XML has not, are put into the feed as URLs write them.
    coded = F.col("title").rlike(NO_XML) | (text.unicode_trim("title") != F.trim("title"))
    pages = pages.withColumn("coded", coded)
    title = F.when(F.col("coded"), F.url_encode("title")).otherwise(feeds.xml_text(F.col("title")))
    xml = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title> '), title, F.lit(" </title></entry><entry><title> </title></entry></feed>"))
    entries = feeds.feed_entries(pages.select("page_id", "coded", xml.alias("value")))
    own = text.unicode_trim("title")
    return entries.select("page_id", F.when(F.col("coded"), F.trim(F.url_decode(own))).otherwise(own).alias("category")).where("category <> ''")


@query(f"{E} SELECT page_id AS ordinal, language FROM entries WHERE {KEEP_SQL}")
def keep_entry(spark, d):
    rows = V.catalog_entries(spark, d)
    return rows.where(catalog.keep_entry(F.col("site"), F.col("language"))).select("ordinal", "language")


@query(f"""{E} SELECT ordinal, site, name, flavour FROM (SELECT *, row_number() OVER (
  PARTITION BY site, CASE WHEN name = '' THEN id ELSE name END ORDER BY {RANK_SQL}, ordinal) AS rn FROM entries) WHERE rn = 1""")
def select_flavour(spark, d):
    return catalog.select_flavour(V.catalog_entries(spark, d)).select("ordinal", "site", "name", "flavour")


@query(f"{E} SELECT ordinal, {FILE_SQL} AS filename FROM (SELECT *, {BASE_SQL} AS b FROM entries)")
def zim_filename(spark, d):
    return V.catalog_entries(spark, d).select("ordinal", keys.archive_filename(F.col("href")).alias("filename"))


DATASETS_SQL = f"""datasets AS (SELECT 'datasets/' || category || '/' || file AS key, regexp_replace(link, '\\.meta4$', '') AS url, 'lm-' || category AS model,
    CAST(len AS BIGINT) AS size, site, ordinal, language, name, id, flavour FROM (SELECT *, {FILE_SQL} AS file FROM (
    SELECT *, {BASE_SQL} AS b, {LINK_SQL} AS link, {CLASS_SQL} AS category FROM entries)) WHERE category IS NOT NULL AND link <> '' AND file <> '')"""


@query(f"{E}, {DATASETS_SQL} SELECT ordinal, key, url, model, size, site FROM datasets")
def build_dataset(spark, d):
    return catalog.build_dataset(V.catalog_entries(spark, d)).select("ordinal", "key", "url", "model", "size", "site")


@query(f"""{E}, kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site, CASE WHEN name = '' THEN id ELSE name END ORDER BY {RANK_SQL}, ordinal) AS rn
    FROM entries WHERE {KEEP_SQL}) WHERE rn = 1), {DATASETS_SQL.replace('FROM entries', 'FROM kept')}
  SELECT key, max_by(url, ordinal) AS url, max_by(model, ordinal) AS model, max_by(size, ordinal) AS size, max_by(site, ordinal) AS site FROM datasets GROUP BY key""")
def catalog_to_manifest(spark, d):
    return catalog.catalog_to_manifest(V.catalog_entries(spark, d)).select("key", "url", "model", "size", "site")


@query(f"{E} SELECT ordinal, {CLASS_SQL} AS category FROM entries")
def classify(spark, d):
    return V.catalog_entries(spark, d).select("ordinal", rules.classify(F.col("site"), F.col("name")).alias("category"))


@query(f"{E} SELECT ordinal, category FROM (SELECT ordinal, {HOSTS_SQL} AS category FROM entries) WHERE category IS NOT NULL")
def classify_host(spark, d):
    return rules.classify_hosts(V.catalog_entries(spark, d), "name").select("ordinal", "category")


@query(f"""{E} SELECT ordinal, category FROM (SELECT ordinal, CASE site WHEN 'wikipedia' THEN {SUBSTRING_SQL('wikipedia')} WHEN 'other' THEN {SUBSTRING_SQL('other')} END AS category
  FROM entries) WHERE category IS NOT NULL""")
def rule_theta_join(spark, d):
    return rules.classify_by_join(V.catalog_entries(spark, d), "site", "name", "ordinal")


@query(f"SELECT page_id, {html_to_markdown_sql('html')} AS markdown FROM pages")
def html_to_markdown_pages(spark, d):
    return table(spark, d, "pages").select("page_id", html_to_markdown(F.col("html")).alias("markdown"))


QUERIES["html_to_markdown"] = QUERIES.pop("html_to_markdown_pages")
ORACLE_SQL["html_to_markdown"] = ORACLE_SQL.pop("html_to_markdown_pages")
