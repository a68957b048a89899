"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from . import cdc, html_text, jaccard, leaks, lm, mixing, omh, pieces, quality, secrets, spelling, turns, warc

QUERIES = {
    "op1_secret_scans": secrets.op1,
    "op2_quality_rules": quality.op2,
    "op3_html_text": html_text.op3,
    "op4_warc": warc.op4,
    "op5_jaccard_join": jaccard.op5,
    "op6_lm_scoring": lm.op6,
    "op7_mixing": mixing.op7,
    "op8_sentencepiece": pieces.op8,
    "op9_fingerprints": omh.op9,
    "op10_substring_dedup": cdc.op10,
    "op11_conversation_repair": turns.op11,
    "op12_spelling_variants": spelling.op12,
    "op13_decontamination": leaks.op13,
}


def _secrets_sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    parts = []
    for k, r in enumerate(secrets.RULES):
        size = f"length(regexp_extract(m, {quote(r.pattern)}, {r.group}))" if r.group else "length(m)"
        parts.append(
            f"""SELECT doc_id, {k} AS rank, '{r.kind}' AS kind, s AS start, s + length(m) AS stop FROM (
              SELECT doc_id, m, sum(length(g) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) - length(m) AS s FROM (
                SELECT doc_id, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g, unnest(range(len(ms))) AS i FROM (
                  SELECT doc_id, regexp_extract_all(t, {quote(r.pattern)}) AS ms, string_split_regex(t, {quote(r.pattern)}) AS gs
                  FROM docs WHERE regexp_matches(t, {quote(r.pattern)})))) WHERE {size} >= {r.least}"""
        )
    base = ", ".join(quote(r.kind) for r in secrets.BASE_RULES)
    counts = ", ".join(f"CAST(count(*) FILTER (f.kind = '{r.kind}') AS BIGINT) AS n_{r.kind}" for r in secrets.BASE_RULES)
    span = "f.kind || ':' || CAST(f.start AS BIGINT) || ':' || CAST(f.stop AS BIGINT)"
    return f"""WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
      found AS ({' UNION ALL '.join(parts)})
      SELECT d.doc_id, {counts},
        sha256(coalesce(string_agg({span}, ',' ORDER BY f.start, f.rank) FILTER (f.kind IN ({base})), '')) AS base_sha256,
        coalesce(string_agg({span}, ',' ORDER BY f.start, f.rank) FILTER (f.kind IS NOT NULL), '') AS spans
      FROM docs d LEFT JOIN found f USING (doc_id) GROUP BY d.doc_id"""


# DuckDB has no base32: five bits of the SHA-1 at a time.
_WARC_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
  d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS hex FROM p),
  bits AS (SELECT hex, string_agg(lpad(bin(CAST('0x' || c AS INTEGER)), 4, '0'), '' ORDER BY i) AS b FROM (
    SELECT hex, unnest(string_split(hex, '')) AS c, unnest(range(40)) AS i FROM (SELECT DISTINCT hex FROM d)) GROUP BY hex),
  code AS (SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum([
      CAST(substr(b, 5 * i + j + 1, 1) AS INTEGER) * CAST(pow(2, 4 - j) AS INTEGER) for j in range(5)])::BIGINT, 1), '' ORDER BY i) AS payload_digest
    FROM (SELECT hex, b, unnest(range(32)) AS i FROM bits) GROUP BY hex),
  m AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS last FROM d)
  SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> last THEN last END AS refers_to, true AS valid FROM m JOIN code USING (hex)"""

_JACCARD_SQL = r"""WITH RECURSIVE
  w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
  sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))
      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
  n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
  o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM sh a JOIN sh b USING (s) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
  l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
  e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
  reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, e.b FROM reach r JOIN e ON e.a = r.y)
  SELECT x AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(y) AS component_id
  FROM reach LEFT JOIN n ON n.doc_id = x GROUP BY x"""

_LM_SQL = r"""WITH
  d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
  t AS (SELECT doc_id, i, w, lag(w) OVER p AS v, lag(w, 2) OVER p AS u FROM (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d)
    WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
  c1 AS (SELECT w, count(*) AS n FROM t GROUP BY w), c2 AS (SELECT v, w, count(*) AS n FROM t WHERE i > 0 GROUP BY v, w),
  c3 AS (SELECT u, v, w, count(*) AS n FROM t WHERE i > 1 GROUP BY u, v, w), total AS (SELECT sum(n) AS n FROM c1),
  s AS (SELECT t.doc_id, CASE WHEN c3.n >= 2 THEN 0 WHEN c2.n >= 2 THEN least(i, 2) - 1 ELSE least(i, 2) END AS steps,
    CASE WHEN c3.n >= 2 THEN ln(c3.n) - ln(uv.n) WHEN c2.n >= 2 THEN ln(c2.n) - ln(cv.n) ELSE ln(c1.n) - ln(total.n) END AS x
    FROM t JOIN total ON true JOIN c1 ON c1.w = t.w LEFT JOIN c1 cv ON cv.w = t.v LEFT JOIN c2 ON c2.v = t.v AND c2.w = t.w
    LEFT JOIN c2 uv ON uv.v = t.u AND uv.w = t.v LEFT JOIN c3 ON c3.u = t.u AND c3.v = t.v AND c3.w = t.w),
  r AS (SELECT doc_id, sum(x + steps * ln(0.4)) AS x, sum(steps) AS steps FROM s GROUP BY doc_id)
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, round(coalesce(x, 0), 6) AS log_score, round(x / len(ws), 6) AS mean_log_score,
    CAST(coalesce(steps, 0) AS BIGINT) AS n_backoffs FROM d LEFT JOIN r USING (doc_id)"""

# DuckDB has no crc32: a table of 256 remainders, then one byte at a time.
_SPELLING_SQL = r"""WITH RECURSIVE
  remainders AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
  runs AS (SELECT doc_id, run, count(*) AS times FROM (SELECT doc_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents)
    WHERE length(run) >= 7 GROUP BY 1, 2),
  hex AS (SELECT run, times, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
  bytes AS (SELECT run, times, list_transform(range(length(x) // 2), lambda k: CAST('0x' || substr(x, 2 * k + 1, 2) AS BIGINT)) AS bs FROM hex),
  h AS (SELECT run, times, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bs), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
    FROM bytes, remainders),
  typed AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM h),
  words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
  cuts AS (SELECT word, n, p, substr(word, 1, p) || substr(word, p + 2) AS cut FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)),
  near AS (SELECT DISTINCT a, b, bn FROM (
    SELECT x.word AS a, y.word AS b, y.n AS bn FROM cuts x JOIN cuts y ON x.cut = y.cut AND x.p = y.p WHERE x.word <> y.word
    UNION ALL SELECT w.word, c.word, c.n FROM words w JOIN cuts c ON c.cut = w.word
    UNION ALL SELECT c.word, w.word, w.n FROM words w JOIN cuts c ON c.cut = w.word)),
  ranked AS (SELECT a, b, bn, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY bn DESC, b) AS r FROM near),
  forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN bn >= 10 * w.n THEN b END AS form, CASE WHEN bn >= 10 * w.n THEN bn END AS form_n
    FROM words w LEFT JOIN ranked ON a = w.word AND r = 1),
  chain(word, place, step) AS (SELECT word, word, 0 FROM forms UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN forms f ON f.word = c.place WHERE f.form IS NOT NULL)
  SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, max_by(place, step) AS root FROM chain GROUP BY word) USING (word)"""

_LEAKS_SQL = r"""WITH
  d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
  b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
  win AS (SELECT DISTINCT item, least(len(ws), 10) AS m, array_to_string(ws[i:i+9], ' ') AS win FROM (
    SELECT item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
  dw AS (SELECT doc_id, i, m, array_to_string(ws[i:i+m-1], ' ') AS win FROM (
    SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM win) WHERE len(ws) >= m)),
  hit AS (SELECT DISTINCT doc_id, i, m, item FROM dw JOIN win USING (win, m)),
  places AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
  items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(p.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(i.n, 0) AS BIGINT) AS n_items,
    sha256(coalesce(i.s, '')) AS items_sha256, p.n IS NOT NULL AS contaminated FROM d LEFT JOIN places p USING (doc_id) LEFT JOIN items i USING (doc_id)"""

ORACLE_SQL = {
    "op1_secret_scans": _secrets_sql(),
    "op4_warc": _WARC_SQL,
    "op5_jaccard_join": _JACCARD_SQL,
    "op6_lm_scoring": _LM_SQL,
    "op12_spelling_variants": _SPELLING_SQL,
    "op13_decontamination": _LEAKS_SQL,
}
