"""The dealt queries as plain SQL, where SQL can express them."""

from __future__ import annotations

from shelfwatch.llm.licenses import TEMPLATES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    low = f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"
    return f"regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


_OP4 = f"""
WITH dw AS (SELECT doc_id, {_words("text")} AS w FROM documents),
iw AS (SELECT item_id, {_words("text")} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
    SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
    FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dg AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM dg JOIN win USING (n, g)),
places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits)
  GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN places USING (doc_id) LEFT JOIN found USING (doc_id)"""

_OP6 = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
heads AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN heads ON heads.a = vec_id LEFT JOIN counts ON counts.a = vec_id"""


def _terms(text: str) -> str:
    cut = f"string_split_regex(lower({text}), '[^a-z0-9.\\x{{80}}-\\x{{10FFFF}}]+')"
    bare = f"list_transform({cut}, lambda t: regexp_replace(t, '^\\.+|\\.+$', '', 'g'))"
    return f"list_filter({bare}, lambda t: t <> '')"


_TEMPLATES = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(TEMPLATES))

_OP7 = f"""
WITH docs AS (
  SELECT doc_id, text, source || '/' || lang || '/' ||
    CASE WHEN doc_id % 7 <> 0 THEN (doc_id // 500)::VARCHAR || '/' ELSE '' END || doc_id AS path FROM documents),
files AS (SELECT *, regexp_replace(path, '/*[^/]*$', '') AS folder FROM docs),
tokens AS (
  SELECT doc_id, line, unnest({_terms("unit")}) AS term FROM (
    SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS line,
      unnest(string_split(text, chr(10))) AS unit FROM docs)),
lines AS (SELECT doc_id, line, term, count(*) AS n FROM tokens GROUP BY ALL),
template(k, name, body) AS (VALUES {_TEMPLATES}),
tterm AS (SELECT k, name, unnest({_terms("body")}) AS term FROM template),
total AS (SELECT count(*) AS docs FROM docs),
df AS (SELECT term, count(DISTINCT doc_id) AS df FROM lines GROUP BY term),
idf AS (
  SELECT term, ln((1 + docs) / (1 + coalesce(df, 0))) + 1 AS weight
  FROM (SELECT DISTINCT term FROM tterm UNION SELECT term FROM df) LEFT JOIN df USING (term), total),
raw AS (SELECT k, name, term, count(*) * any_value(weight) AS w FROM tterm JOIN idf USING (term) GROUP BY ALL),
norm AS (SELECT k, sqrt(sum(w * w)) AS norm FROM raw GROUP BY k),
units AS (
  SELECT doc_id, line, term, n FROM lines
  UNION ALL SELECT doc_id, -1, term, sum(n) FROM lines GROUP BY doc_id, term),
weighed AS (
  SELECT doc_id, line, term, n * weight AS w FROM units JOIN idf USING (term)),
length AS (SELECT doc_id, line, sqrt(sum(w * w)) AS length FROM weighed GROUP BY ALL),
dots AS (
  SELECT doc_id, line, name, sum(u.w * t.w / norm) AS dot FROM weighed u JOIN raw t USING (term) JOIN norm USING (k)
  GROUP BY doc_id, line, name, k),
scored AS (
  SELECT doc_id, line, name, round(dot / length, 9) AS score FROM dots JOIN length USING (doc_id, line)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, line < 0 ORDER BY score DESC, name, line) AS rn FROM scored
  WHERE score >= CASE WHEN line < 0 THEN 0.5 ELSE 0.8 END),
header AS (SELECT doc_id, name, score, line FROM ranked WHERE rn = 1 AND line >= 0),
whole AS (SELECT doc_id, name, score FROM ranked WHERE rn = 1 AND line < 0),
holders AS (
  SELECT folder AS holder, name FROM (
    SELECT folder, name, row_number() OVER (PARTITION BY folder ORDER BY score DESC, name, path) AS rn
    FROM whole JOIN files USING (doc_id)) WHERE rn = 1),
above AS (
  SELECT folder, arg_max(name, strlen(holder)) AS name, arg_max(holder, strlen(holder)) AS holder
  FROM (SELECT DISTINCT folder FROM files) f
    JOIN holders ON holder = '' OR folder = holder OR starts_with(folder, holder || '/')
  GROUP BY folder)
SELECT f.doc_id, path, coalesce(w.name, h.name) AS own_license,
  round(coalesce(w.score, h.score), 6) AS own_score, line AS own_line, w.name IS NOT NULL AS is_license_file,
  coalesce(w.name, h.name, a.name) AS license,
  CASE WHEN h.name IS NULL AND w.name IS NULL THEN a.holder END AS inherited_from
FROM files f LEFT JOIN header h USING (doc_id) LEFT JOIN whole w USING (doc_id) LEFT JOIN above a USING (folder)"""

_OP8 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (
  SELECT payload_digest, min(page_id) AS first_id FROM p
  WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)"""

ORACLE: dict[str, str] = {
    "op4_decontamination": _OP4,
    "op6_embeddings": _OP6,
    "op7_licenses": _OP7,
    "op8_warc": _OP8,
}
