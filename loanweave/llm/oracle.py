"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from loanweave.llm import license_scans

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

URL_FILTERS = rf"""
WITH parsed AS (
  SELECT page_id,
         {_LOWER.format("coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '')")} AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
rules(rhost, rpath, rverdict) AS (VALUES
  ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, host, path, rhost || rpath AS rule, rverdict,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost || rpath) DESC, rhost || rpath DESC) AS place
  FROM (SELECT DISTINCT page_id, host, path FROM parsed)
  JOIN rules ON (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.rverdict, 'allow') AS verdict
FROM parsed p LEFT JOIN fits f ON f.page_id = p.page_id AND f.host = p.host AND f.path = p.path AND f.place = 1
"""

# Length of the marks of a turn, and one character for each escaped control string.
_CONTROLS = r"[<\[]\\*(?:<SYS>>|</SYS>>|INST\]|/INST\]|s>|/s>|TURN=|/TURN\])"
CHAT_FORMATTING = rf"""
WITH chats AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, lag(role) OVER w AS before, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) AS from_end,
         CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7
              ELSE 17 + length(url_encode(role)) END
         + length(text) + len(regexp_extract_all(text, '{_CONTROLS}')) AS chars
  FROM chats WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars,
       bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user')
                     ELSE (before, role) IN (('system', 'user'), ('user', 'assistant'), ('assistant', 'user')) END
                AND (from_end > 1 OR role = 'assistant')) AS valid
FROM marked GROUP BY conv_id
"""

_TERMS = "regexp_extract_all(lower({}), '[a-z0-9]+(?:[.-][a-z0-9]+)*')"
_FORMS = ",\n  ".join(
    "('{}', '{}')".format(name, text.replace("'", "''"))
    for name, text in [*license_scans.TEMPLATES, *license_scans.HEADERS, *license_scans.whole_licences()]
)
# The same expression without possessive marks, which SQL's engine needs not.
_HEADER = license_scans.HEADER.replace("*+", "*").replace("++", "+")
LICENSE_SCANS = rf"""
WITH forms(license, unit) AS (VALUES
  {_FORMS}),
docs AS (
  SELECT doc_id, coalesce(text, '') AS text,
         CASE WHEN length(text) < 300 THEN concat_ws('/', source, lang)
              ELSE concat_ws('/', source, lang, CAST(doc_id // 1000 AS VARCHAR)) END AS folder
  FROM documents),
lines AS (
  SELECT doc_id, unit FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS unit FROM docs)
  WHERE regexp_matches(unit, '{license_scans.CUES}')),
chars AS (SELECT doc_id, sum(length(unit)) AS unit_chars FROM lines GROUP BY doc_id),
own_units AS (
  SELECT DISTINCT doc_id, unit FROM (
    SELECT * FROM lines
    UNION ALL SELECT doc_id, regexp_extract(text, '{_HEADER}', 1) FROM docs JOIN chars USING (doc_id)
    UNION ALL SELECT doc_id, text FROM docs JOIN chars USING (doc_id) WHERE unit_chars >= 0.3 * length(text) AND trim(text) <> '')
  WHERE regexp_matches(unit, '{license_scans.CUES}')),
vectors AS (SELECT DISTINCT unit FROM own_units UNION SELECT unit FROM forms),
counted AS (
  SELECT unit, term, count(*) AS n FROM (SELECT unit, unnest({_TERMS.format("unit")}) AS term FROM vectors) GROUP BY ALL),
idf AS (
  SELECT term, ln(((SELECT count(*) FROM vectors) + 1) / (count(*) + 1)) + 1 AS idf FROM counted GROUP BY term),
raw AS (SELECT unit, term, n * idf AS w FROM counted JOIN idf USING (term)),
weights AS (SELECT unit, term, w / sqrt(sum(w * w) OVER (PARTITION BY unit)) AS w FROM raw),
cosines AS (
  SELECT a.unit, f.license, round(sum(a.w * b.w), 6) AS cosine
  FROM weights a JOIN weights b USING (term) JOIN forms f ON f.unit = b.unit
  WHERE a.unit IN (SELECT unit FROM own_units) GROUP BY a.unit, b.unit, f.license),
top AS (
  SELECT doc_id, license, cosine, row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, license) AS place
  FROM own_units JOIN cosines USING (unit) WHERE cosine >= 0.6),
own AS (SELECT doc_id, license AS own_license, cosine FROM top WHERE place = 1),
joined AS (SELECT * FROM docs LEFT JOIN own USING (doc_id) LEFT JOIN chars USING (doc_id)),
licensed AS (
  SELECT folder AS ancestor, own_license AS folder_license,
         row_number() OVER (PARTITION BY folder ORDER BY cosine DESC, folder || '/' || doc_id) AS place
  FROM joined WHERE own_license IS NOT NULL AND unit_chars >= 0.3 * length(text)),
near AS (
  SELECT doc_id, ancestor, folder_license, row_number() OVER (PARTITION BY doc_id ORDER BY length(ancestor) DESC) AS near
  FROM joined JOIN licensed ON folder = ancestor OR starts_with(folder, ancestor || '/') WHERE place = 1)
SELECT doc_id, own_license, cosine, coalesce(own_license, folder_license) AS license,
       CASE WHEN own_license IS NOT NULL THEN 'own' WHEN folder_license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN own_license IS NULL THEN ancestor END AS from_folder
FROM joined LEFT JOIN (SELECT * FROM near WHERE near = 1) USING (doc_id)
"""

ORACLE = {
    "op3_license_scans": LICENSE_SCANS,
    "op5_chat_formatting": CHAT_FORMATTING,
    "op9_url_filters": URL_FILTERS,
}

_WORDS = rf"regexp_extract_all({_LOWER.format('coalesce(text, chr(32))')}, '[0-9a-z\x80-\x{{10FFFF}}]+')"
DECONTAMINATION = rf"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM items WHERE len(w) > 0)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
hits AS (
  SELECT DISTINCT r, s, i.n, item_id
  FROM (SELECT r, n, s, array_to_string(w[s : s + n - 1], ' ') AS words
        FROM (SELECT r, n, w, unnest(range(1, greatest(len(w) - n + 2, 1))) AS s
              FROM docs, (SELECT DISTINCT n FROM item_windows))) d
  JOIN item_windows i ON i.n = d.n AND i.words = d.words),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hits) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
ORACLE["op6_benchmark_decontamination"] = DECONTAMINATION

HARD_NEGATIVES = """
WITH whole AS (
  SELECT vec_id, min(struct_pack(l := label, v := list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)))) AS r
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
usable AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (r.l + 1) % 10 ELSE r.l END AS label, r.v AS v FROM whole),
parts AS (SELECT vec_id, label, unnest(v) AS x, unnest(range(len(v))) AS i FROM usable),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM parts a JOIN parts b ON a.i = b.i AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0 GROUP BY ALL),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 10
"""
ORACLE["op12_hard_negative_mining"] = HARD_NEGATIVES

# Bytes as pairs of hexadecimal digits, so that strings can be cut at any byte.
SUFFIX_DEDUP = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (SELECT r, doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS p FROM docs WHERE doc_id IS NOT NULL),
strings AS (SELECT r, doc_id, p, hash(substr(h, 2 * p + 1, 100)) AS s FROM places),
firsts AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT r, p FROM strings JOIN firsts USING (s) WHERE first < doc_id),
marked AS (SELECT r, p, CASE WHEN p - lag(p) OVER (PARTITION BY r ORDER BY p) <= 50 THEN 0 ELSE 1 END AS new FROM hits),
spans AS (
  SELECT r, min(p) AS a, max(p) + 50 AS b
  FROM (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p) AS span FROM marked) GROUP BY r, span),
gaps AS (
  SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL SELECT r, max(b), max(b) + 1000000000 FROM spans GROUP BY r),
kept AS (SELECT r, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h FROM gaps JOIN docs USING (r) GROUP BY r),
counts AS (SELECT r, count(*) AS n_spans, CAST(sum(b - a) AS BIGINT) AS n_removed FROM spans GROUP BY r)
SELECT doc_id, CAST(len(docs.h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept.h, docs.h))) AS kept_sha256
FROM docs LEFT JOIN counts USING (r) LEFT JOIN kept USING (r)
"""
ORACLE["op11_suffix_array_dedup"] = SUFFIX_DEDUP
