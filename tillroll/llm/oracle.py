"""DuckDB SQL for the registered queries that SQL can express.

Written from the contracts: every statement takes another way than the Spark
operator (plain pairwise joins instead of hashing, filters or automata).
"""

from __future__ import annotations

from . import license_rules as R

_KEYWORD = r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, source, concat_ws('/', source, lang) AS repo FROM documents),
raw AS (
  SELECT r, t, 0 AS kind, regexp_extract_all(t, '{_KEYWORD}', 0) AS ms FROM d
  UNION ALL SELECT r, t, 1, regexp_extract_all(t, 'AKIA[A-Z0-9]+', 0) FROM d
  UNION ALL SELECT r, t, 2, regexp_extract_all(t, '[0-9a-f]+', 0) FROM d WHERE regexp_matches(t, '[0-9a-f]{{24}}')),
-- the text between two matches, by cutting the text at them: positions without searching
cut AS (
  SELECT r, kind, ms, CASE kind WHEN 0 THEN regexp_split_to_array(t, '{_KEYWORD}')
    WHEN 1 THEN regexp_split_to_array(t, 'AKIA[A-Z0-9]+') ELSE regexp_split_to_array(t, '[0-9a-f]+') END AS gaps
  FROM raw WHERE len(ms) > 0),
placed AS (
  SELECT r, kind, ms[i] AS m, list_sum(list_transform(gaps[1:i], lambda g: length(g)))::BIGINT
       + coalesce(list_sum(list_transform(ms[1:i - 1], lambda g: length(g))), 0)::BIGINT AS s
  FROM cut, unnest(range(1, len(ms) + 1)) AS u(i)
  WHERE CASE kind WHEN 0 THEN true WHEN 1 THEN length(ms[i]) >= 20 ELSE length(ms[i]) >= 24 END),
spans AS (
  SELECT r, kind, s, s + length(m) AS e, CASE kind WHEN 0 THEN regexp_extract(m, '{_KEYWORD}', 2) ELSE m END AS v FROM placed),
good AS (SELECT * FROM spans WHERE kind > 0 OR length(v) >= 6),
freq AS (SELECT v, count(DISTINCT source) AS owners, count(DISTINCT repo) AS repos FROM good JOIN d USING (r) GROUP BY v),
rated AS (
  SELECT good.*, owners, repos, ['assign', 'access', 'hex'][kind + 1] || ':' || s || ':' || e AS span,
    CASE WHEN owners >= 2 THEN 'copied'
         WHEN len(list_distinct(string_split(v, ''))) >= 8
          AND NOT regexp_matches(v, '(?i)example|sample|dummy|changeme|placeholder|your|test|xxxx|1234567|abcdef') THEN 'live'
         ELSE 'placeholder' END AS class
  FROM good JOIN freq USING (v)),
per AS (
  SELECT r, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS c,
    string_agg(span, ',' ORDER BY s, kind) AS spans, string_agg(span || ':' || class, ',' ORDER BY s, kind) AS classes,
    count(*) FILTER (class = 'copied') AS n_copied, count(*) FILTER (class = 'live') AS n_live,
    count(*) FILTER (class = 'placeholder') AS n_placeholder, max(owners) AS max_owners, max(repos) AS max_repositories
  FROM rated GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_copied, 0) AS n_copied,
  coalesce(n_live, 0) AS n_live, coalesce(n_placeholder, 0) AS n_placeholder, coalesce(max_owners, 0) AS max_owners,
  coalesce(max_repositories, 0) AS max_repositories, coalesce(classes, '') AS classes
FROM d LEFT JOIN per USING (r)
"""

OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT *, CASE WHEN strlen(h) >= 1000 THEN max(page_id) OVER (PARTITION BY h) END AS top FROM p)
SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN top <> page_id THEN top END AS refers_to
FROM g
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP5 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws, regexp_split_to_array(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS gaps FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
w AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS s
  FROM b, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS u(i) WHERE len(ws) > 0),
pos AS (
  SELECT r, i, n, array_to_string(ws[i:i + n - 1], ' ') AS s
  FROM d, (SELECT DISTINCT n FROM w), unnest(range(1, len(ws) - n + 2)) AS u(i)),
found AS (SELECT r, i, n, item_id FROM pos JOIN w USING (n, s)),
hit AS (SELECT DISTINCT r, k FROM found, unnest(range(i, i + n)) AS u(k)),
hits AS (SELECT r, count(*) AS n_hit FROM hit GROUP BY r),
-- runs of hit words, as places in the text: lengths of the words and of what lies between them
runs AS (SELECT r, min(k) AS a, max(k) AS b FROM (SELECT r, k, k - row_number() OVER (PARTITION BY r ORDER BY k) AS g FROM hit) GROUP BY r, g),
places AS (
  SELECT r, list_sum(list_transform(gaps[1:a], lambda x: length(x))) + coalesce(list_sum(list_transform(ws[1:a - 1], lambda x: length(x))), 0) AS s,
    list_sum(list_transform(gaps[1:b], lambda x: length(x))) + list_sum(list_transform(ws[1:b], lambda x: length(x))) AS e
  FROM runs JOIN d USING (r)),
spans AS (SELECT r, string_agg(s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s) AS spans FROM places GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM found) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(spans, '') AS spans
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r) LEFT JOIN spans USING (r)
"""

OP6 = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i, ls[i] AS line, list_filter(regexp_split_to_array(lower(ls[i]), '[\x09-\x0D\x20]+'), lambda x: x <> '') AS ws
      FROM d, unnest(range(1, len(ls) + 1)) AS u(i)),
c AS (SELECT row_number() OVER () AS k, norm, first FROM
       (SELECT array_to_string(ws, ' ') AS norm, min({'d': doc_id, 'i': i}) AS first FROM l WHERE len(ws) > 0 GROUP BY norm)),
s AS (SELECT k, first, list_distinct(CASE WHEN len(ws) < 5 THEN [norm]
        ELSE list_transform(range(1, len(ws) - 3), lambda j: array_to_string(ws[j:j + 4], ' ')) END) AS sh
      FROM (SELECT *, string_split(norm, ' ') AS ws FROM c)),
t AS (SELECT k, first, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (SELECT a.k AS x, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS common
      FROM t a JOIN t b ON a.g = b.g AND b.first < a.first GROUP BY a.k, b.k),
gone AS (SELECT DISTINCT x FROM p WHERE common * 9 >= (nx + ny) * 4),
kept AS (SELECT first.d AS doc_id, first.i AS i FROM c WHERE k NOT IN (SELECT x FROM gone)),
f AS (SELECT l.doc_id, l.i, l.line, len(ws) = 0 OR kept.i IS NOT NULL AS stays FROM l LEFT JOIN kept ON l.doc_id = kept.doc_id AND l.i = kept.i)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS text_sha256
FROM f GROUP BY doc_id
"""

OP9 = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id, vec_id AS t FROM embeddings UNION SELECT reach.vec_id, l.b FROM reach JOIN l ON l.a = reach.t)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links, m.c AS component_id, e.vec_id = m.c AS kept
FROM embeddings e JOIN (SELECT vec_id, min(t) AS c FROM reach GROUP BY vec_id) m USING (vec_id)
"""

def _quoted(text: object) -> str:
    return "'" + str(text).replace("'", "''") + "'"


# every word between two spaces of its own, so that neighbouring matches share none
_RULES = ", ".join(
    f"({i}, {tier}, {_quoted(label)}, {_quoted(' ' + body.replace(' ', '  ') + ' ')})" for i, (label, tier, _, body) in enumerate(R.standard_rules())
)

OP11 = f"""
WITH rules(rule, tier, label, rx) AS (VALUES {_RULES}),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
n AS (SELECT r, ' ' || array_to_string(ws, '  ') || ' ' AS t FROM d WHERE len(ws) > 0),
cut AS (SELECT r, rule, tier, label, regexp_extract_all(t, rx) AS ms, regexp_split_to_array(t, rx) AS gaps FROM n, rules WHERE regexp_matches(t, rx)),
lens AS (  -- words of a piece: half its spaces
  SELECT * REPLACE (list_transform(ms, lambda x: (len(x) - len(replace(x, ' ', ''))) // 2) AS ms,
                    list_transform(gaps, lambda x: (len(x) - len(replace(x, ' ', ''))) // 2) AS gaps) FROM cut),
hit AS (
  SELECT r, rule, tier, label, (list_sum(gaps[1:i]) + coalesce(list_sum(ms[1:i - 1]), 0))::BIGINT AS s,
    (list_sum(gaps[1:i]) + list_sum(ms[1:i]))::BIGINT AS e
  FROM lens, unnest(range(1, len(ms) + 1)) AS u(i)),
rated AS (
  SELECT *, rule < {R.N_BASE} AS base, NOT EXISTS (
    SELECT 1 FROM hit b WHERE b.r = a.r AND b.s <= a.s AND b.e >= a.e
      AND (b.tier < a.tier OR b.tier = a.tier AND (b.e - b.s > a.e - a.s OR b.e - b.s = a.e - a.s AND b.rule < a.rule))) AS kept
  FROM hit a),
per AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR kept) AS labels,
    count(*) FILTER (kept) AS n_detections,
    max(CASE tier WHEN 0 THEN {R.CONFIDENCE[0]}::DOUBLE WHEN 1 THEN {R.CONFIDENCE[1]} WHEN 2 THEN {R.CONFIDENCE[2]} ELSE {R.CONFIDENCE[3]} END) FILTER (base OR kept) AS score
  FROM rated GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(n_detections, 0) AS n_detections, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN per USING (r)
"""

OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT row_number() OVER () AS q, item_id, {_WORDS} AS ws FROM benchmark),
g AS (SELECT sum((len(ws) > 0)::BIGINT)::BIGINT AS N, sum(len(ws))::BIGINT AS L FROM d),
t AS (SELECT r, w, count(*) AS tf FROM (SELECT r, unnest(ws) AS w FROM d) GROUP BY r, w),
i AS (SELECT q, w, count(*) AS c FROM (SELECT q, unnest(ws) AS w FROM b) GROUP BY q, w),
f AS (SELECT w, floor(1000 * ln((2.0::DOUBLE * N + 2) / (2.0::DOUBLE * df + 1)))::BIGINT AS weight
      FROM (SELECT w, count(*) AS df FROM t GROUP BY w), g),
m AS (SELECT r, doc_id, 100 - 75 + ((75 * len(ws) * N) // L) AS m FROM d, g WHERE len(ws) > 0),
s AS (SELECT q, r, sum(c * weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM i JOIN f USING (w) JOIN t USING (w) JOIN m USING (r) GROUP BY q, r),
k AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id, r)::INTEGER AS rank FROM s JOIN m USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k JOIN b USING (q) WHERE rank <= 10
"""

ORACLE: dict[str, str] = {
    "op1_secret_ownership": OP1,
    "op3_seekable_warc": OP3,
    "op5_decontamination": OP5,
    "op6_line_dedup": OP6,
    "op9_pstable_embeddings": OP9,
    "op11_license_rules": OP11,
    "op13_dual_tree_search": OP13,
}
