"""DuckDB SQL for the operators that SQL can express, over whole tables.

Token files and token alignment (tokenizers libraries), repeated bytes (windows
of bytes), the trained classifier and the pipeline have none; tests hold them
against plain versions.
"""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER.format('text')}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

_OP1 = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, unnest(CASE WHEN len(w) <= 10 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' ')) END) AS g
  FROM items WHERE len(w) > 0),
docs AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
widths AS (SELECT DISTINCT k FROM win),
starts AS (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM docs, widths WHERE len(w) >= k),
hits AS (SELECT doc_id, i, starts.k, item_id FROM starts JOIN win ON win.k = starts.k AND win.g = array_to_string(w[i:i + starts.k - 1], ' ')),
words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM (SELECT DISTINCT doc_id, i, k FROM hits)) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, {5 * part + 1}, 5))::BIGINT) >> {shift}) & 31)::INT + 1, 1)"
    for part in range(8)
    for shift in (15, 10, 5, 0)
)

_OP3 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
first AS (SELECT payload, max(page_id) AS response FROM p GROUP BY payload)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM p JOIN first USING (payload)
"""

_OP4 = """
WITH counted AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\r\\n]+')) AS t, floor(doc_id / 64)::BIGINT AS block FROM documents),
totals AS (SELECT source, sum(t)::DOUBLE AS tokens FROM counted GROUP BY source),
ends AS (SELECT sum(tokens) AS total, max(tokens) / min(tokens) AS spread FROM totals WHERE tokens > 0),
power AS (SELECT total, CASE WHEN spread <= 2 THEN 0.0 ELSE 1 - ln(2) / ln(spread) END AS e FROM ends),
raised AS (SELECT source, tokens, pow(tokens / total, e) AS r FROM totals, power WHERE tokens > 0),
bounds AS (SELECT sum(r) AS norm, min(r / tokens) AS least FROM raised),
plan AS (
  SELECT totals.source, totals.tokens, coalesce(r / norm, 0) AS weight, coalesce(floor(r / norm * (norm / least) + 1e-6), 0)::BIGINT AS budget
  FROM totals LEFT JOIN raised ON totals.source IS NOT DISTINCT FROM raised.source, bounds),
parts AS (SELECT source, weight, CASE WHEN tokens > 0 THEN floor(budget / tokens)::BIGINT ELSE 1 END AS passes,
  CASE WHEN tokens > 0 THEN budget - floor(budget / tokens)::BIGINT * tokens::BIGINT ELSE 0 END AS rest FROM plan),
blocks AS (SELECT c.source, block, sum(t) AS t, any_value(passes) AS passes, any_value(rest) AS rest
  FROM counted c JOIN parts p ON c.source IS NOT DISTINCT FROM p.source GROUP BY c.source, block),
keyed AS (SELECT *, md5('mix|' || (passes + 1) || '|' || coalesce(source, '') || '|' || coalesce(block::VARCHAR, '')) AS key FROM blocks),
chosen AS (SELECT source, block FROM (
  SELECT *, coalesce(sum(t) OVER (PARTITION BY source ORDER BY key, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM keyed)
  WHERE start < rest),
copied AS (SELECT c.*, p.weight, p.passes + (h.source IS NOT NULL OR h.block IS NOT NULL)::INT AS copies
  FROM counted c JOIN parts p ON c.source IS NOT DISTINCT FROM p.source
  LEFT JOIN chosen h ON c.source IS NOT DISTINCT FROM h.source AND c.block IS NOT DISTINCT FROM h.block)
SELECT doc_id, source, t::BIGINT AS n_tokens, round(weight, 6) AS weight, epoch, block,
  md5('mix|' || epoch || '|' || coalesce(source, '') || '|' || coalesce(block::VARCHAR, '')) AS block_key
FROM (SELECT *, unnest(range(1, copies + 1)) AS epoch FROM copied)
"""

_REACH = """
sides AS (SELECT a AS id, b AS other FROM links UNION SELECT b, a FROM links),
reach(id, other) AS (SELECT id, other FROM sides UNION SELECT r.id, b.other FROM reach r JOIN sides b ON r.other = b.id),
least AS (SELECT id, min(other) AS low FROM reach GROUP BY id)
"""

_OP5 = f"""
WITH RECURSIVE fit AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM fit x JOIN fit y
  ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.98),
{_REACH},
counts AS (SELECT id, count(*) AS n FROM sides GROUP BY id)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN counts ON counts.id = vec_id LEFT JOIN least ON least.id = vec_id
"""

_MARKED = "replace(replace({}, '<|im_start|>', '<| im_start |>'), '<|im_end|>', '<| im_end |>')"

_OP7 = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST, role, text) AS l FROM t GROUP BY conv_id),
u AS (SELECT min(conv_id) AS conv_id, l FROM c GROUP BY l),
kept AS (SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM c WHERE len(c.l) > len(u.l) AND c.l[1:len(u.l)] = u.l))
SELECT conv_id, len(l)::BIGINT AS turns, segment::BIGINT AS segment,
  array_to_string(list_transform(l[segment * 32 + 1:segment * 32 + 32],
    lambda x: '<|im_start|>' || {_MARKED.format('x.role')} || chr(10) || {_MARKED.format('x.text')} || '<|im_end|>' || chr(10)), '') AS text
FROM (SELECT *, unnest(range(0, ((len(l) + 31) // 32)::BIGINT)) AS segment FROM kept)
"""

_OP8 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS s FROM sets x JOIN sets y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * s >= 80 * (p.n + q.n - s)),
{_REACH}
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id, doc_id <= coalesce(low, doc_id) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON least.id = doc_id
"""

_OP9 = """
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(range(0, len(l))) AS line_no, unnest(l) AS line FROM parts),
sets AS (SELECT doc_id, line_no, list_sort(list_distinct(list_filter(regexp_split_to_array(line, '[ \\t\\r]+'), lambda t: t <> ''))) AS s FROM lines),
firsts AS (SELECT s, min((doc_id, line_no)) AS place, row_number() OVER () AS number FROM sets WHERE len(s) > 0 GROUP BY s),
tokens AS (SELECT number, unnest(s) AS token, len(s) AS n FROM firsts),
common AS (SELECT token, count(*) AS df FROM tokens GROUP BY token),
ranked AS (SELECT number, token, n, row_number() OVER (PARTITION BY number ORDER BY df, token) AS pos FROM tokens JOIN common USING (token)),
heads AS (SELECT * FROM ranked WHERE pos <= n - ceil(n * 80 / 100.0) + 1),
pairs AS (SELECT DISTINCT x.number AS a, y.number AS b FROM heads x JOIN heads y ON x.token = y.token AND x.number < y.number
  AND x.n * 100 >= y.n * 80 AND y.n * 100 >= x.n * 80),
alike AS (SELECT x.number AS a, y.number AS b, x.place AS p, y.place AS q FROM pairs JOIN firsts x ON x.number = a JOIN firsts y ON y.number = b
  WHERE len(list_intersect(x.s, y.s)) * 100 >= 80 * (len(x.s) + len(y.s) - len(list_intersect(x.s, y.s)))),
later AS (SELECT DISTINCT CASE WHEN p < q THEN b ELSE a END AS number FROM alike)
SELECT doc_id, line_no::BIGINT AS line_no, coalesce((doc_id, line_no) <> place, false) OR later.number IS NOT NULL AS removed
FROM sets LEFT JOIN firsts USING (s) LEFT JOIN later ON later.number = firsts.number
"""

_OP11 = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
  FROM r a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

_OP13 = """
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
p AS (SELECT row_number() OVER () AS n, page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
best AS (SELECT n, arg_max(r.host || r.path, len(r.host || r.path)) AS rule, arg_max(verdict, len(r.host || r.path)) AS verdict
  FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN best USING (n)
"""

ORACLES: dict[str, str] = {
    "op1_benchmark_decontamination": _OP1,
    "op3_warc_archive": _OP3,
    "op4_temperature_mixing": _OP4,
    "op5_cover_tree_pairs": _OP5,
    "op7_chat_snapshots": _OP7,
    "op8_minmax_near_duplicates": _OP8,
    "op9_line_similarity": _OP9,
    "op11_hard_negatives": _OP11,
    "op13_url_rules": _OP13,
}
