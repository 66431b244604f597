"""DuckDB oracles of the llm queries that SQL can express."""

from wareloom.llm.license_scan import COVER, GAP, K, PHRASES, TEMPLATES
from wareloom.llm.url_filters import PAGE_RULES

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in PAGE_RULES)

OP1 = f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES}),
parts AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
judged AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS rid FROM parts),
fits AS (
  SELECT rid, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY rid ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC, rule_host || rule_path) AS pos
  FROM judged JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM judged LEFT JOIN (SELECT * FROM fits WHERE pos = 1) USING (rid)
"""

OP8 = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('mix' || coalesce(doc_id::VARCHAR, 'null')) AS key FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 1.0 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source),
caps AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap, sum(source_size) OVER () AS budget,
         row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST) AS pos FROM sources),
levels AS (
  SELECT *, (budget::DOUBLE - coalesce(sum(cap) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight::DOUBLE) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM caps),
targets AS (
  SELECT source, source_size, budget, least(cap, coalesce((SELECT l.lvl FROM levels l WHERE l.lvl * l.weight::DOUBLE <= l.cap ORDER BY l.pos LIMIT 1)
         * weight::DOUBLE, cap)) AS target FROM levels),
queued AS (
  SELECT s.*, t.source_size, t.target, t.budget, row_number() OVER () AS rid,
         sum(size) OVER (PARTITION BY s.source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS until
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT rid, source, size, key, budget, e, (e::DOUBLE * source_size + until) / target AS finish
  FROM queued, range(3) r(e) WHERE size > 0 AND target > 0),
runs AS (
  SELECT rid, size, budget, sum(size) OVER (ORDER BY finish, source NULLS LAST, key, size, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM copies)
SELECT doc_id, size::BIGINT AS size, source_size, target::DOUBLE AS target, coalesce(t.taken, 0)::BIGINT AS taken
FROM queued LEFT JOIN (SELECT rid, sum(size) AS taken FROM runs WHERE run <= budget GROUP BY rid) t USING (rid)
"""

OP6 = r"""
WITH numbered AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines, row_number() OVER () AS rid FROM documents),
lines AS (
  SELECT rid, doc_id, i, lines[i] AS line,
         translate(regexp_replace(lines[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT rid, doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM numbered)),
owners AS (SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (SELECT rid, l.doc_id, i, line, owner IS NOT NULL AND owner <> l.doc_id AS dropped FROM lines l LEFT JOIN owners USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY rid
"""

OP9 = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
digests AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM payloads),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM digests)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM firsts
"""

OP3 = r"""
WITH doc AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, m, array_to_string(w[i : i + m - 1], ' ') AS words
  FROM (SELECT item, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
doc_windows AS (
  SELECT rid, m, i, array_to_string(w[i : i + m - 1], ' ') AS words
  FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM doc, (SELECT DISTINCT m FROM item_windows) WHERE len(w) >= m)),
matched AS (SELECT rid, i, d.m, item FROM doc_windows d JOIN item_windows USING (m, words)),
hits AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(i, i + m)) AS p FROM matched) GROUP BY rid),
names AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM matched) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hits USING (rid) LEFT JOIN names USING (rid)
"""

# one vertex per word sequence; pairs meet on a shared shingle, links by full sets, components by label walking
OP4 = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, array_to_string(w, ' ') AS words,
         list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
              ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) END) AS s FROM split),
vertices AS (SELECT min(doc_id) AS node, any_value(s) AS s, words FROM sets WHERE len(s) > 0 GROUP BY words),
shared AS (
  SELECT a.node AS a, b.node AS b, count(*) AS n_both
  FROM (SELECT node, unnest(s) AS g FROM vertices) a JOIN (SELECT node, unnest(s) AS g FROM vertices) b ON a.g = b.g AND a.node < b.node GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN vertices x ON x.node = a JOIN vertices y ON y.node = b WHERE 100 * n_both >= 80 * (len(x.s) + len(y.s) - n_both)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, other) AS (SELECT node, node FROM vertices UNION SELECT r.node, l.b FROM reach r JOIN both_ways l ON l.a = r.other),
groups AS (SELECT node, min(other) AS component FROM reach GROUP BY node)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(component, s.doc_id) AS component_id, s.doc_id = coalesce(component, s.doc_id) AS kept
FROM sets s LEFT JOIN vertices v ON s.words = v.words LEFT JOIN groups g ON g.node = v.node
"""

OP5 = """
WITH RECURSIVE usable AS (
  SELECT row_number() OVER () AS rid, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
good AS (
  SELECT * FROM usable WHERE vec_id IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_sum(list_transform(e, lambda x: abs(x))) > 0),
links AS (
  SELECT a.rid AS a, b.rid AS b, a.vec_id AS ia, b.vec_id AS ib
  FROM good a JOIN good b ON a.rid <> b.rid AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(rid, other) AS (SELECT rid, rid FROM good UNION SELECT r.rid, l.b FROM reach r JOIN links l ON l.a = r.other),
groups AS (SELECT r.rid, min(g.vec_id) AS component_id FROM reach r JOIN good g ON g.rid = r.other GROUP BY r.rid),
counts AS (SELECT a AS rid, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(vec_id = coalesce(component_id, vec_id), true) AS kept
FROM usable LEFT JOIN groups USING (rid) LEFT JOIN counts USING (rid)
"""

_TEXTS = [(label, text, "false") for label, text in TEMPLATES] + [(label, text, "true") for text, label in PHRASES]
_TEMPLATES = ", ".join(f"({i}, '{label}', '{text}', {phrase})" for i, (label, text, phrase) in enumerate(_TEXTS))

OP12 = rf"""
WITH given(template, label, text, phrase) AS (VALUES {_TEMPLATES}),
known AS (
  SELECT template, label, phrase, w, len(w) AS length, CASE WHEN phrase THEN len(w) ELSE least(len(w), {K}) END AS k
  FROM (SELECT *, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM given)),
grams AS (
  SELECT template, label, phrase, length, k, i - 1 AS tpos, array_to_string(w[i : i + k - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, length - k + 2)) AS i FROM known)),
doc AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
doc_grams AS (
  SELECT rid, k, i - 1 AS pos, array_to_string(w[i : i + k - 1], ' ') AS gram
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, (SELECT DISTINCT k FROM grams) WHERE len(w) >= k)),
votes AS (SELECT * FROM doc_grams JOIN grams USING (k, gram)),
base AS (
  SELECT rid, count(*) AS n_base, min(pos)::BIGINT AS first_word, max(pos)::BIGINT AS last_word FROM votes WHERE phrase GROUP BY rid),
diagonals AS (SELECT DISTINCT rid, template, pos - tpos AS diagonal FROM votes WHERE NOT phrase),
apart AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal) > {GAP} THEN 1 ELSE 0 END AS new FROM diagonals),
bands AS (SELECT *, sum(new) OVER (PARTITION BY rid, template ORDER BY diagonal) AS band FROM apart),
covers AS (
  SELECT DISTINCT v.rid, template, band, label, length, unnest(range(tpos, tpos + k)) AS word
  FROM votes v JOIN bands b USING (rid, template) WHERE b.diagonal = pos - tpos),
spans AS (SELECT rid, template, band, label, length, count(*) AS covered FROM covers GROUP BY ALL),
found AS (SELECT rid, max(covered::DOUBLE / length::DOUBLE) AS share FROM spans GROUP BY rid),
every AS (
  SELECT DISTINCT rid, label, true AS own FROM votes WHERE phrase
  UNION ALL SELECT DISTINCT rid, label, false FROM spans WHERE covered * 100 >= length * {COVER}),
names AS (
  SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE own) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM every GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM doc LEFT JOIN base USING (rid) LEFT JOIN found USING (rid) LEFT JOIN names USING (rid)
"""

OP13 = """
WITH ints AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, b.rid, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM ints a JOIN ints b ON a.vec_id % 100 = 0 AND a.rid <> b.rid),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, rid) AS pos FROM scores WHERE same QUALIFY pos <= 5),
windows AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.rid ORDER BY s.score DESC, s.id, s.rid) AS rank
  FROM positives p JOIN scores s ON p.anchor = s.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM windows WHERE rank <= 5
"""
