"""SQL forms of the operators that SQL can express exactly: the links by comparing all rows, then reachability."""

REACH = """reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)"""

NEAR_DOCUMENTS = f"""WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
{REACH},
least_id AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
found AS (SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.y, d.doc_id)) AS component_id
  FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_id l ON l.x = d.doc_id)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM found"""

NEAR_VECTORS = f"""WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS e FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS size FROM v),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.93),
{REACH},
least_id AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n FROM links GROUP BY x),
found AS (SELECT m.vec_id, coalesce(n.n, 0) AS n_links, least(m.vec_id, coalesce(l.y, m.vec_id)) AS component_id
  FROM embeddings m LEFT JOIN n ON n.x = m.vec_id LEFT JOIN least_id l ON l.x = m.vec_id)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM found"""

FILTER_AUDIT = """WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x FROM documents),
w AS (SELECT doc_id, part, x, list_filter(string_split_regex(x, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM t),
firsts AS (SELECT x, min(doc_id) AS lo FROM t GROUP BY x),
marks AS (SELECT doc_id, coalesce(max(CASE WHEN quality = 1 THEN 1 ELSE 0 END), 0) AS good, coalesce(max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END), 0) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    len(ws) < 50 AS a, 100 * len(list_distinct(ws)) < 65 * len(ws) AS b, 100 * length(regexp_replace(w.x, '[^A-Z]', '', 'g')) > 5 * length(w.x) AS c,
    regexp_matches(w.x, '[#$%&*|]') AS d, coalesce(w.doc_id > lo, false) AS e
  FROM w JOIN firsts ON firsts.x = w.x LEFT JOIN marks ON marks.doc_id = w.doc_id),
cells AS (SELECT part, CASE WHEN a THEN 1 ELSE 0 END + CASE WHEN b THEN 2 ELSE 0 END + CASE WHEN c THEN 4 ELSE 0 END + CASE WHEN d THEN 8 ELSE 0 END + CASE WHEN e THEN 16 ELSE 0 END AS p,
    count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, p),
letters(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
steps AS (SELECT filter_order, step, bits[step] AS bit, list_sum(list_concat([0], bits[1:step - 1])) AS before FROM orders, range(1, 6) AS s(step)),
parts AS (SELECT DISTINCT part FROM cells),
told AS (SELECT p.part, s.filter_order, s.step, s.bit, CAST(s.before AS INTEGER) AS before, c.p, c.n, c.good, c.toxic, c.p & s.bit <> 0 AS fails, c.p & CAST(s.before AS INTEGER) = 0 AS present
  FROM parts p JOIN cells c ON c.part = p.part, steps s)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
  CAST(sum(CASE WHEN present AND NOT fails THEN n ELSE 0 END) AS BIGINT) AS kept, CAST(sum(CASE WHEN present AND fails THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN fails AND NOT present THEN n ELSE 0 END) AS BIGINT) AS redundant, CAST(sum(CASE WHEN p = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN present AND fails THEN good ELSE 0 END) AS BIGINT) AS good_lost, CAST(sum(CASE WHEN present AND fails THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
  CAST(sum(CASE WHEN fails THEN n * 120 // bit_count(p) ELSE 0 END) AS BIGINT) AS shapley
FROM told GROUP BY part, filter_order, step"""
