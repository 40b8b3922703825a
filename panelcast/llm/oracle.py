"""DuckDB twins of the text queries that SQL can express on whole tables."""

from __future__ import annotations

_WORD9 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD10 = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {}

ORACLE["op9_decontamination"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_WORD9}') AS w FROM documents),
b AS (SELECT DISTINCT item_id, regexp_extract_all({_LOWER}, '{_WORD9}') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, len(w) AS n0, least(len(w), 13) AS n, array_to_string(w[i + 1 : i + least(len(w), 13)], ' ') AS g
  FROM b, unnest(range(len(w) - least(len(w), 13) + 1)) AS u(i) WHERE len(w) > 0),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, n, i, array_to_string(w[i + 1 : i + n], ' ') AS g FROM d, ns, unnest(range(len(w) - n + 1)) AS u(i) WHERE len(w) >= n),
m AS (SELECT r, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
h AS (SELECT r, count(DISTINCT i + j) AS n_hit FROM m, unnest(range(n)) AS u(j) GROUP BY r),
t AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM m WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""

ORACLE["op10_minhash"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD10}') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + least(len(w), 5)], ' ') AS g
  FROM d, unnest(range(len(w) - least(len(w), 5) + 1)) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (
  SELECT doc_id, g, row_number() OVER (PARTITION BY doc_id ORDER BY c, g) AS p
  FROM s JOIN (SELECT g, count(*) AS c FROM s GROUP BY g) USING (g)),
pre AS (SELECT o.doc_id, g, n FROM o JOIN n USING (doc_id) WHERE p <= n - (85 * n + 99) // 100 + 1),
cand AS (
  SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM pre x JOIN pre y USING (g)
  WHERE x.doc_id < y.doc_id AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)),
ov AS (
  SELECT a, b, count(*) AS i FROM cand JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b AND y.g = x.g GROUP BY a, b),
link AS (SELECT a, b FROM ov JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 85 * (na.n + nb.n - i)),
e AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(x, y) AS (SELECT a, b FROM e UNION SELECT x, e.b FROM reach JOIN e ON reach.y = e.a),
c AS (SELECT x AS doc_id, least(x, min(y)) AS c FROM reach GROUP BY x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(c, doc_id) AS component_id, doc_id = coalesce(c, doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

ORACLE["op6_url_filter"] = r"""
WITH p AS (
  SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN regexp_extract(url, '^(?s:.*?)://([^?#]*)', 1) END, '') AS rest
  FROM pages),
h AS (
  SELECT page_id, translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    substr(rest, length(split_part(rest, '/', 1)) + 1) AS path FROM p),
r(rule, rhost, rpath, v) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
m AS (
  SELECT page_id, host, path, max_by(rule, length(rule)) AS rule, max_by(v, length(rule)) AS v
  FROM h LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m
"""

ORACLE["op11_exact_dedup"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS n FROM d GROUP BY t)
SELECT doc_id, keep_id, n AS group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR) END"
_LEAF = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n_chars}", "text"))

ORACLE["op13_merkle_manifest"] = f"""
WITH RECURSIVE bytes AS (
  SELECT doc_id, list_transform(range(strlen(CAST(doc_id AS VARCHAR))),
    lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i + 1, 1)) AS BIGINT)) AS b FROM documents),
crc AS (
  SELECT doc_id, xor(list_reduce(b, lambda c, x: list_reduce(range(8), lambda v, k:
    xor(v // 2, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END), xor(c, x)), 4294967295), 4294967295) AS crc FROM bytes),
leaf AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, sha256({_LEAF.format(n_chars="n_chars")}) AS leaf,
    CASE WHEN crc % 7 = 0 THEN sha256({_LEAF.format(n_chars="(n_chars + 1)")}) ELSE sha256({_LEAF.format(n_chars="n_chars")}) END AS held,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS p, count(*) OVER (PARTITION BY lang) AS n
  FROM documents JOIN crc USING (doc_id)),
node(g, l, p, n, h) AS (
  SELECT g, 0, p, n, leaf FROM leaf
  UNION ALL
  SELECT g, l + 1, p // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY p)) FROM node WHERE n > 1 GROUP BY g, l, p // 2, n),
sub AS (
  SELECT g, l AS height, h, row_number() OVER (ORDER BY g) - 1 AS p, count(*) OVER () AS n FROM node WHERE n = 1),
top(l, p, n, h) AS (
  SELECT 0, p, n, h FROM sub
  UNION ALL
  SELECT l + 1, p // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY p)) FROM top WHERE n > 1 GROUP BY l, p // 2, n),
step AS (
  SELECT a.g, a.l, a.p, coalesce(b.h, '') AS s FROM node a LEFT JOIN node b ON a.g = b.g AND a.l = b.l AND b.p = xor(a.p, 1)
  WHERE a.n > 1),
top_step AS (SELECT a.l, a.p, coalesce(b.h, '') AS s FROM top a LEFT JOIN top b ON a.l = b.l AND b.p = xor(a.p, 1) WHERE a.n > 1),
way AS (
  SELECT doc_id, k, q, s FROM (
    SELECT d.doc_id, s.l AS k, s.p AS q, s.s FROM leaf d JOIN step s ON s.g = d.g AND s.p = d.p >> s.l
    UNION ALL
    SELECT d.doc_id, sub.height + s.l, s.p, s.s FROM leaf d JOIN sub ON sub.g = d.g JOIN top_step s ON s.p = sub.p >> s.l)),
climb(doc_id, k, h) AS (
  SELECT doc_id, 0, held FROM leaf
  UNION ALL
  SELECT c.doc_id, c.k + 1, sha256(CASE WHEN w.q % 2 = 1 THEN w.s || c.h ELSE c.h || w.s END)
  FROM climb c JOIN way w ON w.doc_id = c.doc_id AND w.k = c.k)
SELECT d.doc_id, d.leaf, sub.h AS subroot, r.h AS root, sha256(coalesce(pr.s, '')) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM leaf d JOIN sub ON sub.g = d.g CROSS JOIN (SELECT h FROM top WHERE n = 1) r
LEFT JOIN (SELECT doc_id, string_agg(s, '' ORDER BY k) AS s FROM way GROUP BY doc_id) pr USING (doc_id)
JOIN (SELECT doc_id, arg_max(h, k) AS h FROM climb GROUP BY doc_id) f USING (doc_id)
"""
