"""SQL for the join, search and trie operators."""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

TRIE = """WITH RECURSIVE steps AS (
  SELECT i, 0 AS step, i AS v FROM range(0, 256) r(i) UNION ALL
  SELECT i, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE step < 8),
bytes AS MATERIALIZED (SELECT i, v FROM steps WHERE step = 8),
turns AS MATERIALIZED (SELECT conv_id AS c, md5(length(r) || ':' || r || t) AS g, length(t) AS chars, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(r) || ':' || r || t)) - 1 AS p
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations)),
crc AS (SELECT DISTINCT c, 0 AS i, 4294967295::BIGINT AS v FROM turns UNION ALL
  SELECT c, crc.i + 1, xor(crc.v >> 8, bytes.v) FROM crc JOIN bytes
    ON bytes.i = xor(crc.v & 255, ord(substring(c::VARCHAR, crc.i + 1, 1))) WHERE crc.i < length(c::VARCHAR)),
convs AS MATERIALIZED (SELECT c, xor(v, 4294967295) % 6 AS h FROM crc WHERE i = length(c::VARCHAR)),
parts AS (SELECT c.c, 0 AS part, p, g, chars FROM convs c JOIN turns t ON t.c = c.c - c.c % 100 AND p < h
  UNION ALL SELECT c.c, 1, p, g, chars FROM convs c JOIN turns t ON t.c = c.c AND p >= h),
rebuilt AS MATERIALIZED (SELECT convs.c, coalesce(list(g ORDER BY part, p) FILTER (g IS NOT NULL), []) AS gs,
    coalesce(list(chars ORDER BY part, p) FILTER (g IS NOT NULL), []) AS ns
  FROM convs LEFT JOIN parts USING (c) GROUP BY convs.c),
paths AS MATERIALIZED (SELECT c, d, gs[1:d] AS key, CASE WHEN d > 0 THEN ns[d] ELSE 0 END AS chars, d = len(gs) AS last
  FROM (SELECT *, unnest(range(0, len(gs) + 1)) AS d FROM rebuilt)),
nodes AS MATERIALIZED (SELECT key, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS own,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256 FROM paths GROUP BY key, d),
children AS MATERIALIZED (SELECT key[1:d - 1] AS key, count(*) AS n FROM nodes WHERE d > 0 GROUP BY key[1:d - 1]),
below AS (SELECT key[1:a] AS top, own, key NOT IN (SELECT key FROM children) AS leaf
  FROM (SELECT key, own, unnest(range(0, d + 1)) AS a FROM nodes)),
totals AS (SELECT top, count(*) FILTER (leaf) AS n_leaves, sum(own) AS saved FROM below GROUP BY top)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
  t.n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t ON t.top = n.key LEFT JOIN children c ON c.key = n.key
  LEFT JOIN nodes p ON n.d > 0 AND p.key = n.key[1:n.d - 1]"""

JOIN = rf"""WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
grams AS MATERIALIZED (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM words WHERE len(ws) >= 5)
  UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM words WHERE len(ws) BETWEEN 1 AND 4)),
sizes AS MATERIALIZED (SELECT w.doc_id, count(g) AS n FROM words w LEFT JOIN grams USING (doc_id) GROUP BY w.doc_id),
edges AS MATERIALIZED (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) shared
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * shared.n >= 80 * (p.n + q.n - shared.n)),
reached AS (SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, e.b FROM reached r JOIN edges e ON e.a = r.b)
SELECT doc_id, n AS n_shingles, min(b) AS component_id FROM sizes JOIN reached ON a = doc_id GROUP BY doc_id, n"""

SEARCH = rf"""WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({LOWER}, '{TERM}') AS ts FROM documents),
corpus AS (SELECT count(*) FILTER (len(ts) > 0) AS n, CAST(sum(len(ts)) AS BIGINT) AS l FROM d),
tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM d) GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), corpus),
asked AS (SELECT item_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) AS term FROM benchmark),
long AS (SELECT doc_id, 100 - 75 + (75 * len(ts) * n) // l AS m FROM d, corpus WHERE len(ts) > 0),
scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN long USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (
  PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM scored WHERE score > 0) WHERE r <= 10"""

SQL = {"op11_ngram_join": JOIN, "op12_lexical_search": SEARCH, "op13_conversation_trie": TRIE}
