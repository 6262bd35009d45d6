"""The deduplication queries in the SQL of the checking database, by plain comparison of everything with everything."""

from __future__ import annotations

from fleetmart.llm.words import WORD

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: (node, component) from both directions of the links, which a CTE ``both_ways (x, y)`` gives.
_REACH = """reach(id, r) AS (
  SELECT id, id FROM nodes
  UNION
  SELECT reach.id, b.y FROM reach JOIN both_ways b ON b.x = reach.r
),
components AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)"""

OP7 = f"""
WITH RECURSIVE nodes AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings),
links AS (
  SELECT a.id AS x, b.id AS y FROM nodes a JOIN nodes b ON a.label = b.label AND a.id < b.id AND len(a.v) = len(b.v)
  WHERE isfinite(list_cosine_similarity(a.v, b.v)) AND list_cosine_similarity(a.v, b.v) >= 0.98
),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
degree AS (SELECT x AS id, count(*) AS n FROM both_ways GROUP BY x),
{_REACH}
SELECT c.id AS vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.component_id, c.id = c.component_id AS kept FROM components c LEFT JOIN degree d USING (id)
"""

OP8 = f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '{WORD}') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p:p + 3], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS p FROM words WHERE len(ws) > 0)
),
nodes AS (SELECT w.doc_id AS id, count(s.s)::BIGINT AS n FROM words w LEFT JOIN shingles s USING (doc_id) GROUP BY w.doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN nodes a ON a.id = x JOIN nodes b ON b.id = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
{_REACH}
SELECT n.id AS doc_id, n.n AS n_shingles, c.component_id, n.id = c.component_id AS kept FROM nodes n JOIN components c USING (id)
"""

OP10 = f"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
windows AS (
  SELECT doc_id, p, md5(array_to_string(ws[p:p + 49], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM words WHERE len(ws) >= 50)
),
earliest AS (SELECT h, min(doc_id) AS d FROM windows GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS q FROM windows JOIN earliest USING (h) WHERE doc_id > d),
placed AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS q FROM words),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY q) AS t, count(*) AS n FROM placed ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM words w LEFT JOIN kept USING (doc_id)
"""

OP11 = """
WITH lines AS (
  SELECT doc_id, line, p, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS p FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
),
repeated AS (SELECT key FROM (SELECT DISTINCT doc_id, key FROM lines WHERE length(key) >= 1) GROUP BY key HAVING count(*) >= 10),
marked AS (SELECT l.*, r.key IS NOT NULL AS gone FROM lines l LEFT JOIN repeated r ON r.key = l.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP12 = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(ws[p:p + k - 1], ' ') AS g FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM words, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k)
),
f AS (SELECT lang, k, g, count(*) AS a FROM grams GROUP BY lang, k, g HAVING count(*) >= 30),
cuts AS (
  SELECT c.lang, c.g, c.a, c.k, cut, x.a AS l, y.a AS r, (2000000 * c.a::HUGEINT) // (x.a + y.a) AS score
  FROM (SELECT *, string_split(g, ' ') AS ws, unnest(range(1, k)) AS cut FROM f WHERE k > 1) c
  JOIN f x ON x.lang = c.lang AND x.g = array_to_string(ws[1:cut], ' ') JOIN f y ON y.lang = c.lang AND y.g = array_to_string(ws[cut + 1:], ' ')
),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, array_to_string(ws[p:p + m - 1], ' ') AS g, max(a) AS longer
  FROM (SELECT lang, a, string_split(g, ' ') AS ws, m, unnest(range(1, k - m + 2)) AS p FROM f, (SELECT unnest([2, 3]) AS m) WHERE m < k) GROUP BY 1, 2
),
ranked AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.g) AS rank, b.g AS phrase, a, l, r, score::BIGINT AS score
  FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.g = b.g WHERE i.longer IS NULL OR 100 * i.longer < 80 * b.a
)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
