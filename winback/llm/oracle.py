"""DuckDB SQL for the rows of the registered queries that SQL can express."""

OP10 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
x AS (SELECT r, source, text, unnest(lines) AS line FROM d WHERE text IS NOT NULL),
y AS (SELECT r, source, text, trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM x),
pages AS (SELECT source, count(DISTINCT text) AS pages FROM d WHERE text IS NOT NULL GROUP BY source),
drops AS (
  SELECT y.source, y.line FROM y JOIN pages p ON y.source IS NOT DISTINCT FROM p.source
  WHERE y.line <> '' GROUP BY y.source, y.line, p.pages
  HAVING count(DISTINCT y.text) >= 5 AND p.pages >= 5 AND count(DISTINCT y.text) > 0.1 * p.pages),
z AS (
  SELECT d.r, i, lines[i] AS line, trim(lines[i], chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS bare, source
  FROM (SELECT r, source, lines, unnest(range(1, len(lines) + 1)) AS i FROM d WHERE text IS NOT NULL) d),
kept AS (
  SELECT z.r, count(*) FILTER (WHERE bare <> '') AS n_lines, count(k.line) AS n_dropped,
         coalesce(string_agg(z.line, chr(10) ORDER BY i) FILTER (WHERE k.line IS NULL), '') AS text
  FROM z LEFT JOIN drops k ON z.bare = k.line AND z.source IS NOT DISTINCT FROM k.source GROUP BY z.r)
SELECT d.doc_id, d.source, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
       CAST(length(k.text) AS BIGINT) AS n_chars_kept, sha256(k.text) AS kept_sha256
FROM d LEFT JOIN kept k USING (r)
"""

OP11 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
   AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3
"""

# h: CRC-32 of the decimal id, bit by bit; -1 stands for one shift
OP13 = """
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT c, CASE WHEN c % 100 = 0 THEN 0 ELSE xor(4294967295, list_reduce(
           flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: [ascii(s), -1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END,
           CAST(4294967295 AS BIGINT))) % 6 END AS h
  FROM (SELECT DISTINCT c FROM t)),
r AS (
  SELECT ids.c, 0 AS part, t.pos, t.role, t.text FROM ids JOIN t ON t.c = ids.c - ids.c % 100 AND t.pos <= ids.h
  UNION ALL
  SELECT ids.c, 1, t.pos, t.role, t.text FROM ids JOIN t ON t.c = ids.c AND t.pos > ids.h),
turns AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS depth, length(text) AS n,
         sha256(sha256(role) || sha256(text)) AS e FROM r),
paths AS (
  SELECT c, depth, n, sha256(string_agg(e, '') OVER (PARTITION BY c ORDER BY depth)) AS k FROM turns
  UNION ALL SELECT c, 0, 0, '' FROM ids),
ended AS (SELECT c, max(depth) AS size FROM paths GROUP BY c),
nodes AS (
  SELECT k, depth, min(c) AS c, count(*) AS n_convs, (count(*) - 1) * max(n) AS worth,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE size = depth), '')) AS ends
  FROM paths JOIN ended USING (c) GROUP BY k, depth),
up AS (SELECT n.k, p.k AS parent, m.c AS parent_c FROM nodes n JOIN paths p ON p.c = n.c AND p.depth = n.depth - 1
       JOIN nodes m ON m.k = p.k),
kids AS (SELECT parent AS k, count(*) AS n_children FROM up GROUP BY parent),
sums AS (
  SELECT p.k, sum(n.worth) AS saved, count(*) FILTER (WHERE kids.k IS NULL) AS leaves
  FROM nodes n JOIN paths p ON p.c = n.c AND p.depth <= n.depth LEFT JOIN kids ON kids.k = n.k GROUP BY p.k)
SELECT n.c AS conv_id, CAST(n.depth AS BIGINT) AS depth, up.parent_c AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0) AS n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends AS ends_sha256
FROM nodes n JOIN sums USING (k) LEFT JOIN up USING (k) LEFT JOIN kids USING (k)
"""
