"""Query of the near-duplicate search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .near_dup import near_duplicates
from .registry import query

#: Shingle sets of distinct word sequences, links by exact counts, components by the smallest id in reach.
NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
),
s AS (
  SELECT doc_id, ws, CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh
  FROM w
),
c AS (SELECT min(doc_id) AS rid, any_value(sh) AS sh, any_value(len(sh)) AS n FROM s WHERE len(ws) > 0 GROUP BY ws),
e AS (SELECT rid, n, unnest(sh) AS g FROM c),
p AS (
  SELECT a.rid AS a, b.rid AS b, count(*) AS common, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM e a JOIN e b ON a.g = b.g AND a.rid < b.rid GROUP BY a.rid, b.rid
),
l AS (SELECT a, b FROM p WHERE 100 * common >= 85 * (na + nb - common)),
d AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT rid AS node, rid AS seen FROM c UNION SELECT r.node, d.b FROM r JOIN d ON r.seen = d.a),
m AS (SELECT node, min(seen) AS component FROM r GROUP BY node)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, coalesce(m.component, s.doc_id) AS component_id,
  coalesce(m.component, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN (SELECT ws, min(doc_id) AS rid FROM s WHERE len(ws) > 0 GROUP BY ws) k ON s.ws = k.ws
LEFT JOIN m ON m.node = k.rid
"""


@query("op10_near_duplicates", NEAR_SQL)
def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), num=85, den=100)
