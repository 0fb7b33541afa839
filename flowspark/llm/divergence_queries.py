"""Query of the source divergence audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .divergence import divergences
from .registry import query

DIVERGENCE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS n, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents
),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (
  SELECT n, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d
),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT n) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN k USING (lang, term) GROUP BY ALL),
cl AS (SELECT lang, term, sum(c) AS c FROM c GROUP BY ALL),
ns AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
nl AS (SELECT lang, sum(c) AS n FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 5)) // (coalesce(ns.n, 0) + 5 * v.v) AS p
  FROM g JOIN k USING (lang) JOIN v USING (lang)
    LEFT JOIN ns ON ns.lang = g.lang AND ns.source = g.source
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (cl.c + 5)) // (nl.n + 5 * v.v) AS q
  FROM cl JOIN nl USING (lang) JOIN v USING (lang)),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value
      FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) s
    ON s.lang = a.lang AND s.source = a.source AND s.other = b.source
),
term AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, (p.p - q.q)::BIGINT AS value
  FROM p JOIN q USING (lang, term) WHERE p.c > 0 AND p.p > q.q
),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50
"""


@query("op13_source_divergence", DIVERGENCE_SQL)
def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(table(spark, sf_dir, "documents"))
