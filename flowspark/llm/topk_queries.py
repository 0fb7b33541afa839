"""Query of the exact top-k search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .pivot_topk import top_k
from .registry import query

TOP_K_SQL = """
WITH x AS (
  SELECT vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM x q JOIN x c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, k::INTEGER AS rank, vec_id, score FROM r WHERE k <= 5
"""


@query("op6_top_k", TOP_K_SQL)
def pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, F.col("vec_id") % 50 == 0, 5)
