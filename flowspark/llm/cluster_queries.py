"""Query of the centroid clustering."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table
from .hadamard_kmeans import cluster
from .registry import query

ROUNDS = 10


def _clusters_sql() -> str:
    """One assignment and one update of the centroids per round, as materialised steps."""
    steps = ["""k AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
)""", """c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h) - 1)::INTEGER AS c, v
  FROM (SELECT sha256('3:' || vec_id) AS h, v FROM k ORDER BY h LIMIT 8)
)"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT n, vec_id, v, m.c AS c, m.d AS d FROM (
    SELECT k.n, any_value(k.vec_id) AS vec_id, any_value(k.v) AS v, min({{'d': list_sum(list_transform(
      list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT, 'c': c.c}}) AS m
    FROM k, c{i} c GROUP BY k.n)
)""")
        if i < ROUNDS:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS v
  FROM (SELECT c, j, sum(x) AS s, count(*)::HUGEINT AS n
    FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{i}) GROUP BY c, j)
  GROUP BY c UNION ALL SELECT c, v FROM c{i} WHERE c NOT IN (SELECT c FROM a{i})
)""")
    return f"""WITH {", ".join(steps)}
SELECT a.vec_id, a.c AS cluster, a.d::BIGINT AS distance, sum(a.d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
  sum(a.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c USING (c)"""


CLUSTERS_SQL = _clusters_sql()


@query("op12_centroid_clusters", CLUSTERS_SQL)
def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster(table(spark, sf_dir, "embeddings"), rounds=ROUNDS)
    found = stored(found, "kmeans-clusters")
    every = F.count("distance") == F.count(F.lit(1))
    sums = found.groupBy("cluster").agg(F.when(every, F.sum(F.col("distance").cast("decimal(38,0)"))).alias("s")).collect()
    whole = None if any(r["s"] is None for r in sums) else sum(int(r["s"]) for r in sums)
    fits = lambda x: None if x is None or x >= 1 << 63 else int(x)
    digests = {c: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for c, v in enumerate(centroids)}
    rows = [(r["cluster"], fits(r["s"]), fits(whole), digests[r["cluster"]]) for r in sums]
    of = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
