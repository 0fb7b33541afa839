"""Exact top-k by inner product over an index of pivot distances."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from flowspark.session import ship_package

from .common import stored

#: Pivots, drawn farthest-first from at most so many vectors; the index itself holds every vector.
PIVOTS, PIVOT_SAMPLE = 64, 4096
CHUNK_ROWS = 1024
_CHUNK = "chunk bigint, pivot int, low double, high double, ids binary, dists binary, vectors binary"
_FOUND = "query_id bigint, vec_id bigint, score bigint"
#: Vectors whose squared length (after scaling) reaches this are compared in Python integers.
WIDE = float(1 << 58)
_ROWS, _BLOCK = 256, 2048


def _finite(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))), F.lit(False))


def whole(x: float) -> int:
    """floor(256 * x)."""
    return math.floor(256 * x) if abs(x) < float(1 << 52) else int(x) * 256


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), np.int64).reshape(len(vectors), -1)


def _products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; through doubles where they hold every sum exactly."""
    return a @ b.T if exact else (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)


def _distances(q: np.ndarray, v: np.ndarray, top: int, exact: bool) -> np.ndarray:
    """Distances from (q, 0) to (v, sqrt(top - |v|^2)): they fall as the inner product rises."""
    square = (q * q).sum(1)[:, None] + top - 2 * _products(q, v, exact)
    return np.sqrt(np.maximum(square, 0))


def _pivot_distances(v: np.ndarray, pivots: np.ndarray, top: int, exact: bool) -> np.ndarray:
    """Distances between vectors and pivots, both lifted to the sphere of the longest."""
    lift = np.sqrt(np.maximum(top - (v * v).sum(1), 0).astype(np.float64))
    base = np.sqrt(np.maximum(top - (pivots * pivots).sum(1), 0).astype(np.float64))
    square = 2.0 * top - 2.0 * (_products(v, pivots, exact) + lift[:, None] * base)
    return np.sqrt(np.maximum(square, 0))


def _best(query: int, ids: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    order = np.lexsort((ids, -scores))[:k]
    return [(query, int(ids[i]), int(scores[i])) for i in order]


def _annuli(q: np.ndarray, me: int, at: float, ids, dists, vectors, radius: float, k: int, top: int, exact: bool):
    """Best k of a chunk for one query: from its own distance outwards, until no ring can hold a better one.

    ``radius`` is the distance of the k-th best so far (infinite if there is none). A
    vector at pivot distance d is at least ``|d - at|`` away, so rings beyond the
    radius cannot matter; rings at the radius itself are read, for ties.
    """
    mid, found_ids, found_scores = np.searchsorted(dists, at), [], []
    lo = hi = mid
    step = 64
    norm = int((q * q).sum())
    slack = 1e-7 * (1.0 + np.sqrt(float(norm + top)))
    while lo > 0 or hi < len(dists):
        new_lo = max(np.searchsorted(dists, at - radius - slack), lo - step, 0)
        new_hi = min(np.searchsorted(dists, at + radius + slack, "right"), hi + step, len(dists))
        if new_lo >= lo and new_hi <= hi:
            break
        for a, b in ((min(new_lo, lo), lo), (hi, max(new_hi, hi))):
            if a < b:
                s = _products(vectors[a:b], q[None], exact)[:, 0]
                keep = ids[a:b] != me
                found_ids.append(ids[a:b][keep])
                found_scores.append(s[keep])
        lo, hi, step = min(new_lo, lo), max(new_hi, hi), step * 2
        if sum(map(len, found_ids)) >= k:
            i, s = np.concatenate(found_ids), np.concatenate(found_scores)
            order = np.lexsort((i, -s))[:k]
            found_ids, found_scores = [i[order]], [s[order]]
            radius = min(radius, float(np.sqrt(max(norm + top - 2 * int(s[order[-1]]), 0))))
    if not found_ids:
        return []
    return _best(me, np.concatenate(found_ids), np.concatenate(found_scores), k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, *, id_col: str = "vec_id", vector_col: str = "embedding", dim: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k largest inner products with other vectors.

    Components become ``floor(256 * x)``. Equal scores go by the smaller id. Every
    vector is lifted to the sphere of the longest one, where the largest inner product
    is the smallest distance. The index keys it by its nearest pivot and the
    distance to it, sorted and cut into chunks of one pivot. A query first searches the
    chunk it lies in; the k-th distance found there is its radius. It then visits the
    chunks that the triangle inequality and the pivots' bisectors cannot rule out.

    Vectors that are null, empty, or hold null or non-finite components, or have no id, take
    no part. Rows of one id are one vector (the least of them). Fewer than k others: all of
    them. Vectors of another length than usual (``dim``, else the most frequent one; shorter
    ones count as filled with zeros) or with a squared length of ``WIDE`` or more are
    not in the index: as queries and as candidates they are compared with every vector, in
    blocks and in exact integers. A score that no long holds is null, in its right rank.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), v.alias("x"), is_query.alias("q"))
    rows = rows.filter(F.col("x").isNotNull() & F.col("id").isNotNull() & (F.size("x") > 0)).filter(_finite(F.col("x")))
    rows = rows.groupBy("id").agg(F.min("x").alias("x"), F.max("q").alias("q"))
    square = F.aggregate("x", F.lit(0.0), lambda s, x: s + (x * 256) * (x * 256))
    rows = stored(rows.withColumn("square", square), "topk-vectors")
    if dim is None:
        usual = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
        dim = usual["n"] if usual else 0
    indexed = (F.size("x") == dim) & (F.col("square") < WIDE)
    odd, all_rows = rows.filter(~indexed), rows
    rows = rows.filter(indexed).select("id", F.transform("x", lambda x: F.floor(x * 256).cast("bigint")).alias("v"), "q")
    found = _indexed(rows, k)
    if odd.isEmpty():
        rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    more = _all_scores(odd.filter("q"), all_rows, k).unionByName(_all_scores(all_rows.filter(F.col("q") & indexed), odd, k))
    lines = more.unionByName(found.withColumn("score", F.col("score").cast("string")))

    def best(group: pd.DataFrame) -> pd.DataFrame:
        hits = sorted({(-int(s), i) for s, i in zip(group.score, group.vec_id)})[:k]
        fit = [-s if -(1 << 63) <= -s < 1 << 63 else None for s, _ in hits]
        return pd.DataFrame(
            {"query_id": group.query_id.iloc[0], "rank": range(1, len(hits) + 1), "vec_id": [i for _, i in hits], "score": pd.array(fit, "Int64")}
        )

    return lines.groupBy("query_id").applyInPandas(best, "query_id bigint, rank int, vec_id bigint, score bigint")


def _all_scores(queries: DataFrame, others: DataFrame, k: int) -> DataFrame:
    """``query_id, vec_id, score`` (as text): the k best of ``others`` per query and block, by plain comparison."""
    groups, blocks = (max(1, -(-df.count() // n)) for df, n in ((queries, _ROWS), (others, _BLOCK)))

    def dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        at = F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
        return df.select("id", "x", at.alias(own), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other))

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        width = max((len(x) for x in [*left.x, *right.x]), default=0)
        q, c = (np.array([[whole(v) for v in x] + [0] * (width - len(x)) for x in side.x], object).reshape(len(side), width) for side in (left, right))
        out, ids = [], right.id.tolist()
        for me, row in zip(left.id, q):
            scores = c @ row if len(ids) else []
            hits = sorted((-s, i) for s, i in zip(scores, ids) if i != me)[:k]
            out += [(me, i, str(-s)) for s, i in hits]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    one = dealt(queries, "g", groups, "b", blocks).groupBy("g", "b")
    other = dealt(others, "b", blocks, "g", groups).groupBy("g", "b")
    return one.cogroup(other).applyInPandas(compare, "query_id bigint, vec_id bigint, score string")


def _indexed(rows: DataFrame, k: int) -> DataFrame:
    """``query_id, vec_id, score``: what the index finds, the k best of each query among it."""
    spark = rows.sparkSession
    norm = F.aggregate("v", F.lit(0).cast("bigint"), lambda s, x: s + x * x)
    top = rows.agg(F.max(norm)).first()[0]
    if top is None:
        return spark.createDataFrame([], _FOUND)
    exact = top >= 1 << 51

    sample = np.array([r[0] for r in rows.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).select("v").collect()], np.int64)
    chosen, far = [0], None
    while len(chosen) < min(PIVOTS, len(sample)):
        d = _pivot_distances(sample, sample[chosen[-1:]], top, exact)[:, 0]
        far = d if far is None else np.minimum(far, d)
        if far.max() <= 0:
            break
        chosen.append(int(far.argmax()))
    pivots = sample[chosen]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            d = _pivot_distances(_matrix(b.v), pivots, top, exact) if len(b) else np.zeros((0, len(pivots)))
            near = d.argmin(1) if len(b) else np.zeros(0, int)
            yield pd.DataFrame({"pivot": near.astype(np.int32), "dist": d[np.arange(len(b)), near], "id": b.id, "q": b.q, "v": b.v})

    placed = rows.mapInPandas(place, "pivot int, dist double, id bigint, q boolean, v array<bigint>")
    placed = placed.repartitionByRange("pivot", "dist", "id").sortWithinPartitions("pivot", "dist", "id")
    placed = placed.withColumn("part", F.spark_partition_id())

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = 0
        for b in batches:
            for pivot, same in b.groupby("pivot", sort=True):
                for a in range(0, len(same), CHUNK_ROWS):
                    c = same.iloc[a : a + CHUNK_ROWS]
                    wanted = c.q.to_numpy(bool)
                    m, ids = _matrix(c.v), c.id.to_numpy(np.int64)
                    yield pd.DataFrame(
                        [[int(c.part.iloc[0]) << 40 | n, int(pivot), c.dist.iloc[0], c.dist.iloc[-1], ids.tobytes(), c.dist.to_numpy().tobytes(), m.tobytes(), wanted.tobytes()]],
                        columns=["chunk", "pivot", "low", "high", "ids", "dists", "vectors", "queries"],
                    )
                    n += 1

    chunks = stored(placed.mapInPandas(cut, _CHUNK + ", queries binary"), "topk-chunks")
    # one line per CHUNK_ROWS vectors at most, and per pivot and partition: what the next step is sent
    lines = [tuple(r) for r in chunks.select("chunk", "pivot", "low", "high").collect()]
    lines = spark.sparkContext.broadcast([np.array(c) for c in zip(*lines)])

    def at_home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk_ids, chunk_pivot, low, high = lines.value
        for b in batches:
            for c in b.itertuples():
                ids, dists = np.frombuffer(c.ids, np.int64), np.frombuffer(c.dists)
                m = np.frombuffer(c.vectors, np.int64).reshape(len(ids), -1)
                found, visits = [], []
                queries = np.flatnonzero(np.frombuffer(c.queries, bool))
                for i in queries:
                    q = m[i]
                    to_pivots = _distances(q[None], pivots, top, exact)[0]
                    best = _annuli(q, int(ids[i]), to_pivots[c.pivot], ids, dists, m, np.inf, k, top, exact)
                    radius = np.inf
                    if len(best) == k:
                        radius = float(np.sqrt(max(int(q @ q) + top - 2 * best[-1][2], 0)))
                    found += [(*x, -1, 0.0, None) for x in best]
                    at = to_pivots[chunk_pivot]
                    least = np.maximum(np.maximum(at - high, low - at), (at - to_pivots.min()) / 2)
                    slack = 1e-7 * (1.0 + np.sqrt(float(int(q @ q) + top)))
                    open_ = np.flatnonzero((least <= radius + slack) & (chunk_ids != c.chunk))
                    visits += [(int(ids[i]), None, None, int(chunk_ids[j]), radius, q.tobytes()) for j in open_]
                if found or visits:
                    yield pd.DataFrame(found + visits, columns=["query_id", "vec_id", "score", "chunk", "radius", "query"]).astype({"vec_id": "Int64", "score": "Int64"})

    first = stored(chunks.filter(F.length("queries") > 0).mapInPandas(at_home, _FOUND + ", chunk bigint, radius double, query binary"), "topk-first")
    visits = first.filter("chunk >= 0").select("chunk", F.lit(1).alias("kind"), "query_id", "radius", "query")
    held = chunks.select("chunk", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("query_id"), "pivot", "ids", "dists", "vectors")
    meet = held.unionByName(visits, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk", "kind")

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Queries stream past the chunk they visit, which comes first."""
        now, ids, dists, m, pivot = None, None, None, None, 0
        for b in batches:
            out = []
            for x in b.itertuples():
                if x.kind == 0:
                    now, pivot = x.chunk, int(x.pivot)
                    ids, dists = np.frombuffer(x.ids, np.int64), np.frombuffer(x.dists)
                    m = np.frombuffer(x.vectors, np.int64).reshape(len(ids), -1)
                elif x.chunk == now:
                    q = np.frombuffer(x.query, np.int64)
                    at = _distances(q[None], pivots[pivot : pivot + 1], top, exact)[0, 0]
                    out += _annuli(q, int(x.query_id), at, ids, dists, m, x.radius, k, top, exact)
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    more = meet.mapInPandas(visit, _FOUND)
    return first.filter("chunk < 0").select("query_id", "vec_id", "score").unionByName(more)
