"""Approximate nearest neighbours by inner product over a forest of random-projection trees."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType
from pyspark.sql.window import Window as W

from flowspark.session import ship_package

from .common import stored

#: The trees are fitted on at most so many vectors, down to leaves of so many; the index holds every vector.
TREES, SAMPLE, LEAF = 4, 16_384, 64
#: Neighbouring leaves are stored together; a bundle above BLOCK vectors is split by hash.
BUNDLE, BLOCK = 16, 4096
#: The number of leaves a query visits is found on so many queries, each compared with all vectors.
PROBES, AIM = 128, 0.95
#: Vectors of the sample that give a query a first lower bound of its k-th score.
_FLOOR = 4096
_SLICE = 256
_EMPTY = pd.DataFrame({"asked": np.array([], np.int64), "rep": np.array([], np.int64), "score": np.array([], np.float64)})


def matrix(vectors, dim: int) -> np.ndarray:
    """Rows as doubles, cut or filled with zeros to ``dim`` components."""
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v[:dim]
    return out


def products(q: np.ndarray, v: np.ndarray, qi: np.ndarray, vi: np.ndarray) -> np.ndarray:
    """Inner products of pairs, components added in their order: equal vectors give equal scores."""
    total = np.zeros(len(qi))
    for j in range(q.shape[1]):
        total += q[qi, j] * v[vi, j]
    return total


@dataclass(frozen=True)
class Forest:
    """Trees over vectors lifted to one sphere, where the largest inner product is the smallest distance.

    ``children`` holds a node's two followers, leaves as ``~leaf``. Leaves are numbered
    left to right through all trees. ``bundle`` is the group a leaf is stored with,
    ``place`` its number there.
    """

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    roots: tuple[int, ...]
    bundle: np.ndarray
    place: np.ndarray
    dim: int
    radius: float
    visits: int = 1

    @staticmethod
    def fit(sample: np.ndarray, radius: float, *, trees: int = TREES, leaf: int = LEAF, seed: int = 11) -> Forest:
        """Each node parts its vectors at the median along the line through two of them."""
        rng = np.random.default_rng(seed)
        points = _lifted(sample, radius)
        normals, offsets, children, roots, bundle, place = [], [], [], [], [], []

        def grow(at: np.ndarray, first: int) -> int:
            if len(at) > leaf:
                a, b = rng.choice(at, 2, replace=False)
                normal = points[a] - points[b]
                along = points[at] @ normal
                cut = np.median(along)
                low = along <= cut
                if 0 < low.sum() < len(at):
                    node = len(normals)
                    length = np.linalg.norm(normal)
                    normals.append(normal / length)
                    offsets.append(cut / length)
                    children.append((0, 0))
                    children[node] = (grow(at[low], first), grow(at[~low], first))
                    return node
            here = len(bundle)
            start = bundle[-1] if here > first else (bundle[-1] + 1 if bundle else 0)
            full = here > first and place[-1] == BUNDLE - 1
            bundle.append(start + full)
            place.append(0 if here == first or full else place[-1] + 1)
            return ~here

        for _ in range(trees):
            roots.append(grow(np.arange(len(points)), len(bundle)))
        n = len(normals)
        return Forest(
            np.array(normals).reshape(n, points.shape[1]), np.array(offsets), np.array(children, np.int64).reshape(n, 2),
            tuple(roots), np.array(bundle), np.array(place), sample.shape[1], radius,
        )

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        points, out = _lifted(vectors, self.radius), np.empty((len(vectors), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            node = np.full(len(points), root)
            while len(open_ := np.flatnonzero(node >= 0)):
                at = node[open_]
                above = np.einsum("ij,ij->i", points[open_], self.normals[at]) > self.offsets[at]
                node[open_] = self.children[at, above.astype(int)]
            out[:, t] = ~node
        return out

    def search(self, queries: np.ndarray, visits: int, stock: np.ndarray | None = None, least: int = 0) -> Iterator[list[int]]:
        """``visits`` leaves of each query, best first: one queue holds the open branches of all trees.

        A branch is as far as the squared distances to the planes that part it from the query.
        More leaves follow while those found hold fewer than ``least`` vectors, by the leaves' ``stock``.
        """
        held = (stock if stock is not None else np.zeros(len(self.bundle), int)).tolist()
        length = np.linalg.norm(queries, axis=1, keepdims=True)
        points = np.pad(queries * (self.radius / length), ((0, 0), (0, 1)))
        margins = points @ self.normals.T - self.offsets
        children = self.children.tolist()
        for margin in margins.tolist():
            queue, found, n = [(0.0, root) for root in self.roots], [], 0
            while queue and (len(found) < visits or n < least):
                far, node = heapq.heappop(queue)
                while node >= 0:
                    low, high = children[node]
                    m = margin[node]
                    near, other = (high, low) if m > 0 else (low, high)
                    heapq.heappush(queue, (far + m * m, other))
                    node = near
                found.append(~node)
                n += held[~node]
            yield found


def _lifted(vectors: np.ndarray, radius: float) -> np.ndarray:
    square = np.maximum(radius * radius - (vectors * vectors).sum(1), 0)
    return np.hstack([vectors, np.sqrt(square)[:, None]])


def _strongest(q: np.ndarray, v: np.ndarray, allowed: np.ndarray | None, least: np.ndarray, k: int, names: np.ndarray):
    """``query row, vector row, score`` of the k best allowed vectors of each query, none below ``least``."""
    scores = q @ v.T
    if allowed is not None:
        scores[~allowed] = -np.inf
    bound = least
    if scores.shape[1] > k:
        bound = np.maximum(least, np.partition(scores, -k, axis=1)[:, -k])
    slack = 1e-9 * np.linalg.norm(q, axis=1) * np.sqrt((v * v).sum(1).max(initial=0))
    qi, vi = np.nonzero((scores >= (bound - slack)[:, None]) & (scores > -np.inf))
    exact = products(q, v, qi, vi)
    order = np.lexsort((names[vi], -exact, qi))
    qi, vi, exact = qi[order], vi[order], exact[order]
    place = np.arange(len(qi)) - np.searchsorted(qi, qi)
    return qi[place < k], vi[place < k], exact[place < k]


def _classes(vectors: DataFrame, is_query: Column, k: int, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors with their k+1 smallest ids, and the queries' ids with the smallest id of their vector.

    No query can need more ids of one vector than that, so a vector that fills the table is one row.
    """
    kind = vectors.schema[vector_col].dataType
    element = "float" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "double"
    v = F.col(vector_col).cast(f"array<{element}>")
    fine = F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"), is_query.alias("q"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull()).filter(fine)
    rows = rows.groupBy("id").agg(F.min("v").alias("v"), F.max("q").alias("q"))
    rows = stored(rows, "forest-vectors")
    nth = F.row_number().over(W.partitionBy("v").orderBy("id"))
    few = rows.withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    same = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = stored(same.select(F.col("ids")[0].alias("rep"), "ids", "v"), "forest-classes")
    key = [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(7), "v").alias("h2")]
    of = classes.select("rep", *key)
    queries = rows.filter("q").select(F.col("id").alias("query_id"), *key).join(of, ["h1", "h2"]).select("query_id", "rep")
    return classes, stored(queries, "forest-queries")


def fit_forest(classes: DataFrame, queries: DataFrame, k: int, *, aim: float = AIM) -> tuple[Forest, np.ndarray, np.ndarray] | None:
    """A forest for the vectors, with a sample of them; None if there are none.

    ``visits`` is the number of leaves by which ``aim`` of the true neighbours of some
    queries were met. These queries, a sample by hash, are compared with every vector,
    so the number follows the table's size and shape.
    """
    spark = classes.sparkSession
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    radius = classes.agg(F.max(square)).first()[0]
    if radius is None:
        return None
    order = F.xxhash64("rep")
    picked = classes.orderBy(order, "rep").limit(SAMPLE).select("rep", "v").collect()
    dim = max(len(r["v"]) for r in picked)
    names, sample = np.array([r["rep"] for r in picked]), matrix([r["v"] for r in picked], dim)
    forest = Forest.fit(sample, float(np.sqrt(radius)))
    asked = queries.select("rep").distinct().orderBy(order, "rep").limit(PROBES)
    probes = asked.join(classes, "rep").select("rep", "v").collect()
    if not probes:
        return forest, names, sample
    probe_names = np.array([r["rep"] for r in probes])
    wide = max(dim, *(len(r["v"]) for r in probes))
    probe = spark.sparkContext.broadcast((probe_names, matrix([r["v"] for r in probes], wide), forest))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked, q, trees = probe.value
        for b in batches:
            rep, v = b.rep.to_numpy(), matrix(b.v, q.shape[1])
            qi, vi, score = _strongest(q, v, asked[:, None] != rep[None], np.full(len(q), -np.inf), k, rep)
            if len(qi):
                leaves = trees.leaves_of(v[vi][:, : trees.dim])
                yield pd.DataFrame({"probe": qi, "rep": rep[vi], "score": score, "leaves": list(leaves)})

    near = classes.select("rep", "v").mapInPandas(compare, "probe int, rep bigint, score double, leaves array<bigint>")
    rank = F.row_number().over(W.partitionBy("probe").orderBy(F.desc("score"), "rep"))
    true = near.withColumn("rank", rank).filter(F.col("rank") <= k).select("probe", "leaves").collect()
    orders = []
    for found in forest.search(probe.value[1][:, :dim], len(forest.bundle)):
        at = np.empty(len(found), np.int64)
        at[found] = np.arange(len(found))
        orders.append(at)
    needs = [int(orders[r["probe"]][r["leaves"]].min()) + 1 for r in true]
    return replace(forest, visits=int(np.quantile(needs, aim, method="higher")) if needs else 1), names, sample


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 20, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest vectors found for each query, by largest inner product.

    Every distinct vector is indexed in the leaf it falls into, in each of the trees. A query
    visits the leaves that one queue over all trees yields first (how many:
    ``fit_forest``) and is compared exactly with all vectors of these. It travels once
    to each bundle of leaves, and returns only scores that reach its k-th best among the sampled
    vectors of its leaves. Queries stream through a task against one block of the index.

    Equal scores go by the smaller id. Vectors that are null, empty, zero or hold null
    or non-finite components take no part, nor do rows without an id. Rows of one
    id are one vector (the least of them). Shorter vectors count as filled with zeros.
    Fewer than k others: all of them. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    out = "query_id bigint, rank int, vec_id bigint, score double"
    classes, queries = _classes(vectors, is_query, k, id_col, vector_col)
    fitted = fit_forest(classes, queries, k)
    if fitted is None:
        return spark.createDataFrame([], out)
    forest, names, sample = fitted
    trees, forest_dim = spark.sparkContext.broadcast(forest), forest.dim

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            leaves = trees.value.leaves_of(matrix(b.v, forest_dim))
            for t in range(leaves.shape[1]):
                leaf = leaves[:, t]
                yield pd.DataFrame({"bundle": trees.value.bundle[leaf], "rep": b.rep, "v": b.v, "leaves": 1 << trees.value.place[leaf]})

    item = f"bundle int, rep bigint, v {classes.schema['v'].dataType.simpleString()}, leaves int"
    entries = stored(classes.select("rep", "v").mapInPandas(place, item), "forest-entries")
    number = {(int(b), 1 << int(p)): leaf for leaf, (b, p) in enumerate(zip(forest.bundle, forest.place))}
    stock = np.zeros(len(forest.bundle), np.int64)
    for r in entries.groupBy("bundle", "leaves").count().collect():  # one row per leaf of the fitted trees
        stock[number[r["bundle"], r["leaves"]]] = r["count"]
    blocks = np.maximum(-(-np.bincount(forest.bundle, stock).astype(np.int64) // BLOCK), 1)
    table = F.array(*[F.lit(int(n)) for n in blocks])
    enough = len(forest.roots) * (k + 1)  # no vector is in a tree twice
    some = sample[:_FLOOR]
    shared = spark.sparkContext.broadcast((stock, names[:_FLOOR], some, forest.leaves_of(some)))

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = trees.value
        stock, known, some, at = shared.value
        for b in batches:
            for a in range(0, len(b), _SLICE):
                cut = b.iloc[a : a + _SLICE]
                q, rep = matrix(cut.v, forest.dim), cut.rep.to_numpy()
                scores = q @ some.T
                rows = []
                for i, found in enumerate(forest.search(q, forest.visits, stock, enough)):
                    open_ = np.zeros(len(stock), bool)
                    open_[found] = True
                    met = scores[i, open_[at].any(1) & (known != rep[i])]
                    least = float(np.partition(met, -k)[-k]) if len(met) >= k else -np.inf
                    bits: dict[int, int] = {}
                    for leaf in found:
                        bundle = int(forest.bundle[leaf])
                        bits[bundle] = bits.get(bundle, 0) | 1 << int(forest.place[leaf])
                    rows += [(bundle, int(rep[i]), cut.v.iloc[i], mask, least, int(block)) for bundle, mask in bits.items() for block in range(blocks[bundle])]
                yield pd.DataFrame(rows, columns=["bundle", "rep", "v", "leaves", "least", "block"])

    asked = queries.select("rep").distinct().join(classes.select("rep", "v"), "rep")
    visits = asked.mapInPandas(visit, item + ", least double, block bigint").withColumn("kind", F.lit(1))
    block = F.pmod(F.xxhash64("rep"), F.element_at(table, F.col("bundle") + 1))
    stock = entries.withColumn("least", F.lit(None).cast("double")).withColumn("block", block).withColumn("kind", F.lit(0))
    meet = stock.unionByName(visits).repartition("bundle", "block").sortWithinPartitions("bundle", "block", "kind")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, ready = None, [], None
        for b in batches:
            for here, same in b.groupby(["bundle", "block"], sort=False):
                if here != key:
                    key, held, ready = here, [], None
                stock = same[same.kind == 0]
                if len(stock):
                    held.append(stock)
                coming = same[same.kind == 1]
                if not len(coming) or not held:
                    continue
                if ready is None:
                    stock = pd.concat(held)
                    ready = stock.v, stock.rep.to_numpy(), stock.leaves.to_numpy()
                    longest = max(map(len, stock.v))
                for a in range(0, len(coming), _SLICE):
                    cut = coming.iloc[a : a + _SLICE]
                    dim = max(longest, *map(len, cut.v), 1)
                    q, rep = matrix(cut.v, dim), cut.rep.to_numpy()
                    wanted = cut.leaves.to_numpy()
                    some = np.flatnonzero(ready[2] & np.bitwise_or.reduce(wanted))
                    v, name = matrix(ready[0].iloc[some], dim), ready[1][some]
                    qi, vi, score = _strongest(q, v, (wanted[:, None] & ready[2][some][None]) != 0, cut.least.to_numpy(), k + 1, name)
                    some, at = np.unique(qi, return_index=True)
                    if len(some):
                        yield pd.DataFrame({"asked": rep[some], "reps": np.split(name[vi], at[1:]), "scores": np.split(score, at[1:])})

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Lists of one query, next to each other, into its k+1 best; the last query of a batch waits for the next."""
        rest = _EMPTY
        for b in batches:
            lengths = b.reps.str.len().to_numpy()
            flat = pd.DataFrame({"asked": np.repeat(b.asked, lengths), "rep": np.concatenate(b.reps), "score": np.concatenate(b.scores)})
            whole = pd.concat([rest, flat]).drop_duplicates(["asked", "rep"])
            whole = whole.sort_values(["asked", "score", "rep"], ascending=[True, False, True]).groupby("asked").head(k + 1)
            last = whole.asked == b.asked.iloc[-1]
            yield whole[~last]
            rest = whole[last]
        yield rest

    found = meet.mapInPandas(compare, "asked bigint, reps array<bigint>, scores array<double>")
    near = found.repartition("asked").sortWithinPartitions("asked")
    best = near.mapInPandas(best, "asked bigint, rep bigint, score double")
    ids = best.join(classes.select("rep", "ids"), "rep").select("asked", F.explode("ids").alias("vec_id"), "score")
    lists = ids.groupBy("asked").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id"))).alias("all"))
    each = queries.join(lists.select(F.col("asked").alias("rep"), F.slice("all", 1, k + 1).alias("all")), "rep")
    others = F.slice(F.filter("all", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    rows = each.select("query_id", F.posexplode(others).alias("pos", "hit"))
    return rows.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.down")).alias("score"))
