"""Neighbours over the forest and clusters by progressive search, against brute force."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from flowspark.llm import QUERIES
from flowspark.llm.hadamard_kmeans import Coder, cluster, coarse_to_fine, nearest, transformed
from flowspark.llm.projection_forest import Forest, nearest_neighbours

VECTORS = "vec_id bigint, embedding array<double>"


def table(spark, rows):
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    for c in ("rep", "v", "q", "cluster", "coefs", "score", "rank", "id", "ids"):
        df = df.withColumn(c, F.lit(c))
    return df


def truth(rows, queries, k):
    out = {}
    for q, a in queries:
        scores = []
        for i, b in rows:
            if i != q:
                s = 0.0
                for x, y in zip(a, b):
                    s += x * y
                scores.append((-s, i))
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        found = out.setdefault(r.query_id, [])
        assert r["rank"] == len(found) + 1
        found.append((r.vec_id, r.score))
    return out


def test_recall_on_the_given_vectors(spark):
    sf_dir = "/root/testdata/sf0.1"
    t = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    x, ids = np.array(t.embedding.tolist(), np.float64), t.vec_id.to_numpy()
    got, hits = answers(QUERIES["op11_nearest_neighbours"](spark, sf_dir)), 0
    assert sorted(got) == sorted(ids[ids % 20 == 0])
    for q, found in got.items():
        s = x @ x[ids == q][0]
        assert np.allclose([v for _, v in found], [s[ids == i][0] for i, _ in found], rtol=0, atol=1e-15)
        assert [(-v, i) for i, v in found] == sorted((-v, i) for i, v in found) and len(found) == 20
        s[ids == q] = -9
        hits += len(set(ids[np.argsort(-s)[:20]]) & {i for i, _ in found})
    assert hits / (20 * len(got)) >= 0.9


def test_recall_in_clusters_of_unequal_lengths(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16)) * rng.uniform(0.2, 4, (30, 1))
    x = centres[rng.integers(0, 30, 4000)] + rng.normal(size=(4000, 16)) * 0.2
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want = truth(rows, rows[::100], 10)
    got = answers(nearest_neighbours(table(spark, rows), F.col("vec_id") % 100 == 0, 10))
    assert sorted(got) == sorted(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_neighbours_of_odd_rows(spark):
    rng = random.Random(1)
    fine = [(i, [rng.choice([-1.0, 0.5, 2.0]) for _ in range(4)]) for i in range(1, 60)]  # many ties
    fine += [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(100, 160)]  # one vector, many ids
    fine += [(200, [3.0]), (201, [0.0, 0.0, 0.0, 0.0, 5.0])]  # other lengths
    odd = [(300, None), (301, []), (302, [0.0] * 4), (303, [1.0, None, 1.0, 1.0]), (304, [1.0, float("nan"), 1.0, 1.0]), (305, [float("inf")] * 4), (None, [1.0] * 4)]
    longer = [(i, v + [0.0] * (5 - len(v))) for i, v in fine]
    queries = [(i, v) for i, v in longer if i % 5 == 0]
    got = answers(nearest_neighbours(table(spark, fine + odd + fine[:7]), F.col("vec_id") % 5 == 0, 6))
    assert got == truth(longer, queries, 6)  # so few vectors are all visited


def test_neighbours_of_few_or_none(spark):
    ask = lambda rows: answers(nearest_neighbours(table(spark, rows), F.col("vec_id") % 2 == 0, 3))
    assert ask([]) == {} and ask([(2, [1.0, 0.0])]) == {} and ask([(1, [1.0]), (3, [1.0])]) == {}
    assert ask([(2, [1.0, 0.0]), (3, [2.0, 0.0]), (5, [2.0, 0.0])]) == {2: [(3, 2.0), (5, 2.0)]}


def test_search_takes_leaves_in_the_order_of_their_distance():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 8))
    forest = Forest.fit(x, float(np.sqrt((x * x).sum(1).max())), trees=3, leaf=20)
    assert (np.bincount(forest.bundle) <= 16).all() and len(set(zip(forest.bundle, forest.place))) == len(forest.bundle)
    q = x[:5]
    lifted = np.pad(q * (forest.radius / np.linalg.norm(q, axis=1, keepdims=True)), ((0, 0), (0, 1)))
    for i, found in enumerate(forest.search(q, len(forest.bundle))):
        far = {}

        def walk(node, d):
            if node < 0:
                far[~node] = d
                return
            m = float(lifted[i] @ forest.normals[node] - forest.offsets[node])
            walk(int(forest.children[node][0]), d + (m * m if m > 0 else 0))
            walk(int(forest.children[node][1]), d + (0 if m > 0 else m * m))

        for root in forest.roots:
            walk(root, 0.0)
        assert sorted(found) == list(range(len(forest.bundle)))
        assert np.all(np.diff([far[leaf] for leaf in found]) >= -1e-9)


# clusters


def plain_clusters(rows, k, rounds, scale=1024, seed=3):
    import math

    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    cents = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))[:k]]
    for step in range(rounds + 1):
        far = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents] for _, v in kept]
        mine = [f.index(min(f)) for f in far]
        if step < rounds:
            for c in range(len(cents)):
                group = [v for (_, v), m in zip(kept, mine) if m == c]
                if group:
                    cents[c] = [sum(x) // len(group) for x in zip(*group)]
    return sorted((i, m, f[m]) for (i, _), m, f in zip(kept, mine, far)), cents


def test_transform_is_its_own_inverse():
    x = np.random.default_rng(0).integers(-1000, 1000, (5, 64))
    assert (transformed(transformed(x)) == 64 * x).all()
    order = coarse_to_fine(64)
    assert sorted(order) == list(range(64)) and order[0] == 0


def test_nearest_equals_brute_force_with_ties():
    rng = np.random.default_rng(1)
    x, c = rng.integers(-3, 4, (3000, 64)), rng.integers(-3, 4, (7, 64))
    c[5], x[:50] = c[2], c[2]
    coder = Coder(64)
    best, far = nearest(coder.forward(x), coder.forward(c))
    want = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (best == want.argmin(1)).all() and (far == 64 * want.min(1)).all()


def test_clusters_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-0.5, 0.25, 1.0]) + rng.random() * (i % 3) for _ in range(6)]) for i in range(300)]
    rows += rows[:40] + [(i, [0.5] * 6) for i in range(400, 500)]  # repeated rows, one vector many times
    odd = [(900, None), (901, [0.0]), (902, [None] * 6), (903, [float("nan")] * 6), (904, [float("-inf")] * 6)]
    got, cents = cluster(table(spark, rows + odd), k=5, rounds=4, dim=6)
    want, centres = plain_clusters(rows, 5, 4)
    assert cents == centres and sorted(tuple(r) for r in got.collect()) == want


def test_clusters_of_large_numbers(spark):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-1, 1) * 10 ** rng.choice([0, 5, 6]) for _ in range(4)]) for i in range(60)]
    got, cents = cluster(table(spark, rows), k=3, rounds=3, dim=4)
    want, centres = plain_clusters(rows, 3, 3)
    assert cents == centres and sorted(tuple(r) for r in got.collect()) == want
    rows = [(1, [1e15] * 4), (2, [-1e15] * 4), (3, [1e15 - 1] * 4)]
    got, _ = cluster(table(spark, rows), k=1, rounds=1, dim=4)
    assert [r.distance for r in got.collect()] == [None] * 3  # exact, but beyond a long


def test_clusters_of_few_or_none(spark):
    got, cents = cluster(table(spark, []), dim=2)
    assert got.collect() == [] and cents == []
    got, cents = cluster(table(spark, [(None, [1.0, 2.0]), (7, [1.0, 2.0])]), dim=2, k=8)
    assert len(cents) == 2 and sorted((r.vec_id or 0, r.cluster, r.distance) for r in got.collect()) == [(0, 0, 0), (7, 0, 0)]
