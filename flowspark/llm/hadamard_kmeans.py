"""Centroid clustering of integer vectors by progressive search over Walsh-Hadamard coefficients."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.session import ship_package

from .common import stored

#: Components of this size or more after scaling, whose squares no result column could hold, count as not finite.
HUGE = 1e25
_LONG = (1 << 63) - 1
#: Coefficients compared at a time, coarse to fine.
_STEPS = (2, 8, 16, 32)


def transformed(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform along the last axis (a power of two), in whole numbers; twice gives ``size * x``."""
    size, half = x.shape[-1], 1
    while half < size:
        y = x.reshape(-1, size // (2 * half), 2, half)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(x.shape)
        half *= 2
    return x


def coarse_to_fine(size: int) -> np.ndarray:
    """Order of the coefficients by sign changes of their pattern."""
    return np.argsort((np.diff(transformed(np.eye(size, dtype=np.int64))) != 0).sum(1), kind="stable")


def nearest(coefs: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's nearest centroid and ``size`` times its squared distance; ties go to the smaller number.

    A sum over some coefficients is never above the sum over all. The centroid that
    leads after the first ones is finished at once; its sum is the bound. The others
    go on coarse to fine, and leave once their sum is above the bound; those that
    stay are finished, so equal sums are seen.
    """
    size = coefs.shape[1]
    cuts = [*[s for s in _STEPS if s < size], size]
    head = cuts[0]
    part = ((coefs[:, None, :head] - centroids[None, :, :head]) ** 2).sum(2)
    rows = np.arange(len(coefs))
    lead = part.argmin(1)
    bound = part[rows, lead] + ((coefs[:, head:] - centroids[lead, head:]) ** 2).sum(1)
    row, number = np.nonzero(part <= bound[:, None])
    sums = part[row, number]
    for a, b in zip(cuts, cuts[1:]):
        sums = sums + ((coefs[row, a:b] - centroids[number, a:b]) ** 2).sum(1)
        stay = (sums <= bound[row]).astype(bool)
        row, number, sums = row[stay], number[stay], sums[stay]
    whole = np.repeat((bound + 1)[:, None], len(centroids), 1)
    whole[row, number] = sums
    best = whole.argmin(1)
    return best, whole[rows, best]


class Coder:
    """Vectors to coefficients and back to bytes: 32-bit where all sums of squares then fit 64 bits, else whole values."""

    def __init__(self, dim: int) -> None:
        self.dim, self.size = dim, 1 << max(dim - 1, 0).bit_length()
        self.order = coarse_to_fine(self.size)
        #: size * size * (2 * narrow)^2 stays below 2^63, and a coefficient within 31 bits
        self.narrow = min(int(np.sqrt(1 << 60)) // self.size, (1 << 30) // self.size)

    def forward(self, values: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(values), self.size), values.dtype)
        padded[:, : self.dim] = values
        return transformed(padded)[:, self.order]

    def mean(self, sums: np.ndarray, n: int) -> list[int]:
        """floor(sum / n) of each component from the sums of coefficients, as Python integers."""
        natural = np.zeros(self.size, object)
        natural[self.order] = sums
        return [int(s) // self.size // n for s in transformed(natural)[: self.dim]]

    def packed(self, scaled: np.ndarray) -> list[bytes]:
        """Whole numbers held in doubles, row by row."""
        small = np.abs(scaled).max(1, initial=0) <= self.narrow
        coefs = self.forward(np.where(small[:, None], scaled, 0).astype(np.int64)).astype(np.int32)
        return [c.tobytes() if s else v.tobytes() for c, s, v in zip(coefs, small, scaled)]

    def groups(self, packed: list[bytes], centroids: list[list[int]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``rows, coefficients, centroids' coefficients``: rows that 64 bits serve, then those for Python integers."""
        wide = np.array([len(p) != 4 * self.size for p in packed], bool)
        small = all(abs(x) <= self.narrow for c in centroids for x in c)
        cents = self.forward(np.array(centroids, np.int64 if small else object))
        rows = np.flatnonzero(~wide)
        if len(rows):
            coefs = np.frombuffer(b"".join(packed[i] for i in rows), np.int32).reshape(-1, self.size).astype(np.int64)
            yield rows, coefs if small else coefs.astype(object), cents
        rows = np.flatnonzero(wide)
        if len(rows):
            values = np.array([[int(x) for x in np.frombuffer(packed[i])] for i in rows], object)
            yield rows, self.forward(values), cents.astype(object)


def _kept(vector: Column, dim: int, scale: int) -> Column:
    """Exactly ``dim`` components, all of them finite numbers."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double") * scale) < HUGE, F.lit(False)))
    return F.coalesce((F.size(vector) == dim) & fine, F.lit(False))


def cluster(
    vectors: DataFrame,
    *,
    k: int = 8,
    rounds: int = 10,
    dim: int = 64,
    scale: int = 1024,
    seed: int = 3,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` per vector, and the final centroids.

    Components become ``floor(scale * x)``. The centroids start as the ``k`` vectors
    whose ids have the smallest sha256 of ``seed:id``; each round assigns all vectors
    to the nearest centroid (squared distance, ties to the smaller number) and takes
    the floors of the means; an empty one stays where it is. The coefficients are stored
    once. A task adds up its vectors per centroid; only ``k * dim`` sums leave a round.

    Vectors that are null, of another length, or hold a null or non-finite component
    take no part; nor do those with a component of 10^25 or more after scaling. Large ones below that are
    computed in Python integers; a distance that no long holds is null. Repeated rows
    are so many vectors; equal hashes go by the coefficients. A row without an id is assigned like any
    other and starts a centroid only if rows with ids run out. Fewer than ``k`` vectors make fewer
    centroids; an empty table has none. Other columns are left alone.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    coder = Coder(dim)
    rows = vectors.filter(_kept(F.col(vector_col), dim, scale)).select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("v"))

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            scaled = np.floor(scale * np.array(b.v.tolist(), np.float64).reshape(len(b), dim))
            yield pd.DataFrame({"vec_id": b.vec_id.astype("Int64"), "coefs": coder.packed(scaled)})

    coded = stored(rows.mapInPandas(code, "vec_id bigint, coefs binary"), "kmeans-coefficients")
    first = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    starts = [bytes(r[0]) for r in coded.orderBy(F.asc_nulls_last(first), "coefs").limit(k).select("coefs").collect()]
    centroids = [coder.mean(c.sum(0), 1) for p in starts for _, c, _ in coder.groups([p], [[0] * dim])]
    if not centroids:
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), []

    for _ in range(rounds):
        now = centroids

        def add_up(batches: Iterator[pd.DataFrame], now=now) -> Iterator[pd.DataFrame]:
            sums, n = np.zeros((len(now), coder.size), object), np.zeros(len(now), np.int64)
            for b in batches:
                for _, coefs, cents in coder.groups(list(b.coefs), now):
                    best, _ = nearest(coefs, cents)
                    for c in np.unique(best):
                        mine = coefs[best == c]
                        sums[c] += mine.sum(0).astype(object)
                        n[c] += len(mine)
            for c in np.flatnonzero(n):
                yield pd.DataFrame({"cluster": [c], "n": [n[c]], "sums": [[Decimal(int(s)) for s in sums[c]]]})

        parts = coded.select("coefs").mapInPandas(add_up, "cluster int, n bigint, sums array<decimal(38,0)>")
        totals = parts.select("cluster", "n", F.posexplode("sums")).groupBy("cluster", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("col")).cast("string").alias("s"))
        found: dict[int, tuple[int, np.ndarray]] = {}
        for r in totals.collect():
            found.setdefault(r["cluster"], (r["n"], np.zeros(coder.size, object)))[1][r["pos"]] = int(r["s"])
        centroids = [coder.mean(found[c][1], found[c][0]) if c in found else old for c, old in enumerate(centroids)]

    def assign(batches: Iterator[pd.DataFrame], now=centroids) -> Iterator[pd.DataFrame]:
        for b in batches:
            number, distance = np.zeros(len(b), np.int32), np.zeros(len(b), object)
            for at, coefs, cents in coder.groups(list(b.coefs), now):
                best, far = nearest(coefs, cents)
                number[at], distance[at] = best, far // coder.size
            fit = pd.array([int(d) if d <= _LONG else None for d in distance], "Int64")
            yield pd.DataFrame({"vec_id": b.vec_id.astype("Int64"), "cluster": number, "distance": fit})

    return coded.mapInPandas(assign, "vec_id bigint, cluster int, distance bigint"), centroids
