"""Left joins to a dimension that stay balanced under hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20
HOT_ROWS = 2_000_000
STREAM_SALTS = 16
PINNED_ROWS = 10_000
NULL_SALTS = 4096


def are_small(dfs: Sequence[DataFrame], max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> list[bool]:
    """Which of some batch tables are at most so many rows and bytes: sums per task in one job, no row is moved."""
    sums = []
    for i, df in enumerate(dfs):
        texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema if f.dataType.typeName() in ("string", "binary")]
        size = reduce(lambda a, b: a + b, texts, F.lit(16 * len(df.columns)))
        sums.append(df.agg(F.lit(i).alias("i"), F.count(F.lit(1)).alias("rows"), F.sum(size.cast("bigint")).alias("held")))
    found = {r["i"]: r["rows"] <= max_rows and (r["held"] or 0) <= max_bytes for r in reduce(DataFrame.unionByName, sums).collect()}
    return [found[i] for i in range(len(dfs))]


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    return are_small([df], max_rows, max_bytes)[0]


def pinned(df: DataFrame, max_rows: int) -> DataFrame:
    """A result that is small by nature, computed once and broadcast.

    Its rows go through the driver only if there are at most ``max_rows``; a larger
    one stays the distributed plan it was.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


class HotKeys:
    """Keys of more than ``hot_rows`` facts in a batch, counted when first asked for and once for each set of keys.

    Lookups that follow each other neither add nor drop facts, so one count over the plain facts serves
    all of them, and none evaluates the lookups before it to count them again.
    """

    def __init__(self, facts: DataFrame, hot_rows: int = HOT_ROWS):
        self.facts, self.hot_rows = facts, hot_rows
        self._found: dict[tuple[str, ...], DataFrame | None] = {}

    def of(self, keys: Sequence[str]) -> DataFrame | None:
        """The keys with the ``_salts`` their count calls for, the hottest ``PINNED_ROWS`` of them; None without any."""
        at = tuple(keys)
        if at not in self._found:
            counts = self.facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > self.hot_rows)
            salts = F.ceil(F.col("_n") / self.hot_rows).cast("int").alias("_salts")
            hot = counts.select(*keys, salts).orderBy(F.desc("_salts"), *keys).limit(PINNED_ROWS)
            rows = hot.collect()
            self._found[at] = F.broadcast(self.facts.sparkSession.createDataFrame(rows, hot.schema)) if rows else None
        return self._found[at]


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    residual: Column | None = None,
    *,
    max_broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    small: bool | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Left equi-join on ``keys``, with a further condition if given.

    A dimension counted to be small is broadcast; ``small`` says what was counted before. Beyond that both sides are
    exchanged by key, and keys with more than ``hot_rows`` facts are split: their
    facts get a salt out of as many as their count calls for, and only their
    dimension rows are copied per salt. The hottest ``PINNED_ROWS`` such keys are
    split; any other has less than that share of the facts. Without such keys the join is a plain one, so that
    lookups by one key share their exchange. ``hot`` holds the counts of lookups that share them. A stream cannot be
    counted ahead; there all facts are salted.
    """
    if is_small(dim, max_broadcast_rows) if small is None else small:
        return _left(fact, F.broadcast(dim), list(keys), residual)
    if fact.isStreaming:
        salted = _salted(fact, F.lit(STREAM_SALTS))
        copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(STREAM_SALTS - 1))))
    else:
        hottest = (hot or HotKeys(fact, hot_rows)).of(keys)
        if hottest is None:
            return _left(fact, dim, list(keys), residual)
        salts = F.coalesce("_salts", F.lit(1))
        # rows without a key match nothing, and must not all meet in one task
        unkeyed = reduce(or_, [F.col(k).isNull() for k in keys])
        spread = F.when(unkeyed, F.lit(NULL_SALTS)).otherwise(salts)
        salted = _salted(fact.join(hottest, list(keys), "left"), spread).drop("_salts")
        copies = (
            dim.join(hottest, list(keys), "left")
            .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
            .drop("_salts")
        )
    joined = _left(salted, copies, [*keys, "_salt"], residual)
    added = [c for c in dim.columns if c not in keys]
    return joined.select(*fact.columns, *added)


def _salted(fact: DataFrame, salts: Column) -> DataFrame:
    """Spread rows by their contents and, so that equal rows part too, by their place."""
    plain = [f.name for f in fact.schema if f.dataType.typeName() not in ("map", "variant")]
    place = F.lit(0) if fact.isStreaming else F.monotonically_increasing_id()
    return fact.withColumn("_salt", F.pmod(F.xxhash64(*plain, place), salts).cast("int"))


def _left(fact: DataFrame, dim: DataFrame, keys: list[str], residual: Column | None) -> DataFrame:
    renamed = dim.withColumnsRenamed({k: f"_dim_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & (fact[k] == F.col(f"_dim_{k}"))
    if residual is not None:
        condition = condition & residual
    joined = fact.join(renamed, condition, "left")
    return joined.drop(*[f"_dim_{k}" for k in keys])
