"""Latency histograms and percentiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .prefix import null_safe_join, prefix_sum

INFINITE = float("inf")


def histogram(
    df: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Cumulative counts ``(by, le, count)`` for each upper bound, empty buckets included.

    One conditional count per bound in a single aggregate: the partial counts are
    all that is exchanged.
    """
    edges = [float(b) for b in sorted(bounds)]
    if not edges or edges[-1] != INFINITE:
        edges.append(INFINITE)
    counts = [F.count_if(F.col(value) <= b).alias(f"c{i}") for i, b in enumerate(edges)]
    rows = F.array(
        *[F.struct(F.lit(b).alias("le"), F.col(f"c{i}").alias("count")) for i, b in enumerate(edges)]
    )
    return df.groupBy(*by).agg(*counts).select(*by, F.inline(rows))


def histogram_quantile(
    buckets: DataFrame, q: float, by: Sequence[str] = (), count: str = "count"
) -> DataFrame:
    """Quantile by straight-line interpolation in the bucket that holds the rank.

    The lowest bucket starts at zero; in the infinite one the answer is the highest
    finite bound. Counts that fall from one bucket to the next, as extrapolated rates
    may, are raised to the one before, so the rank goes by the last bucket. Groups
    without observations have no result. A group holds one row per bucket.
    """
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    ordered = group.orderBy("le")
    rising = F.max(F.col(count).cast("double")).over(ordered)
    c = F.col("c")
    rank = F.lit(float(q)) * F.max(c).over(group)
    rows = buckets.select(*by, "le", rising.alias("c")).select(
        *by,
        "le",
        "c",
        F.lag("le").over(ordered).alias("lower"),
        F.coalesce(F.lag(c).over(ordered), F.lit(0.0)).alias("below"),
        rank.alias("rank"),
        F.max(c).over(group).alias("total"),
    )
    hit = rows.filter("total > 0 AND c >= rank").groupBy(*by).agg(
        F.min_by(F.struct("le", "c", "lower", "below", "rank"), "le").alias("b")
    )
    lower = F.coalesce("b.lower", F.lit(0.0))
    inside = lower + (F.col("b.le") - lower) * F.coalesce(
        F.try_divide(F.col("b.rank") - F.col("b.below"), F.col("b.c") - F.col("b.below")), F.lit(0.0)
    )
    value = (
        F.when(F.col("b.le") == INFINITE, F.col("b.lower"))
        .when(F.col("b.lower").isNull() & (F.col("b.le") <= 0), F.col("b.le"))
        .otherwise(inside)
    )
    return hit.select(*by, value.alias("value"))


def bucket_quantile(buckets: Column, q: Column) -> Column:
    """The same for the buckets of one group as an array of ``le, count``; NULL without observations."""
    ordered = F.array_sort(buckets)
    raised = F.transform(
        ordered, lambda b, i: F.struct(b["le"].alias("le"), F.array_max(F.transform(F.slice(ordered, 1, i + 1), lambda x: x["count"])).alias("c"))
    )
    total = F.get(raised, F.size(raised) - 1)["c"]
    rank = q * total
    lowers = F.filter(raised, lambda b: b["c"] < rank)
    hit, before = F.get(raised, F.size(lowers)), F.get(raised, F.size(lowers) - 1)
    lower, below = F.coalesce(before["le"], F.lit(0.0)), F.coalesce(before["c"], F.lit(0.0))
    inside = lower + (hit["le"] - lower) * F.coalesce(F.try_divide(rank - below, hit["c"] - below), F.lit(0.0))
    value = F.when(hit["le"] == INFINITE, before["le"]).when(before.isNull() & (hit["le"] <= 0), hit["le"]).otherwise(inside)
    return F.when(total > 0, value)


def exact_quantiles(
    df: DataFrame, value: str, qs: Sequence[float], by: Sequence[str], chunk: Column
) -> DataFrame:
    """Interpolated quantiles ``(by, q, value)`` of a column with repeated values.

    Counts per distinct value come first, then their running totals in pieces
    (``chunk``, rising with the value), so no task holds the values of a group.
    """
    if not by:
        whole = exact_quantiles(df.withColumn("_all", F.lit(0)), value, qs, ["_all"], chunk)
        return whole.drop("_all")
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("v")).agg(
        F.count(F.lit(1)).alias("n")
    )
    running = prefix_sum(counts, by, ["v"], F.col("n"), chunk, "upto")
    totals = counts.groupBy(*by).agg(F.sum("n").alias("total"))
    ranked = null_safe_join(running, totals, by)
    wanted = F.array(*[F.lit(float(q)) for q in qs])
    rows = ranked.withColumn("q", F.explode(wanted)).withColumn(
        "pos", F.col("q") * (F.col("total") - 1)
    )
    low, high = F.floor("pos"), F.ceil("pos")
    start, stop = F.col("upto") - F.col("n"), F.col("upto") - 1  # 0-based ranks of this value
    return (
        rows.withColumn("is_low", (low >= start) & (low <= stop))
        .withColumn("is_high", (high >= start) & (high <= stop))
        .filter("is_low OR is_high")
        .groupBy(*by, "q")
        .agg(
            F.max(F.when(F.col("is_low"), F.col("v"))).alias("a"),
            F.max(F.when(F.col("is_high"), F.col("v"))).alias("b"),
            F.max("pos").alias("pos"),
        )
        .select(
            *by,
            "q",
            (F.col("a") + (F.col("b") - F.col("a")) * (F.col("pos") - F.floor("pos")))
            .cast("double")
            .alias("value"),
        )
    )


SKETCH_K = 2000


def rank_error(k: int = SKETCH_K) -> float:
    """How far a sketch's quantile may lie from the rank asked for, in 99 of 100 cases; merging does not add to it."""
    return 2.296 / k**0.9021


def sketch_windows(df: DataFrame, value: str, ts: str, width: str, by: Sequence[str] = (), *, k: int = SKETCH_K) -> DataFrame:
    """``(by, start, n, sketch)``: one quantile sketch per group and window, to be stored as a sample.

    A sketch has at most some ``4 k`` values whatever it has seen, and is built before the
    exchange: a window with a third of all rows sends one per task. NULL values do not count.
    """
    rows = df.filter(F.col(value).isNotNull())
    start = F.window(F.col(ts).cast("timestamp"), width)["start"]
    return rows.groupBy(*by, start.alias("start")).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch")
    )


def merged_quantile(sketches: DataFrame, q: float, by: Sequence[str] = (), *, k: int = SKETCH_K) -> DataFrame:
    """``(by, n, value)``: a quantile over any span of stored sketches, within ``rank_error``."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("_all"))
    return merged.select(*by, "n", F.kll_sketch_get_quantile_double("_all", F.lit(float(q))).alias("value"))
