"""Running totals that do not put a whole key into one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def prefix_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    chunk: Column,
    out: str,
) -> DataFrame:
    """Running sum of ``value`` along ``order`` within ``keys``, current row included.

    ``chunk`` cuts each key into pieces and must rise with ``order`` (a day of a
    time stamp, a bucket of a number). Rows are summed within their piece; the
    totals of the earlier pieces, one row per piece, are added afterwards. A key
    with a third of all rows is thus spread over as many tasks as it has pieces.
    """
    by = [*keys, "_chunk"]
    rows = df.withColumn("_value", value).withColumn("_chunk", chunk)
    before = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    before = before.orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*by)
        .agg(F.sum("_value").alias("_total"))
        .withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0)))
        .drop("_total")
    )
    within = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    running = rows.withColumn("_running", F.sum("_value").over(within))
    return (
        null_safe_join(running, offsets, by)
        .withColumn(out, F.col("_running") + F.col("_before"))
        .drop("_value", "_chunk", "_running", "_before")
    )


def null_safe_join(rows: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join in which NULL keys match each other, as they do when grouping."""
    right = groups.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = reduce(and_, [rows[k].eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return rows.join(right, condition).drop(*[f"_right_{k}" for k in keys])
