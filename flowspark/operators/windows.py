"""Event-time counts per key, shaped as rows of the feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.schema import COUNT_PREFIX


def field_text(start: Column) -> Column:
    """Window start as it names a field: ``2025-06-10T05:04:00``."""
    return F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss")


def hash_key(name: Column, prefix: str = COUNT_PREFIX) -> Column:
    return F.concat(F.lit(prefix), name)


def strip_prefix(key: Column, prefix: str = COUNT_PREFIX) -> Column:
    """The name a key was built from, NULL for keys with another prefix."""
    return F.when(key.startswith(prefix), F.substring(key, F.lit(len(prefix) + 1), F.length(key)))


def windowed_counts(
    df: DataFrame,
    key: str,
    ts: str = "ts",
    width: str = "1 minute",
    *,
    watermark: str | None = None,
) -> DataFrame:
    """Rows per key and tumbling window: ``(key, field, value)``.

    Counts are combined before the one exchange, so a page with a third of all
    views sends one row per window and task. With ``watermark`` the state of a
    stream is dropped once windows are that far behind.
    """
    rows = df.select(F.col(key).alias("_name"), F.col(ts).cast("timestamp").alias("_ts"))
    if watermark:
        rows = rows.withWatermark("_ts", watermark)
    counts = rows.groupBy(F.window("_ts", width).alias("_w"), "_name").agg(
        F.count(F.lit(1)).alias("value")
    )
    return counts.select(
        hash_key(F.col("_name")).alias("key"), field_text(F.col("_w.start")).alias("field"), "value"
    )


def require_nonempty(df: DataFrame, name: str) -> DataFrame:
    """Raise ``ValueError`` if there is no row; looks for one row only."""
    if df.isEmpty():
        raise ValueError(f"no {name} found")
    return df


def nonempty_report(df: DataFrame, name: str) -> DataFrame:
    """The same check as a row ``(check, passed, n)``."""
    return df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(name).alias("check"), (F.col("n") > 0).alias("passed"), "n"
    )
