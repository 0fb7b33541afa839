"""Session enrichment by key and by address, scoring, and flagging."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.fence import once
from ..functions.network import ipv4_number
from ..functions.schema import SESSION_THRESHOLD
from ..session import ship_package, work_dir
from .joins import BROADCAST_ROWS, HOT_ROWS, HotKeys, lookup_join

_PREFIX_BITS = 16
_CELLS = 250_000


def enrich_lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str | Sequence[str],
    defaults: Mapping[str, Any],
    *,
    max_broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    small: bool | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add the columns named in ``defaults`` from ``dim``, one row per key there.

    A row without a match is kept, with the defaults. ``hot``: counts that several lookups share.
    """
    keys = [key] if isinstance(key, str) else list(key)
    joined = lookup_join(
        df,
        dim.select(*keys, *defaults),
        keys,
        max_broadcast_rows=max_broadcast_rows,
        hot_rows=hot_rows,
        small=small,
        hot=hot,
    )
    return joined.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()})


def _prefix(number: Column) -> Column:
    cell = F.lit(2**_PREFIX_BITS)
    return ((number - F.pmod(number, cell)) / cell).cast("int")


def disjoint_ranges(ranges: DataFrame) -> DataFrame:
    """``_prefix, lo, hi, country``: each address in at most one piece, that of the narrowest range around it.

    Among equally narrow ranges the lower one counts, among equal ones the first
    country by name. Ranges are cut at the 65,536 address prefixes. Only the cells in
    which some overlap are swept, each by itself; a cell holds at most one range per pair of
    addresses in it. Ranges without a bound or with ``hi`` below ``lo`` hold nothing.

    However few files hold the ranges, their cells are dealt so that a task cuts about ``_CELLS`` of them.
    """
    cell = F.lit(2**_PREFIX_BITS)
    ends = _prefix(F.col("lo")), _prefix(F.col("hi"))
    whole = ranges.filter(F.col("lo") <= F.col("hi")).select("lo", "hi", "country").distinct()
    total = whole.agg(F.sum((ends[1] - ends[0] + 1).cast("bigint"))).first()[0] or 0
    dealt = whole.repartition(-(-total // _CELLS), "lo", "hi", "country") if total > _CELLS else whole
    rows = dealt.select("lo", "hi", "country", F.explode(F.sequence(*ends)).alias("_prefix"))
    begin = F.col("_prefix").cast("bigint") * cell
    rows = rows.select(
        "_prefix",
        F.greatest("lo", begin).alias("lo"),
        F.least("hi", begin + cell - 1).alias("hi"),
        F.struct((F.col("hi") - F.col("lo")).alias("width"), F.col("lo").alias("first"), F.col("country").alias("country")).alias("_of"),
    )
    cells = rows.groupBy("_prefix", "lo", "hi").agg(F.min("_of").alias("_of"))
    before = W.partitionBy("_prefix").orderBy("lo", "hi").rowsBetween(W.unboundedPreceding, -1)
    meets = F.max("hi").over(before) >= F.col("lo")
    cells = cells.withColumn("_meets", F.max(F.coalesce(meets, F.lit(False))).over(W.partitionBy("_prefix")))
    flat = cells.select("_prefix", "lo", "hi", F.col("_of.width").alias("width"), F.col("_of.first").alias("first"), F.col("_of.country").alias("country"), "_meets")
    ship_package(ranges.sparkSession)
    swept = flat.filter("_meets").drop("_meets").groupBy("_prefix").applyInPandas(_sweep, "_prefix int, lo bigint, hi bigint, country string")
    return flat.filter("NOT _meets").select("_prefix", "lo", "hi", "country").unionByName(swept)


def _sweep(ranges: pd.DataFrame) -> pd.DataFrame:
    """Overlapping ranges of one cell -> disjoint pieces: the narrowest takes its places first, the others what is left."""
    r = ranges.sort_values(["width", "first", "country"], kind="stable", na_position="last")
    edges = np.unique(np.concatenate([r.lo, r.hi + 1]))
    first, last = np.searchsorted(edges, r.lo), np.searchsorted(edges, r.hi + 1)
    owner = np.full(len(edges) - 1, -1)
    free = list(range(len(edges)))  # the next place at or after this one that nobody has

    def find(i: int) -> int:
        while free[i] != i:
            free[i] = free[free[i]]
            i = free[i]
        return i

    for number, (a, b) in enumerate(zip(first.tolist(), last.tolist())):
        i = find(a)
        while i < b:
            owner[i] = number
            free[i] = i + 1
            i = find(i)
    cuts = np.flatnonzero(owner[1:] != owner[:-1]) + 1
    begins, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(owner)]])
    held = owner[begins] >= 0
    begins, ends = begins[held], ends[held]
    return pd.DataFrame({"_prefix": r["_prefix"].iloc[0], "lo": edges[begins], "hi": edges[ends] - 1, "country": r.country.iloc[owner[begins]].to_numpy()})


def enrich_geo(df: DataFrame, ranges: DataFrame, ip: str = "ip", **options: Any) -> DataFrame:
    """Add the country of the address range ``(lo, hi, country)`` an IPv4 text lies in.

    Of several ranges the narrowest counts, so a row never multiplies: see ``disjoint_ranges``, and
    ``enrich_pieces`` for the options.
    """
    return enrich_pieces(df, stored_pieces(ranges), ip, **options)


def stored_pieces(ranges: DataFrame) -> DataFrame:
    """``disjoint_ranges``, cut once however often they are read."""
    pieces, spark = disjoint_ranges(ranges), ranges.sparkSession
    path = work_dir(spark, "geo-pieces")
    pieces.write.parquet(path)
    return spark.read.schema(pieces.schema).parquet(path)


def enrich_pieces(
    df: DataFrame,
    pieces: DataFrame,
    ip: str = "ip",
    *,
    out: str = "country",
    default: str = "unknown",
    max_broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    small: bool | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """The same for ranges that ``disjoint_ranges`` has cut: listed by prefix, they make an equi-join of the range condition."""
    listed = pieces.select("_prefix", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("country").alias(out))

    def numbered(rows: DataFrame) -> DataFrame:
        return once(rows, _ip=ipv4_number(F.col(ip))).withColumn("_prefix", _prefix(F.col("_ip")))

    joined = lookup_join(
        numbered(df),
        listed,
        ["_prefix"],
        (F.col("_ip") >= F.col("_lo")) & (F.col("_ip") <= F.col("_hi")),
        max_broadcast_rows=max_broadcast_rows,
        hot_rows=hot_rows,
        small=small,
        hot=hot and HotKeys(numbered(hot.facts), hot.hot_rows),
    )
    found = joined.withColumn(out, F.coalesce(out, F.lit(default)))
    return found.drop("_ip", "_prefix", "_lo", "_hi")


def score_binary(
    df: DataFrame, weights: Mapping[str, float], bias: float, out: str = "score"
) -> DataFrame:
    """Logistic score of numeric columns; a NULL counts as zero."""
    terms = [
        f"coalesce(CAST(`{c}` AS double), 0D) * {float(w)!r}D" for c, w in weights.items()
    ]
    z = " + ".join([*terms, f"{float(bias)!r}D"])
    return df.withColumn(out, F.expr(f"1D / (1D + exp(-({z})))"))


def flag_sessions(df: DataFrame, threshold: float = SESSION_THRESHOLD, score: str = "score") -> DataFrame:
    """Rows that score strictly above the threshold; NaN does not."""
    return df.filter((F.col(score) > threshold) & ~F.isnan(score))


def flag_text(df: DataFrame, session: str = "session_id", score: str = "score") -> DataFrame:
    """Flags as ``<session>,<score>``."""
    text = F.concat_ws(",", F.col(session), F.col(score).cast("string"))
    return df.select(text.alias("value"))
