"""Helpers shared by the corpus operators: stored tables, text identity, distributed ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.session import work_dir

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What the contracts strip and split at: \x20 and \x09-\x0D.
SPACES = " \t\n\x0b\x0c\r"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read again; cuts the lineage."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: Column) -> list[Column]:
    """Two independent 64-bit hashes; together they stand for the text."""
    return [F.xxhash64(text), F.xxhash64(F.lit(7), text)]


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else; whole-ASCII strings take the fast path."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def global_rank(df: DataFrame, order: Sequence[str], out: str, name: str) -> DataFrame:
    """Gapless position from 0 in the order of ``order``, without one task seeing all rows.

    Rows are dealt by range and stored with their place in their partition; the
    partitions' row counts, one row each, give the offsets. ``order`` should tell
    rows apart, so that equal keys cannot pile up in one range.
    """
    place = F.monotonically_increasing_id()
    rows = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.shiftright(place, 33).cast("int"))
        .withColumn("_place", place.bitwiseAND(F.lit((1 << 33) - 1)))
    )
    rows = stored(rows, name)
    counts = sorted(tuple(r) for r in rows.groupBy("_part").count().collect())
    before, offsets = 0, []
    for part, n in counts:
        offsets.append((part, before))
        before += n
    offsets = df.sparkSession.createDataFrame(offsets, "_part int, _before bigint")
    return rows.join(F.broadcast(offsets), "_part").withColumn(out, F.col("_place") + F.col("_before")).drop("_part", "_place", "_before")


#: Bits of one row of a bitmap, as ``bitmap_construct_agg`` makes it.
_MAP_BITS = 1 << 15


def among(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` is among ``ids`` (one column of the same type), and few others; no row of ``df`` is exchanged.

    The ids are hashed into a bitmap that every task holds: at least 16 bits an id, so that one other row in 16 stays,
    up to 16 MiB in all. A join has to follow; this only spares it the rows that it would drop.
    """
    n = ids.count()
    bits = min(max(1 << (16 * n).bit_length(), _MAP_BITS), 1 << 27)

    def place(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(bits))

    (name,) = ids.columns
    marks = ids.filter(F.col(name).isNotNull()).select(F.shiftright(place(name), 15).alias("_map"), (place(name) % _MAP_BITS).alias("_bit"))
    # the marks move before they become maps, as a map of each task would be larger
    maps = marks.repartition("_map").groupBy("_map").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    at = place(column) % _MAP_BITS
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = F.getbit(byte, (at % 8).cast("int")) == 1
    found = df.join(F.broadcast(maps), F.shiftright(place(column), 15) == F.col("_map"))
    return found.filter(marked).select(*df.columns)
