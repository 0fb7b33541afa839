"""Drop lines that other documents hold too, keeping each in the first document that has it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, lower_ascii, stored, text_key

OUT = ("kept_text", "n_lines", "n_dropped")


def dedup_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 10,
    min_docs: int = 2,
) -> DataFrame:
    """Add ``kept_text``, ``n_lines`` and ``n_dropped`` to every row of ``docs``.

    Lines are what lies between ``\\n``; their key has white space stripped at both
    ends and A-Z lower-cased. A key of at least ``min_chars`` characters found in at
    least ``min_docs`` documents stays only in the document of the smallest id that
    holds it, there in all its places. All other lines stay, in their order.

    Null or empty text: one empty line, kept text ``''``. A null id is a document of
    its own that comes after all others; rows of one id are one document, and each is
    answered. Input columns named like an added one are replaced by it. A line's
    key travels as a 128-bit hash, its document count as a distinct count per key.
    """
    taken = [c for c in docs.columns if c not in OUT]
    base = docs.select(F.struct(*taken).alias("_row"), F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    key = text_key(F.col("_text"))
    base = base.select("*", key[0].alias("_t1"), key[1].alias("_t2"))

    line = F.col("_line")
    folded = lower_ascii(F.btrim(line, F.lit(SPACES)))
    lines = (
        base.select("_id", "_t1", "_t2", F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_line"))
        .filter(F.length(line) >= min_chars)
        .select("_id", "_t1", "_t2", "_pos", folded.alias("_key"))
        .filter(F.length("_key") >= min_chars)
    )
    h = text_key(F.col("_key"))
    lines = lines.select("_id", "_t1", "_t2", "_pos", h[0].alias("_h1"), h[1].alias("_h2"))

    many = [F.min("_id").alias("_first"), F.max("_id").alias("_last"), F.max(F.col("_id").isNull()).alias("_null")]
    if min_docs == 2:  # two different ids show in the extremes: no distinct count to shuffle
        groups = lines.groupBy("_h1", "_h2").agg(*many)
        repeated = groups.filter((F.col("_first") < F.col("_last")) | (F.col("_null") & F.col("_first").isNotNull()))
    else:
        once = lines.groupBy("_h1", "_h2", "_id").agg(F.lit(1).alias("_n"))  # a document's repeats go first
        groups = once.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_docs"), *many)
        repeated = groups.filter(F.col("_docs") >= min_docs)
    repeated = stored(repeated.select("_h1", "_h2", "_first"), "repeated-lines")

    # both sides come straight from a scan, so that Spark can split a hot line's rows
    drops = lines.join(repeated.withColumnsRenamed({"_h1": "_r1", "_h2": "_r2"}), (F.col("_h1") == F.col("_r1")) & (F.col("_h2") == F.col("_r2")))
    drops = drops.filter(F.coalesce(F.col("_id") != F.col("_first"), F.col("_first").isNotNull()))
    drops = drops.groupBy("_id", "_t1", "_t2").agg(F.collect_set("_pos").alias("_drop"))
    drops = drops.select(F.col("_id").alias("_d"), F.col("_t1").alias("_d1"), F.col("_t2").alias("_d2"), "_drop")

    same = F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_t1") == F.col("_d1")) & (F.col("_t2") == F.col("_d2"))
    split = base.join(drops, same, "left").select("_row", "_text", F.split("_text", "\n", -1).alias("_lines"), "_drop")
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop"))
    text = F.array_join(F.transform(kept, lambda i: F.element_at("_lines", i + 1)), "\n")
    return split.select(
        "_row.*",
        F.when(F.col("_drop").isNull(), F.col("_text")).otherwise(text).alias("kept_text"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"),
    )
