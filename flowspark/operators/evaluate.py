"""Training-set preparation and classifier evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.schema import CLASSES
from .joins import PINNED_ROWS, pinned


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column)


def profile(df: DataFrame) -> DataFrame:
    """``(column, n_rows, n_columns, n_nulls)`` from one pass over the table."""
    names = df.columns
    stats = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(names)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("_n").alias("n_rows"),
            F.lit(len(names)).cast("bigint").alias("n_columns"),
            F.col(f"_{i}").alias("n_nulls"),
        )
        for i, c in enumerate(names)
    ]
    return stats.select(F.inline(F.array(*rows)))


def stratified_split(
    df: DataFrame, label: str, *, by: str, train: float = 0.8, seed: int = 42
) -> DataFrame:
    """Add ``split``: exactly ``round(train * n)`` rows of each label go to ``train``.

    Rows are ranked by a hash of ``by`` (a unique id). Counting the hash in 65,536
    ranges tells in which range the cut of each label falls; rows before and after
    it are decided where they are, and only those within it, one in 65,536, are
    sorted. A label with most of the rows needs no large sort and no exchange of
    the rows.
    """
    digest = F.md5(F.concat_ws(":", F.col(by).cast("string"), F.lit(str(seed))))
    rows = df.withColumn("_digest", digest).withColumn("_range", F.substring("_digest", 1, 4))
    per_label = W.partitionBy("_label")
    upto = per_label.orderBy("_range").rowsBetween(W.unboundedPreceding, 0)
    counts = (
        rows.groupBy(F.col(label).alias("_label"), F.col("_range").alias("_cut"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumnRenamed("_cut", "_range")
        .withColumn("_upto", F.sum("_n").over(upto))
        .withColumn("_quota", F.round(F.sum("_n").over(per_label) * F.lit(train)).cast("bigint"))
    )
    # per label the first range that reaches the quota, and what it may still take
    cut = (
        counts.filter("_upto >= _quota")
        .groupBy("_label")
        .agg(
            F.min("_range").alias("_cut"),
            F.min_by(F.col("_quota") - (F.col("_upto") - F.col("_n")), "_range").alias("_left"),
        )
    )
    placed = rows.join(pinned(cut, PINNED_ROWS), F.col(label).eqNullSafe(F.col("_label")))
    decided = placed.filter("_range <> _cut").withColumn(
        "split", F.when(F.col("_range") < F.col("_cut"), "train").otherwise("test")
    )
    rank = F.row_number().over(W.partitionBy("_label", "_range").orderBy("_digest", by))
    at_cut = placed.filter("_range = _cut").withColumn(
        "split", F.when(rank <= F.col("_left"), "train").otherwise("test")
    )
    return decided.unionByName(at_cut).drop("_digest", "_range", "_label", "_cut", "_left")


def sampled_split(df: DataFrame, label: str, classes: Sequence, *, train: float = 0.8, seed: int = 42) -> DataFrame:
    """Training sample with about ``train`` of each class, from one pass."""
    return df.sampleBy(label, {c: train for c in classes}, seed)


def confusion(
    df: DataFrame, classes: Sequence = CLASSES, *, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """One row per actual class, one column per predicted class."""
    wide = df.groupBy(actual).pivot(predicted, list(classes)).agg(F.count(F.lit(1)))
    return wide.na.fill(0)


def class_metrics(df: DataFrame, *, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """``(label, support, precision, recall, f1, accuracy)`` per class.

    Counts per pair of classes are formed first; everything else works on those.
    A ratio without a denominator is 0.
    """
    pairs = df.groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    hit = F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.inline(
        F.array(
            F.struct(F.col("a").alias("label"), F.col("n").alias("actual_n"), F.lit(0).cast("bigint").alias("predicted_n"), hit.alias("hits")),
            F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("actual_n"), F.col("n").alias("predicted_n"), F.lit(0).cast("bigint").alias("hits")),
        )
    )
    sums = pairs.select(sides).groupBy("label").agg(
        F.sum("actual_n").alias("support"),
        F.sum("predicted_n").alias("predicted_n"),
        F.sum("hits").alias("hits"),
    )
    # one row per class from here on
    every = W.partitionBy(F.lit(0))

    def share(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    precision = share(F.col("hits"), F.col("predicted_n"))
    recall = share(F.col("hits"), F.col("support"))
    return sums.select(
        "label",
        "support",
        precision.alias("precision"),
        recall.alias("recall"),
        share(2 * precision * recall, precision + recall).alias("f1"),
        share(F.sum("hits").over(every), F.sum("support").over(every)).alias("accuracy"),
    )


def compare_predictions(
    online: DataFrame, offline: DataFrame, key: str, *, label: str = "label", confidence: str = "confidence"
) -> DataFrame:
    """Both predictions per key with ``presence``, ``same_label`` and ``gap``."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            key,
            F.col(label).alias(f"{name}_label"),
            F.col(confidence).cast("double").alias(f"{name}_confidence"),
            F.lit(True).alias(f"_{name}"),
        )

    both = side(online, "online").join(side(offline, "offline"), key, "full_outer")
    presence = (
        F.when(F.col("_offline").isNull(), "online_only")
        .when(F.col("_online").isNull(), "offline_only")
        .otherwise("both")
    )
    return both.select(
        key,
        "online_label",
        "offline_label",
        presence.alias("presence"),
        F.col("online_label").eqNullSafe(F.col("offline_label")).alias("same_label"),
        F.abs(F.col("online_confidence") - F.col("offline_confidence")).alias("gap"),
    )


def mismatches(compared: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    """Keys on one side only, with other labels, or with confidences further apart."""
    apart = F.coalesce(F.col("gap") > tolerance, F.lit(True))
    return compared.filter((F.col("presence") != "both") | ~F.col("same_label") | apart)


def reconcile(
    online: DataFrame, offline: DataFrame, key: str, *, label: str = "label", confidence: str = "confidence", tolerance: float = 1e-5
) -> DataFrame:
    """``key, outcome, n_online, n_offline, gap``: what became of each record on the two sides.

    ``lost`` is missing online, ``extra`` offline; ``doubled`` has other numbers of rows on the two sides;
    ``differing`` another label or a confidence further apart than ``tolerance``, in
    any of its rows; else ``same``. Each side is one row per key before they meet,
    so a record that came a million times does not multiply. A NULL key is a record like any other.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        value = F.col(confidence).cast("double")
        return df.groupBy(F.col(key).alias("_key")).agg(
            F.count(F.lit(1)).alias(f"n_{name}"),
            F.min(label).alias("first"),
            F.max(label).alias("last"),
            F.count(label).alias("labels"),
            F.min(value).alias("least"),
            F.max(value).alias("most"),
            F.count(value).alias("values"),
        )

    a, b = side(online, "online").alias("a"), side(offline, "offline").alias("b")
    both = a.join(b, F.col("a._key").eqNullSafe(F.col("b._key")), "full_outer")
    n, m = F.coalesce("n_online", F.lit(0)), F.coalesce("n_offline", F.lit(0))
    gap = F.greatest(F.abs(F.col("a.most") - F.col("b.least")), F.abs(F.col("b.most") - F.col("a.least")))

    def equal(name: str) -> Column:
        return F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))

    labels = equal("first") & equal("last") & equal("labels")
    close = equal("values") & (F.col("a.values").eqNullSafe(0) | F.coalesce(gap <= tolerance, F.lit(False)))
    outcome = (
        F.when(n == 0, "lost")
        .when(m == 0, "extra")
        .when(n != m, "doubled")
        .when(~(labels & close), "differing")
        .otherwise("same")
    )
    return both.select(
        F.coalesce("a._key", "b._key").alias(key), outcome.alias("outcome"), n.alias("n_online"), m.alias("n_offline"), gap.alias("gap")
    )
