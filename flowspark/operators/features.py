"""Feature vectors: assembly, scaling, and fitting the scaler and the label codec."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.schema import COLUMNS, MEANS, N_FEATURES, SCALES
from ..functions.vectors import scaled


def assemble(df: DataFrame, columns: Sequence[str] = COLUMNS, out: str = "features") -> DataFrame:
    """Collect the columns, narrowed to float32, into one vector in their order."""
    floats = ", ".join(f"CAST(`{c}` AS float)" for c in columns)
    return df.withColumn(out, F.expr(f"array({floats})"))


def scale(
    df: DataFrame,
    mean: Sequence[float] = MEANS,
    std: Sequence[float] = SCALES,
    *,
    guard_zero: bool = False,
    strict: bool = False,
    vector: str = "features",
) -> DataFrame:
    """Standardise the vector column in place.

    A vector of another length becomes NULL, for the caller to set aside; with
    ``strict`` it fails the job instead.
    """
    n = len(mean)
    wrong = (
        f"CAST(raise_error(concat('expected {n} features, got ', size({vector}))) AS array<float>)"
        if strict
        else "CAST(NULL AS array<float>)"
    )
    value = scaled(vector, mean, std, guard_zero=guard_zero)
    text = f"CASE WHEN size({vector}) = {n} THEN {value} ELSE {wrong} END"
    return df.withColumn(vector, F.expr(text))


def identity_scaler(n: int = N_FEATURES) -> tuple[list[float], list[float]]:
    """Means 0 and deviations 1: scaling that changes nothing."""
    return [0.0] * n, [1.0] * n


def fit_scaler(df: DataFrame, vector: str = "features") -> DataFrame:
    """Mean and population deviation per position: ``(pos, mean, std)``; deviation 0 counts as 1.

    One aggregate over the vector column, merged map-side; only one summary per
    task is exchanged, whatever the number of rows.
    """
    stats = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("v")).agg(
        Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("s")
    )
    n = F.col("s.count").cast("double")
    # the summary has the sample variance; the scaler is defined on the population's
    variance = F.transform(vector_to_array("s.variance"), lambda x: x * (n - 1) / n)
    pairs = F.zip_with(
        vector_to_array("s.mean"), variance, lambda m, v: F.struct(m.alias("mean"), v.alias("var"))
    )
    std = F.sqrt("p.var")
    return stats.select(F.posexplode(pairs).alias("pos", "p")).select(
        "pos",
        F.col("p.mean").alias("mean"),
        F.when(std == 0, F.lit(1.0)).otherwise(std).alias("std"),
    )


def scaler_constants(fitted: DataFrame) -> tuple[list[float], list[float]]:
    """Bring a fitted scaler to the driver: one row per vector position."""
    rows = sorted(fitted.collect())
    return [r["mean"] for r in rows], [r["std"] for r in rows]


def fit_labels(df: DataFrame, label: str) -> DataFrame:
    """Sorted distinct labels numbered from 0: ``(label, class_index)``.

    The labels are made distinct in parallel first, so the numbering sees one row
    per class of the model, not one per record.
    """
    distinct = df.select(F.col(label).alias("label")).where("label IS NOT NULL").distinct()
    index = F.row_number().over(W.orderBy("label")) - 1
    return distinct.select("label", index.alias("class_index"))
