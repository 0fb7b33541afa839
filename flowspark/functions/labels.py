"""Class labels: index to label and back, spelling, severity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import (
    CLASSES,
    SEVERITIES,
    TRAFFIC_LABELS,
    UNKNOWN_LABEL,
    UNKNOWN_SEVERITY,
)


def _literals(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def decode_label(index: Column, classes: Sequence[str] = CLASSES) -> Column:
    """Class index -> label; anything out of range, or NULL, is ``Unknown``."""
    # get() is zero-based and NULL out of range, negative indexes included.
    return F.coalesce(F.get(_literals(classes), index.cast("int")), F.lit(UNKNOWN_LABEL))


def encode_label(label: Column, classes: Sequence[str] = CLASSES) -> Column:
    """Label -> class index, -1 if it is no class; exact and case-sensitive."""
    return (F.coalesce(F.array_position(_literals(classes), label), F.lit(0)) - 1).cast("int")


def normalise_label(label: Column) -> Column:
    """Traffic-generator spelling -> model class; model classes map to themselves."""
    spelling = {**{c: c for c in CLASSES}, **TRAFFIC_LABELS}
    pairs = [F.lit(x) for pair in spelling.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), label), F.lit(UNKNOWN_LABEL))


def severity(label: Column) -> Column:
    """HIGH, MEDIUM or LOW by attack class, UNKNOWN for every other label."""
    by_level: dict[str, list[str]] = {}
    for name, level in SEVERITIES.items():
        by_level.setdefault(level, []).append(name)
    out = F.lit(None).cast("string")
    for level, names in by_level.items():
        out = F.when(label.isin(names), level).otherwise(out)
    return F.coalesce(out, F.lit(UNKNOWN_SEVERITY))


def classes(spark: SparkSession, names: Sequence[str] = CLASSES) -> DataFrame:
    """The class vocabulary as a table ``(class_index INT, label STRING)``."""
    return spark.range(1).select(F.posexplode(_literals(names)).alias("class_index", "label"))
