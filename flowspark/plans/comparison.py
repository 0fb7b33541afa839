"""Do the streaming job and the offline job predict the same?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.evaluate import compare_predictions, mismatches


def compare_online_offline(
    online: DataFrame, offline: DataFrame, key: str, *, tolerance: float = 1e-5
) -> tuple[DataFrame, DataFrame]:
    """``(summary, mismatches)`` of two tables of ``key, label, confidence``."""
    both = compare_predictions(online, offline, key)
    summary = both.groupBy("presence").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("same_label").alias("n_same_label"),
        F.max("gap").alias("max_gap"),
    )
    return summary, mismatches(both, tolerance)
