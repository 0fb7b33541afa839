"""Query of the personal-data search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .pii import KINDS, find_pii
from .registry import query


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op7_pii")
def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_pii(docs).withColumn("base", F.filter("spans", lambda s: s["base"]))
    kinds = F.transform("base", lambda s: s["kind"])
    count = {f"n_{k}": (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long") for k in KINDS}
    return found.select(
        "doc_id",
        *(c.alias(n) for n, c in count.items()),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
