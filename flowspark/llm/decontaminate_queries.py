"""Query of the benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontaminate import decontaminate
from .registry import query


@query("op1_decontaminate")
def leaked_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the benchmark items it holds and where (``item:start:end:edits``)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    spans = F.transform("passages", lambda p: F.concat_ws(":", p["item_id"], p["start"], p["end"], p["edits"]))
    return found.select(
        "doc_id",
        "contaminated",
        F.array_sort(F.array_distinct("passages.item_id")).alias("items"),
        F.array_join(spans, ",").alias("spans"),
        F.sha2("clean_text", 256).alias("clean_sha256"),
    )
