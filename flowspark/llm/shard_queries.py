"""Query of the sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .registry import query
from .sharding import shard_by_bytes

SHARDS = 16


@query("op3_shards")
def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 16 shards of near equal bytes; equal texts stay together."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_by_bytes(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
