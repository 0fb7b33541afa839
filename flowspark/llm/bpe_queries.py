"""Query of the byte-level BPE."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import encode_bytes
from .common import table
from .registry import query

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op8_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(encode_bytes(docs, RANKS, public_tokenizers.PATTERN))
