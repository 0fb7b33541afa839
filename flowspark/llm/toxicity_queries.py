"""Query of the toxicity scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .registry import query
from .toxicity import TRAIN_ROWS, ToxicityModel, train


def held_out(doc_id: Column) -> Column:
    """Every fifth document by checksum of its id; labels are never learned from them. A null id: not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labels_of(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` to learn from: not held out, at most ``TRAIN_ROWS`` by a hash of the id."""
    rows = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)


def model_of(spark: SparkSession, sf_dir: str) -> ToxicityModel:
    """Trained on a bounded sample of the labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return train(docs.join(F.broadcast(labels_of(table(spark, sf_dir, "labels"))), "doc_id").select("text", "toxic"))


@query("op4_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model_of(spark, sf_dir).score(docs).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
