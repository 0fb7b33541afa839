"""From raw documents to token ids, in five stages, each stored before the next reads it.

Of every stage: an empty table gives an empty one; rows without an id stay, unless they are rejected
for their text; repeated rows are rows of their own; other columns of ``docs`` go along unchanged whatever
they are called, up to the last stage, which has columns of its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.llm.byte_bpe import encode_bytes
from flowspark.llm.bpe_queries import RANKS
from flowspark.llm.common import stored, table
from flowspark.llm.decontaminate import find_passages
from flowspark.llm.line_dedup import dedup_lines
from flowspark.llm.near_dup import near_duplicates
from flowspark.llm.toxicity import train
from flowspark.llm.toxicity_queries import labels_of

#: Documents that score this or more go.
TOXIC = 0.5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject. Null and empty texts are scored too."""
    labels = labels_of(table(spark, sf_dir, "labels"))
    model = train(docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id").select("text", "toxic"))
    return docs.filter(model.score(docs) < TOXIC)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a document before holds; ``n_chars`` follows. Null texts stay null."""
    # the row goes along as one column, so that no name of it can clash with an added one
    kept = dedup_lines(docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row")))
    text = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    columns = {"text": text}
    if "n_chars" in docs.columns:
        changed = F.col("n_dropped") > 0
        columns["n_chars"] = F.when(changed, F.length("kept_text")).otherwise(F.col("_row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return kept.select(*[columns.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8 or more): the smallest id.

    Documents without words are not alike. Rows without an id are never another's copy.
    """
    found = near_duplicates(docs, num=80, den=100)
    gone = stored(found.filter(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct(), "near-gone")
    return docs.alias("d").join(gone.alias("gone"), F.col("d.doc_id") == F.col("gone.doc_id"), "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return docs.filter(F.size(find_passages(docs, table(spark, sf_dir, "benchmark"))) == 0)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with a digest of what they decode to."""
    encoded = encode_bytes(docs.select("doc_id", "text"), RANKS, public_tokenizers.PATTERN)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: The toxicity model is not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
