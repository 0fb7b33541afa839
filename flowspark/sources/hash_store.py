"""Keyed feature table: fields per key, last write wins.

Each batch is a folder of its own, ``batch_id=<n>/day=<field day>``. Writing a
batch again replaces just that folder, so a repeated batch changes nothing, and
no file is rewritten that somebody may be reading. A compaction merges all batches up
to one into a new folder ``snapshots/<name>`` and then appends a line to the manifest,
which names the snapshot and that batch: readers switch at once. Reading merges the
newest snapshot with the batches after it, by the newest batch per key and field.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import list_folders, remove_folder

_SCHEMA = "key string, field string, value bigint"
_MANIFEST = "version bigint, snapshot string, upto bigint"


def upsert_hash(batch: DataFrame, batch_id: int, path: str) -> None:
    """Store a batch of ``(key, field, value)``; fit for ``foreachBatch``.

    Batch ids must rise, as those of one streaming query do: one table per checkpoint.
    """
    rows = batch.select("key", "field", "value", F.substring("field", 1, 10).alias("day"))
    rows.write.mode("overwrite").partitionBy("day").parquet(f"{path}/batch_id={batch_id}")


def _batches(spark: SparkSession, path: str) -> dict[int, str]:
    found = list_folders(spark, f"{path}/batch_id=*")
    return {int(f.rsplit("=", 1)[1]): f for f in found}


def manifest(spark: SparkSession, path: str) -> list[tuple[int, str, int]]:
    """``(version, snapshot, upto)`` of the compactions, newest first."""
    if not list_folders(spark, f"{path}/manifest"):
        return []
    lines = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest").collect()
    return sorted((tuple(r) for r in lines), key=lambda r: (r[0], r[2], r[1]), reverse=True)


def hash_rows(
    spark: SparkSession,
    path: str,
    prefix: str | None = None,
    *,
    first_day: str | None = None,
    last_day: str | None = None,
) -> DataFrame:
    """Stored ``(key, field, value, batch_id)`` that reading merges: the snapshot and the batches after it."""
    versions = manifest(spark, path)
    upto = versions[0][2] if versions else -1
    tail = [f for n, f in _batches(spark, path).items() if n > upto]
    days = spark.read.schema(f"{_SCHEMA}, batch_id bigint, day string")
    rows = days.option("basePath", path).parquet(*tail) if tail else spark.createDataFrame([], f"{_SCHEMA}, batch_id bigint, day string")
    if versions:
        base = f"{path}/snapshots/{versions[0][1]}"
        old = spark.read.schema(f"{_SCHEMA}, day string").option("basePath", base).parquet(base)
        rows = old.select("key", "field", "value", F.lit(upto).cast("bigint").alias("batch_id"), "day").unionByName(rows)
    if prefix is not None:
        rows = rows.filter(F.col("key").startswith(prefix))
    if first_day is not None:
        rows = rows.filter(F.col("day") >= first_day)
    if last_day is not None:
        rows = rows.filter(F.col("day") <= last_day)
    return rows


def read_hash(
    spark: SparkSession,
    path: str,
    prefix: str | None = None,
    *,
    first_day: str | None = None,
    last_day: str | None = None,
) -> DataFrame:
    """Current ``(key, field, value)`` of keys with ``prefix``; days outside are not read."""
    rows = hash_rows(spark, path, prefix, first_day=first_day, last_day=last_day)
    return rows.groupBy("key", "field").agg(F.max_by("value", "batch_id").alias("value"))


def compact_hash(spark: SparkSession, path: str, *, keep: int = 2) -> None:
    """Merge everything stored so far into a snapshot and switch readers to it.

    The snapshot is complete before the manifest names it, so a compaction that
    fails leaves the table as it was, and one that is repeated only adds a version. The
    last ``keep`` versions stay readable with what belongs to them; a reader that started
    before that many compactions has to start again. Older snapshots and batches are removed.
    """
    if keep < 1:
        raise ValueError("the newest version has to stay")
    versions, batches = manifest(spark, path), _batches(spark, path)
    newest = max([*batches, *(v[2] for v in versions)], default=None)
    if newest is None:
        raise ValueError(f"nothing stored under {path}")
    name = uuid.uuid4().hex
    rows = read_hash(spark, path).withColumn("day", F.substring("field", 1, 10))
    rows.write.partitionBy("day").parquet(f"{path}/snapshots/{name}")
    version = versions[0][0] + 1 if versions else 0
    line = spark.createDataFrame([(version, name, newest)], _MANIFEST)
    line.coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    kept = [(version, name, newest), *versions][:keep]
    named = {v[1] for v in kept}
    for folder in list_folders(spark, f"{path}/snapshots/*"):
        if folder.rsplit("/", 1)[1] in {v[1] for v in versions} - named:
            remove_folder(spark, folder)
    # the oldest version kept reads the batches after it; without as many, the table before the first did
    covered = kept[-1][2] if len(kept) == keep else -1
    for n, folder in batches.items():
        if n <= covered:
            remove_folder(spark, folder)


def field_maps(rows: DataFrame) -> DataFrame:
    """``(key, day, fields)`` with a map of field to value.

    One map per day, so that its size is bounded by the windows of a day however
    long a key has been counted.
    """
    entry = F.struct("field", "value")
    return rows.groupBy("key", F.substring("field", 1, 10).alias("day")).agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("fields")
    )
