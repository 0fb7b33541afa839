"""The feature table's manifest, and late rows as rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowspark.plans.page_views import page_view_counts
from flowspark.session import list_folders
from flowspark.sources.hash_store import compact_hash, hash_rows, manifest, read_hash, upsert_hash
from flowspark.streaming.late import part, split_late

ROWS = "key string, field string, value bigint"


def batch(spark, *rows):
    return spark.createDataFrame([(k, f"2025-06-{d:02}T00:00:00", v) for k, d, v in rows], ROWS)


def state(spark, path):
    return {(r["key"], r["field"][8:10]): r["value"] for r in read_hash(spark, path).collect()}


def test_compactions_keep_the_state_and_their_readers(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        compact_hash(spark, path)
    upsert_hash(batch(spark, ("a", 1, 1), ("b", 1, 1)), 0, path)
    upsert_hash(batch(spark, ("a", 1, 2), ("a", 2, 1)), 1, path)
    old = read_hash(spark, path)
    compact_hash(spark, path)
    assert [v[0::2] for v in manifest(spark, path)] == [(0, 1)]
    assert hash_rows(spark, path).count() == 3 and old.count() == 3
    upsert_hash(batch(spark, ("a", 1, 2), ("a", 2, 1)), 1, path)  # a repeat of what is merged already
    upsert_hash(batch(spark, ("a", 1, 9), ("c", 3, 1)), 2, path)
    want = {("a", "01"): 9, ("a", "02"): 1, ("b", "01"): 1, ("c", "03"): 1}
    assert state(spark, path) == want
    # a compaction that stopped before its line in the manifest changes nothing
    batch(spark, ("x", 1, 1)).withColumn("day", F.lit("2025-06-01")).write.partitionBy("day").parquet(f"{path}/snapshots/half")
    assert state(spark, path) == want
    compact_hash(spark, path)
    compact_hash(spark, path)
    assert state(spark, path) == want and [v[0] for v in manifest(spark, path)] == [2, 1, 0]
    names = {v[1] for v in manifest(spark, path)[:2]} | {"half"}
    assert {f.rsplit("/", 1)[1] for f in list_folders(spark, f"{path}/snapshots/*")} == names
    assert list_folders(spark, f"{path}/batch_id=*") == []
    days = read_hash(spark, path, "a", first_day="2025-06-02")
    assert [tuple(r) for r in days.collect()] == [("a", "2025-06-02T00:00:00", 1)]


def test_emptiness_is_seen_before_the_table_is_merged(spark, tmp_path):
    views = spark.createDataFrame([], "page string, ts timestamp")
    with pytest.raises(ValueError, match="no click_count hashes"):
        page_view_counts(views, str(tmp_path / "t"), batch_id=0)


def test_rows_are_late_or_in_time(spark, tmp_path):
    at = lambda s: dt.datetime(2025, 6, 1, 12) + dt.timedelta(seconds=s)
    source, path, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def feed(*seconds):
        rows = [(None if s is None else at(s),) for s in seconds]
        spark.createDataFrame(rows, "ts timestamp").write.mode("append").parquet(source)
        stream = spark.readStream.schema("ts timestamp").parquet(source)
        split_late(stream, path, check, delay=dt.timedelta(seconds=60), available_now=True).awaitTermination()

    def seconds(late):
        rows = spark.read.schema("ts timestamp").parquet(part(path, late=late)).select(F.unix_seconds("ts")).collect()
        begin = int(at(0).replace(tzinfo=dt.timezone.utc).timestamp())
        return sorted((-1 if r[0] is None else r[0] - begin) for r in rows)

    feed(100, 0, None)  # nothing is late in the first batch
    feed(41, 40, 39)  # 60 s behind 100 is still in time
    feed(None)
    feed(10, 300)
    feed(240, 239)
    assert seconds(True) == [10, 39, 239]
    assert seconds(False) == [-1, -1, 0, 40, 41, 100, 240, 300]
