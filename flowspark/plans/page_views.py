"""Page views per minute into the feature table, as a batch or a stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.windows import require_nonempty, windowed_counts
from ..sources.hash_store import compact_hash, hash_rows, read_hash, upsert_hash
from ..sources.records import bad_page_views, parse_page_views, start
from ..streaming.late import part, split_late

WATERMARK = "10 minutes"


def page_view_counts(views: DataFrame, path: str, *, batch_id: int, key: str = "page") -> DataFrame:
    """Count a batch of views, store the counts, and return the table after checking it."""
    spark = views.sparkSession
    upsert_hash(windowed_counts(views, key), batch_id, path)
    require_nonempty(hash_rows(spark, path, "click_count:"), "click_count hashes")  # one stored row is enough to know
    return read_hash(spark, path, "click_count:")


def stream_page_view_counts(
    views: DataFrame,
    path: str,
    checkpoint: str,
    *,
    key: str = "page",
    watermark: str = WATERMARK,
    compact_every: int = 100,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep the table up to date from a stream; a window's count is rewritten as it grows.

    Every ``compact_every`` batches the job merges what it has written.
    """
    counts = windowed_counts(views, key, watermark=watermark)

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_hash(batch, batch_id, path)
        if (batch_id + 1) % compact_every == 0:
            compact_hash(batch.sparkSession, path)

    return start(counts.writeStream.outputMode("update").foreachBatch(write), checkpoint, available_now=available_now)


def count_records(
    records: DataFrame,
    path: str,
    *,
    watermark: dt.timedelta = dt.timedelta(minutes=10),
    compact_every: int = 100,
    available_now: bool = False,
) -> tuple[StreamingQuery, StreamingQuery]:
    """From topic records to the table: every record is counted, late, or set aside with a reason.

    The first query parses the records (column ``value``), sets bad ones aside under ``path/bad`` and splits the
    views by the watermark in force (``split_late``, under ``path/views``). The
    second counts those in time into ``path/table``: it sees no late ones, so its own watermark
    only frees its state.
    """
    spark = records.sparkSession

    def set_aside(batch: DataFrame, batch_id: int) -> None:
        bad_page_views(batch).write.mode("overwrite").parquet(f"{path}/bad/batch_id={batch_id}")

    aside = start(records.writeStream.foreachBatch(set_aside), f"{path}/checkpoints/bad", available_now=available_now)
    views = parse_page_views(records)
    split = split_late(views, f"{path}/views", f"{path}/checkpoints/split", delay=watermark, available_now=available_now)
    if available_now:
        aside.awaitTermination()
        split.awaitTermination()
    in_time = spark.readStream.schema(views.schema).parquet(part(f"{path}/views", late=False))
    delay = f"{int(watermark.total_seconds())} seconds"
    counted = stream_page_view_counts(
        in_time, f"{path}/table", f"{path}/checkpoints/counts", watermark=delay, compact_every=compact_every, available_now=available_now
    )
    return split, counted
