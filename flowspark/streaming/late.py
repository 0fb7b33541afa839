"""Late rows as rows: a stream split by the watermark in force."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation
from pyspark.sql.streaming import StreamingQuery

from ..session import list_folders
from ..sources.records import start

_NEWEST = "newest timestamp"


def _before(spark: SparkSession, path: str, batch_id: int) -> dt.datetime | None:
    """The newest time of all batches before this one; each batch notes it for the next."""
    known = {int(f.rsplit("=", 1)[1]): f for f in list_folders(spark, f"{path}/bounds/batch_id=*")}
    earlier = [n for n in known if n < batch_id]
    return spark.read.schema(_NEWEST).parquet(known[max(earlier)]).first()[0] if earlier else None


def split_late(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    *,
    ts: str = "ts",
    delay: dt.timedelta = dt.timedelta(minutes=10),
    available_now: bool = False,
) -> StreamingQuery:
    """Write a stream's rows to ``path``, late ones apart: each row is in exactly one part.

    A row is late if its time is behind the watermark in force when its batch begins:
    ``delay`` behind the newest time of the batches before. A row without a time is not.
    The split is narrow: one write per batch, with the newest time observed on the way.
    A batch that is repeated replaces what it wrote.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest, seen = _before(spark, path, batch_id), Observation()
        late = F.lit(False) if newest is None else F.coalesce(F.col(ts) < F.lit(newest - delay), F.lit(False))
        flagged = batch.withColumn("late", late).observe(seen, F.max(F.col(ts).cast("timestamp")).alias("newest"))
        flagged.write.mode("overwrite").partitionBy("late").parquet(f"{path}/rows/batch_id={batch_id}")
        times = [t for t in (newest, seen.get["newest"]) if t is not None]
        line = spark.createDataFrame([(max(times, default=None),)], _NEWEST)
        line.coalesce(1).write.mode("overwrite").parquet(f"{path}/bounds/batch_id={batch_id}")

    return start(rows.writeStream.foreachBatch(write), checkpoint, available_now=available_now)


def part(path: str, *, late: bool) -> str:
    """Where ``split_late`` puts the rows that are late, or those that are not: a pattern for readers and streams."""
    return f"{path}/rows/batch_id=*/late={str(late).lower()}"
