"""Job counters of running streams as rows of the metrics table."""

from __future__ import annotations

import datetime as dt
import json
import threading
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.prefix import prefix_sum
from ..operators.series import series_key

SCHEMA = "ts timestamp, name string, labels map<string,string>, value double"


def progress_rows(progress: Any) -> list[tuple]:
    """Samples from one progress report: observed counts, input rows, late rows, batch time.

    Observed counts are those of the batch; ``counter_totals`` adds them up.
    """
    ts = dt.datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00"))
    labels = {
        "job": progress.get("name") or str(progress["id"]),
        "run": str(progress.get("runId", "")),
        "batch": str(progress["batchId"]),
    }
    values: dict[str, float] = {"input_rows": progress.get("numInputRows", 0)}
    for metric in (progress.get("observedMetrics") or {}).values():
        values.update(metric if isinstance(metric, dict) else metric.asDict())
    late = [o.get("numRowsDroppedByWatermark", 0) for o in progress.get("stateOperators") or []]
    if late:
        values["rows_dropped_by_watermark"] = sum(late)
    values["batch_ms"] = progress.get("batchDuration", 0)
    return [(ts, name, labels, float(v)) for name, v in values.items()]


def metrics_from_progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Samples from the progress reports a query still holds: the last ones only.

    Totals of a job belong to the table that ``MetricsListener`` writes, which holds all.
    """
    rows = [r for p in query.recentProgress for r in progress_rows(json.loads(p.json))]
    return spark.createDataFrame(rows, SCHEMA)


def counter_totals(samples: DataFrame) -> DataFrame:
    """Per-batch counts -> counters that only rise, per name and labels; labels without the run and the batch.

    A sample is known by its name and all its labels, so a batch that is reported again
    counts once, and each bucket of a histogram is a counter of its own. A batch
    is known by its run and number: a restarted job counts on, from a new checkpoint
    too. Running totals are cut by day: no task holds all batches of a job.
    """
    labels = F.col("labels")
    rows = samples.select(
        "ts",
        "name",
        series_key(F.map_filter(labels, lambda k, _: ~k.isin("run", "batch"))).alias("series"),
        F.coalesce(labels["run"], F.lit("")).alias("run"),
        labels["batch"].cast("bigint").alias("batch"),
        "value",
    )
    once = rows.dropDuplicates(["name", "series", "run", "batch"])
    total = prefix_sum(once, ["name", "series"], ["ts", "run", "batch"], F.col("value"), F.to_date("ts"), "_total")
    return total.select("ts", "name", F.from_json("series", "map<string,string>").alias("labels"), F.col("_total").alias("value"))


class MetricsListener(StreamingQueryListener):
    """Appends the samples of every progress report to a metrics table."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._ended: dict[str, threading.Event] = {}

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until all reports of an ended query are in the table."""
        if not self._ended.setdefault(str(query.runId), threading.Event()).wait(seconds):
            raise TimeoutError(f"no end of {query.name or query.id} was reported")

    def onQueryStarted(self, event: Any) -> None: ...

    def onQueryProgress(self, event: Any) -> None:
        rows = progress_rows(json.loads(event.progress.json))
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event: Any) -> None: ...

    def onQueryTerminated(self, event: Any) -> None:
        self._ended.setdefault(str(event.runId), threading.Event()).set()
