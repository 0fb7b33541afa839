"""Session scoring: UI events, enriched by key and address, scored and flagged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation
from pyspark.sql.streaming import StreamingQuery

from ..functions.schema import SESSION_THRESHOLD
from ..operators.alerts import event_latency_ms
from ..operators.enrich import (
    enrich_lookup,
    enrich_pieces,
    flag_sessions,
    flag_text,
    score_binary,
    stored_pieces,
)
from ..operators.joins import HotKeys, are_small
from ..session import remove_folder
from ..sources.records import bad_events_of, start, ui_events_of, ui_records, write_text_records


class Dimensions(NamedTuple):
    """What sessions are looked up in, with address ranges cut to pieces, and which of them are small."""

    device_risk: DataFrame
    account_status: DataFrame
    login_failures: DataFrame
    pieces: DataFrame
    small: tuple[bool, bool, bool, bool]


def prepare_dimensions(
    device_risk: DataFrame, account_status: DataFrame, login_failures: DataFrame, geo_ranges: DataFrame
) -> Dimensions:
    """Cut the ranges, store the pieces and count all four in one job, for any number of batches."""
    tables = (device_risk, account_status, login_failures, stored_pieces(geo_ranges))
    return Dimensions(*tables, tuple(are_small(tables)))


def enrich_events(events: DataFrame, dimensions: Dimensions) -> DataFrame:
    """Add ``risk``, ``status``, ``failures`` and ``country``; unknown keys get defaults."""
    d, hot = dimensions, HotKeys(events)
    df = enrich_lookup(events, d.device_risk, "device_fingerprint", {"risk": 0.0}, small=d.small[0], hot=hot)
    df = enrich_lookup(df, d.account_status, "user_id", {"status": "unknown"}, small=d.small[1], hot=hot)
    df = enrich_lookup(df, d.login_failures, "user_id", {"failures": 0}, small=d.small[2], hot=hot)
    return enrich_pieces(df, d.pieces, small=d.small[3], hot=hot)


def score_sessions(
    enriched: DataFrame,
    weights: Mapping[str, float],
    bias: float,
    *,
    threshold: float = SESSION_THRESHOLD,
    now: Column | None = None,
) -> DataFrame:
    """Flagged events with ``score``, and ``latency_ms`` from their own time to now."""
    features = enriched.withColumn("is_locked", (F.col("status") == "locked").cast("int")).withColumn(
        "is_foreign", (F.col("country") == "unknown").cast("int")
    )
    flagged = flag_sessions(score_binary(features, weights, bias), threshold)
    return flagged.withColumn("pipeline_latency_ms", event_latency_ms(F.col("timestamp"), now))


LATENCY_BOUNDS = (100, 250, 500, 1000)


def _flag_counts(bounds: Sequence[float]) -> list[Column]:
    latency = F.col("pipeline_latency_ms")
    return [F.count(F.lit(1)).alias("all"), *[F.count_if(latency <= b).alias(f"b{i}") for i, b in enumerate(bounds)]]


def _flag_samples(bounds: Sequence[float]) -> list[tuple[str, str, str | None]]:
    """Name, count and bound ``le`` of each sample."""
    buckets = [("latency_ms_bucket", f"b{i}", str(b)) for i, b in enumerate(bounds)]
    return [("flagged_sessions_total", "all", None), *buckets, ("latency_ms_bucket", "all", "+Inf")]


def flag_metrics(flagged: DataFrame, ts: Column, *, job: str, bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    """Samples of a batch of flags for the metrics table: their number and the latency buckets.

    ``flagged_sessions_total`` counts flags; ``latency_ms_bucket`` those of at most the
    bound ``le``, as the latency rule reads them. One aggregate of one row.
    """

    def sample(name: str, value: str, le: str | None) -> Column:
        pairs = [F.lit(x) for k, v in (("job", job), ("le", le)) if v is not None for x in (k, v)]
        return F.struct(F.lit(name).alias("name"), F.create_map(*pairs).alias("labels"), F.col(value).cast("double").alias("value"))

    rows = F.array(*[sample(*s) for s in _flag_samples(bounds)])
    return flagged.agg(*_flag_counts(bounds)).select(ts.alias("ts"), F.inline(rows))


def score_stream(
    records: DataFrame,
    dimensions: Dimensions,
    weights: Mapping[str, float],
    bias: float,
    path: str,
    *,
    job: str = "sessions",
    threshold: float = SESSION_THRESHOLD,
    now: Column | None = None,
    bounds: Sequence[float] = LATENCY_BOUNDS,
    available_now: bool = False,
) -> StreamingQuery:
    """The session job: topic records in; flags, bad events and metric samples out.

    ``path/flags`` gets ``session,score`` texts, ``path/bad`` the records that are no event, with a
    reason, and ``path/samples`` the batch's counts as rows of the metrics table, at the
    newest event time of the batch; ``counter_totals`` makes counters of them, which the
    session rules read. Counts are observed while the flags are written. A folder per batch:
    a batch that is repeated replaces its three outputs. Its records are read once and kept
    in ``path/read`` while the batch lasts, as hot keys, flags and bad events all start from them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen, counted = Observation(), Observation()
        kept = f"{path}/read/batch_id={batch_id}"
        records = ui_records(batch).select("value", "_event")
        records.withColumn("value", F.when(F.col("_event.event_id").isNull(), F.col("value"))).write.mode("overwrite").parquet(kept)
        records = spark.read.schema(records.schema).parquet(kept)
        events = ui_events_of(records).observe(seen, F.max("timestamp").alias("newest"))
        flagged = score_sessions(enrich_events(events, dimensions), weights, bias, threshold=threshold, now=now)
        flag_text(flagged.observe(counted, *_flag_counts(bounds))).write.mode("overwrite").text(f"{path}/flags/batch_id={batch_id}")
        bad_events_of(records).write.mode("overwrite").parquet(f"{path}/bad/batch_id={batch_id}")
        newest, rows = seen.get["newest"], []
        if newest is not None:
            for name, value, le in _flag_samples(bounds):
                labels = {"job": job, "batch": str(batch_id), **({} if le is None else {"le": le})}
                rows.append((newest, name, labels, float(counted.get[value])))
        samples = spark.createDataFrame(rows, "ms bigint, name string, labels map<string,string>, value double")
        samples.select(F.timestamp_millis("ms").alias("ts"), "name", "labels", "value").coalesce(1).write.mode("overwrite").parquet(
            f"{path}/samples/batch_id={batch_id}"
        )
        remove_folder(spark, kept)

    return start(records.writeStream.foreachBatch(write), f"{path}/checkpoint", available_now=available_now)


def write_flags(flagged: DataFrame, target: str, **sink: object):
    """Flags as ``session,score`` text to a topic or path."""
    return write_text_records(flag_text(flagged), target, **sink)
