"""From class probabilities to alert records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fence import fence
from ..functions.labels import decode_label, severity
from ..functions.schema import ALERT_THRESHOLD, CLASSES, NORMAL
from ..functions.vectors import argmax


def predict(
    df: DataFrame, classes: Sequence[str] = CLASSES, *, probabilities: str = "probabilities"
) -> DataFrame:
    """Add ``class_index``, ``label`` and ``confidence`` of the most probable class."""
    p = F.col(probabilities)
    return (
        fence(df, class_index=argmax(probabilities))
        .withColumn("label", decode_label(F.col("class_index"), classes))
        .withColumn("confidence", F.get(p, F.col("class_index")))
    )


def is_alert(
    label: Column, confidence: Column, threshold: float = ALERT_THRESHOLD
) -> Column:
    """Not normal traffic and strictly above the threshold; a NaN confidence is no alert.

    Spark orders NaN above every number, so it is ruled out by name.
    """
    sure = (confidence > threshold) & ~F.isnan(confidence)
    return F.coalesce((label != NORMAL) & sure, F.lit(False))


def rounded_probabilities(probabilities: str, classes: Sequence[str] = CLASSES) -> Column:
    """Struct of the probabilities by class name, 4 decimals each."""
    fields = ", ".join(
        f"'{c}', round(CAST(get({probabilities}, {i}) AS double), 4)" for i, c in enumerate(classes)
    )
    return F.expr(f"named_struct({fields})")


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def to_alerts(
    df: DataFrame,
    *,
    threshold: float = ALERT_THRESHOLD,
    now: Column | None = None,
    keep: Sequence[str] = (),
    classes: Sequence[str] = CLASSES,
) -> DataFrame:
    """Predicted flows -> alert records, in the order of the wire format.

    ``now`` is the detection time in epoch milliseconds, the wall clock by default;
    ``keep`` names columns, such as a flow id, to carry in front.
    """
    rows = df.filter(is_alert(F.col("label"), F.col("confidence"), threshold))
    return rows.select(
        *keep,
        (now if now is not None else now_ms()).cast("bigint").alias("timestamp"),
        F.col("source_ip"),
        F.col("destination_ip"),
        F.col("destinationPort").alias("destination_port"),
        F.col("label").alias("attack_type"),
        F.round(F.col("confidence").cast("double"), 4).alias("confidence"),
        rounded_probabilities("probabilities", classes).alias("all_probabilities"),
        F.col("flowDuration").alias("flow_duration"),
        F.col("totalFwdPackets").alias("total_fwd_packets"),
        severity(F.col("label")).alias("severity"),
    )


WIRE_FIELDS = (
    "timestamp",
    "source_ip",
    "destination_ip",
    "destination_port",
    "attack_type",
    "confidence",
    "all_probabilities",
    "flow_duration",
    "total_fwd_packets",
    "severity",
)


def alert_json(alerts: DataFrame, out: str = "value") -> DataFrame:
    """One JSON text per alert; always valid JSON, whatever the address strings hold."""
    others = [c for c in alerts.columns if c not in WIRE_FIELDS]
    return alerts.select(*others, F.to_json(F.struct(*WIRE_FIELDS)).alias(out))


def event_latency_ms(event_ms: Column, now: Column | None = None) -> Column:
    """Milliseconds from the record's own time to the detection time."""
    return (now if now is not None else now_ms()) - event_ms
