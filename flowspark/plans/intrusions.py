"""Intrusion detection: raw flow text to alert records, one narrow stage."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.schema import ALERT_THRESHOLD, MEANS, SCALES
from ..operators.alerts import alert_json, is_alert, predict, to_alerts
from ..operators.features import assemble, identity_scaler, scale
from ..operators.parse import parse_flows, read_all
from ..operators.scoring import bad_probabilities
from ..sources.records import start

Scorer = Callable[[DataFrame], DataFrame]


class Detection(NamedTuple):
    alerts: DataFrame
    quarantine: DataFrame


def _constants(scaler: str | tuple[Sequence[float], Sequence[float]]) -> tuple:
    if scaler == "trained":
        return MEANS, SCALES
    if scaler == "identity":
        return identity_scaler()
    return scaler


def score_flows(
    flows: DataFrame,
    scorer: Scorer,
    *,
    scaler: str | tuple[Sequence[float], Sequence[float]] = "trained",
) -> DataFrame:
    """Parsed flows -> flows with probabilities, class, label and confidence."""
    mean, std = _constants(scaler)
    vectors = scale(assemble(flows), mean, std, guard_zero=True)
    return predict(scorer(vectors).drop("features"))


def detect_intrusions(
    raw: DataFrame,
    scorer: Scorer,
    *,
    scaler: str | tuple[Sequence[float], Sequence[float]] = "trained",
    threshold: float = ALERT_THRESHOLD,
    aliases: bool = True,
    impute: str | None = None,
    now: Column | None = None,
    keep: Sequence[str] = (),
    observe: tuple[Observation, Observation] | tuple[str, str] | None = None,
) -> Detection:
    """Raw JSON in column ``value`` -> alerts, and the records set aside with a reason.

    ``scorer`` adds ``probabilities`` to a frame with ``features``. Nothing is
    exchanged between the scan and the sink. ``observe`` collects the two job
    counters on the way, records read (malformed ones included) and alerts raised:
    a pair of ``Observation`` for batch, of names for streams. Records that the
    scorer gives no usable probabilities are set aside too, as ``bad_length``: every
    record is an alert, a scored flow below the threshold, or in the quarantine.
    """
    read = raw.observe(observe[0], F.count(F.lit(1)).alias("total_flows_processed")) if observe else raw
    flows, _ = parse_flows(read, aliases=aliases, impute=impute)
    scored = score_flows(flows, scorer, scaler=scaler)
    alerts = to_alerts(scored.filter(bad_probabilities().isNull()), threshold=threshold, now=now, keep=keep)
    bad = set_aside(score_records(read_all(raw, aliases=aliases, impute=impute), scorer, scaler=scaler), raw.columns)
    if observe:
        alerts = alerts.observe(observe[1], F.count(F.lit(1)).alias("intrusions_detected"))
    return Detection(alerts, bad)


def score_records(
    records: DataFrame, scorer: Scorer, *, scaler: str | tuple[Sequence[float], Sequence[float]] = "trained"
) -> DataFrame:
    """All read records, scored where they parsed; ``parse_error`` is also ``bad_length`` where the scorer failed.

    One pass: a record that did not parse goes along with a NULL vector and gets no prediction.
    """
    mean, std = _constants(scaler)
    vectors = scale(assemble(records), mean, std, guard_zero=True)
    parsed = F.col("parse_error").isNull()
    vectors = vectors.withColumn("features", F.when(parsed, F.col("features")))
    scored = predict(scorer(vectors).drop("features"))
    found = {c: F.when(parsed, F.col(c)) for c in ("probabilities", "class_index", "label", "confidence")}
    return scored.withColumns({**found, "parse_error": F.coalesce("parse_error", bad_probabilities())})


def set_aside(scored: DataFrame, kept: Sequence[str]) -> DataFrame:
    """The records of ``score_records`` that are no flows, with their reason."""
    bad = scored.filter("parse_error IS NOT NULL")
    return bad.select(*[c for c in kept if c != "value"], "value", "parse_error", "missing_features")


def run_detection(
    raw: DataFrame,
    scorer: Scorer,
    write_alerts: Callable[[DataFrame, int], None],
    write_quarantine: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    available_now: bool = False,
    **options,
) -> StreamingQuery:
    """Run detection as one stream with two outputs, parsing each record once.

    The writers get alerts and quarantined records of a batch with its number, under
    which they should replace what an earlier attempt wrote. The parsed batch is kept
    on memory and disk between the two; lost parts are computed again. ``observe``
    names the two counters, as in ``detect_intrusions``.
    """
    observe = options.pop("observe", None)
    parse = {k: options.pop(k) for k in ("aliases", "impute") if k in options}
    scaler = options.pop("scaler", "trained")

    def both(batch: DataFrame, batch_id: int) -> None:
        scored = score_records(read_all(batch, **parse), scorer, scaler=scaler).persist()
        try:
            write_alerts(to_alerts(scored.filter("parse_error IS NULL"), **options), batch_id)
            write_quarantine(set_aside(scored, ()), batch_id)
        finally:
            scored.unpersist()

    if observe:
        # both counters of what a batch read, on the stream itself: its progress reports carry them
        counted = score_records(read_all(raw, **parse), scorer, scaler=scaler)
        hit = is_alert(F.col("label"), F.col("confidence"), options.get("threshold", ALERT_THRESHOLD))
        counted = counted.observe(observe[0], F.count(F.lit(1)).alias("total_flows_processed"))
        counted = counted.observe(observe[1], F.count_if(hit & F.col("parse_error").isNull()).alias("intrusions_detected"))

        def both_counted(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist()
            try:
                write_alerts(to_alerts(batch.filter("parse_error IS NULL"), **options), batch_id)
                write_quarantine(set_aside(batch, ()), batch_id)
            finally:
                batch.unpersist()

        return start(counted.writeStream.foreachBatch(both_counted), checkpoint, available_now=available_now, name=observe[0])

    return start(raw.writeStream.foreachBatch(both), checkpoint, available_now=available_now)


def predict_stream(
    raw: DataFrame,
    scorer: Scorer,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    scaler: str | tuple[Sequence[float], Sequence[float]] = "trained",
    available_now: bool = False,
    **parse,
) -> StreamingQuery:
    """Score a stream and keep who is who: every record goes out with its own columns besides ``value``.

    ``write`` gets ``label`` (of a record set aside, the reason) and ``confidence`` of a batch, with its
    number, under which it should replace what an earlier attempt wrote. ``reconcile``
    holds the outcome against the same records scored at once.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        write(predictions(batch, scorer, scaler=scaler, **parse), batch_id)

    return start(raw.writeStream.foreachBatch(each), checkpoint, available_now=available_now)


def predictions(
    raw: DataFrame, scorer: Scorer, *, scaler: str | tuple[Sequence[float], Sequence[float]] = "trained", **parse
) -> DataFrame:
    """``label`` and ``confidence`` of each record, next to its columns besides ``value``."""
    scored = score_records(read_all(raw, **parse), scorer, scaler=scaler)
    kept = [c for c in raw.columns if c != "value"]
    return scored.select(*kept, F.coalesce("parse_error", "label").alias("label"), F.col("confidence").cast("double").alias("confidence"))


def counters(scored: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """The two job counters over a table of records with ``label`` and ``confidence``.

    Records without a prediction count in the total only.
    """
    hit = is_alert(F.col("label"), F.col("confidence"), threshold)
    return scored.agg(
        F.count(F.lit(1)).alias("total_flows_processed"),
        F.count_if(hit).alias("intrusions_detected"),
    )


def detect_to_json(raw: DataFrame, scorer: Scorer, **options) -> Detection:
    """As ``detect_intrusions``, with alerts as JSON text in ``value``."""
    found = detect_intrusions(raw, scorer, **options)
    return Detection(alert_json(found.alerts), found.quarantine)
