"""Queries on flow records: parsing, vectors, scoring, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import (
    classes,
    decode_label,
    encode_label,
    normalise_label,
    severity,
)
from ..functions.onnx_linear import linear_onnx
from ..functions.schema import (
    ALERT_SCHEMA,
    CLASSES,
    COLUMNS,
    FEATURES,
    MEANS,
    SCALES,
    TRAFFIC_LABELS,
)
from ..functions.vectors import argmax
from ..operators.alerts import alert_json, event_latency_ms, is_alert, predict, to_alerts
from ..operators.features import scale
from ..operators.parse import parse_flows, read_all, read_records
from ..operators.scoring import score_linear, score_onnx
from ..plans.intrusions import counters, detect_intrusions, score_flows, score_records
from .registry import query
from .views import (
    BIAS,
    FLOWS_SQL,
    NOW_MS,
    VECTORS_SQL,
    WEIGHTS,
    addresses,
    class_name_sql,
    flow_records,
    raw_values,
    scored_sql,
    severity_sql,
    table,
    vectors,
)


def scorer(df: DataFrame) -> DataFrame:
    return score_linear(df, WEIGHTS, BIAS)


def predicted_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(scorer(vectors(spark, sf_dir)))


_PREDICTED = f"WITH {VECTORS_SQL}, {scored_sql('vectors')}"
_NOT_NORMAL = "attack_type <> 'Normal Traffic' AND conf > 0.5"
_DETECTED = f"WITH {FLOWS_SQL}, {scored_sql('flows')}"


def _alert_columns(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "vec_id",
        "source_ip",
        "destination_ip",
        "destination_port",
        "attack_type",
        "confidence",
        "flow_duration",
        "total_fwd_packets",
        "severity",
    )


# raw[1], raw[2], raw[3]: destination port, flow duration, forward packets
_ALERTS_SQL = f"""{_DETECTED}
SELECT vec_id, source_ip, destination_ip, CAST(raw[1] AS INTEGER) AS destination_port,
       attack_type, round(conf, 4) AS confidence,
       CAST(raw[2] AS BIGINT) AS flow_duration, CAST(raw[3] AS INTEGER) AS total_fwd_packets,
       {severity_sql('attack_type')} AS severity
FROM predicted WHERE {_NOT_NORMAL}"""


@query("detect_intrusions", _ALERTS_SQL)
def detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: JSON flow records to alerts."""
    found = detect_intrusions(
        flow_records(spark, sf_dir), scorer, now=F.lit(NOW_MS), keep=["vec_id"]
    )
    return _alert_columns(found.alerts)


@query("alert_json", _ALERTS_SQL)
def alert_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts rendered as JSON and read back with the alert schema."""
    found = detect_intrusions(
        flow_records(spark, sf_dir), scorer, now=F.lit(NOW_MS), keep=["vec_id"]
    )
    text = alert_json(found.alerts)
    back = text.select("vec_id", F.from_json("value", ALERT_SCHEMA).alias("a"))
    return _alert_columns(back.select("vec_id", "a.*"))


@query(
    "alert_records",
    f"""{_DETECTED}
SELECT vec_id, {NOW_MS} AS timestamp, source_ip, destination_ip, CAST(raw[1] AS INTEGER) AS destination_port, attack_type,
       round(conf, 4) AS confidence, {", ".join(f"round(p[{i + 1}], 4) AS p{i}" for i in range(len(CLASSES)))},
       CAST(raw[2] AS BIGINT) AS flow_duration, CAST(raw[3] AS INTEGER) AS total_fwd_packets, {severity_sql('attack_type')} AS severity
FROM predicted WHERE {_NOT_NORMAL}""",
)
def alert_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of the alerts' JSON: detection time and all probabilities too."""
    found = detect_intrusions(flow_records(spark, sf_dir), scorer, now=F.lit(NOW_MS), keep=["vec_id"])
    a = alert_json(found.alerts).select("vec_id", F.from_json("value", ALERT_SCHEMA).alias("a")).select("vec_id", "a.*")
    each = [F.col(f"all_probabilities.`{c}`").alias(f"p{i}") for i, c in enumerate(CLASSES)]
    return a.select(*[c for c in a.columns if c != "all_probabilities"], *each)


@query(
    "score_linear",
    f"""{_PREDICTED}
SELECT vec_id, class_index, attack_type AS label, round(conf, 6) AS confidence FROM predicted""",
)
def score_linear_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = predicted_vectors(spark, sf_dir)
    return p.select("vec_id", "class_index", "label", F.round("confidence", 6).alias("confidence"))


@query(
    "score_onnx",
    f"""{_PREDICTED}
SELECT vec_id, class_index, attack_type AS label, {_NOT_NORMAL} AS is_alert FROM predicted""",
)
def score_onnx_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same classifier as a model file, run by Arrow batch in Python workers."""
    model = linear_onnx(WEIGHTS, BIAS)
    p = predict(score_onnx(vectors(spark, sf_dir), model))
    return p.select(
        "vec_id", "class_index", "label", is_alert(F.col("label"), F.col("confidence")).alias("is_alert")
    )


@query(
    "argmax",
    """SELECT vec_id,
  CAST(list_position(embedding[1:7], list_max(embedding[1:7])) - 1 AS INTEGER) AS best,
  CAST(list_position(list_transform(embedding[1:7], lambda x: round(x, 0)),
       list_max(list_transform(embedding[1:7], lambda x: round(x, 0)))) - 1 AS INTEGER) AS first_tie
FROM embeddings""",
)
def argmax_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest of the first seven elements; rounded to whole numbers nearly all tie."""
    seven = "slice(embedding, 1, 7)"
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id",
        f"{argmax(seven)} AS best",
        f"{argmax(f'transform({seven}, y -> round(y, 0) + 0.0F)')} AS first_tie",
    )


@query(
    "class_probabilities",
    f"""{_PREDICTED}
SELECT vec_id, {", ".join(f"round(p[{i + 1}], 6) AS p{i}" for i in range(len(CLASSES)))}
FROM predicted""",
)
def probabilities_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = predicted_vectors(spark, sf_dir)
    return p.select(
        "vec_id", *[F.round(F.get("probabilities", F.lit(i)), 6).alias(f"p{i}") for i in range(len(CLASSES))]
    )


@query(
    "alert_predicate",
    f"""{_PREDICTED}
SELECT vec_id, {_NOT_NORMAL} AS is_alert,
       attack_type <> 'Normal Traffic' AND conf > 0.9 AS is_sure FROM predicted""",
)
def alert_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    label, confidence = F.col("label"), F.col("confidence")
    return predicted_vectors(spark, sf_dir).select(
        "vec_id",
        is_alert(label, confidence).alias("is_alert"),
        is_alert(label, confidence, 0.9).alias("is_sure"),
    )


@query(
    "flow_counters",
    f"""{_PREDICTED}
SELECT count(*) AS total_flows_processed,
       count(*) FILTER (WHERE {_NOT_NORMAL}) AS intrusions_detected FROM predicted""",
)
def flow_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters(predicted_vectors(spark, sf_dir))


_SUMS_SQL = """SELECT {keys}, round(list_sum(list_transform(features, lambda x: x::DOUBLE)), 3) AS total,
  round(features[1]::DOUBLE, 5) AS head, round(features[52]::DOUBLE, 5) AS tail,
  CAST(len(features) AS INTEGER) AS n FROM {source}"""


def _vector_summary(df: DataFrame, *keys: str) -> DataFrame:
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x)
    return df.select(
        *keys,
        F.round(total, 3).alias("total"),
        F.round(F.get("features", F.lit(0)).cast("double"), 5).alias("head"),
        F.round(F.get("features", F.lit(51)).cast("double"), 5).alias("tail"),
        F.size("features").alias("n"),
    )


@query("scale_trained", f"WITH {FLOWS_SQL} " + _SUMS_SQL.format(keys="vec_id", source="flows"))
def scale_trained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON record -> 52 typed columns -> float32 vector -> trained scaler."""
    from ..operators.features import assemble

    flows, _ = parse_flows(flow_records(spark, sf_dir))
    return _vector_summary(scale(assemble(flows), MEANS, SCALES), "vec_id")


@query(
    "scale_guarded",
    f"""WITH {VECTORS_SQL}, scaled AS (
  SELECT vec_id, list_transform(range(1, 53), lambda i:
    CASE WHEN i % 4 = 1 THEN features[i] - (i - 1)::FLOAT
         ELSE (features[i] - (i - 1)::FLOAT) / ((i - 1) % 4)::FLOAT END) AS features
  FROM vectors) """
    + _SUMS_SQL.format(keys="vec_id", source="scaled"),
)
def scale_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth deviation is zero: those positions are centred only."""
    mean = [float(i) for i in range(52)]
    std = [float(i % 4) for i in range(52)]
    return _vector_summary(scale(vectors(spark, sf_dir), mean, std, guard_zero=True), "vec_id")


@query(
    "assemble_float32",
    """SELECT event_id, CAST(CAST(CAST(value * 1000003 AS DOUBLE) AS FLOAT) AS DOUBLE) AS narrowed,
  CAST(CAST(user_id * 16777217 AS FLOAT) AS DOUBLE) AS narrowed_long FROM events""",
)
def assemble_float32(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles and longs narrowed to single precision on the way into a vector."""
    from ..operators.features import assemble

    e = table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("value") * F.lit(1000003)).alias("a"),
        (F.col("user_id") * F.lit(16777217)).alias("b"),
    )
    v = assemble(e, ["a", "b"])
    return v.select(
        "event_id",
        F.get("features", F.lit(0)).cast("double").alias("narrowed"),
        F.get("features", F.lit(1)).cast("double").alias("narrowed_long"),
    )


# Damage done to a flow record by id, and the reason it is then set aside with.
def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = flow_records(spark, sf_dir)
    v = F.col("value")
    kind = F.col("vec_id") % 11
    broken = (
        F.when(kind == 0, F.substring(v, 1, 40))
        .when(kind == 1, F.lit('{"probe":true,"timestamp":1735689600000}'))
        .when(kind == 2, F.replace(v, F.lit('"Flow Duration"'), F.lit('"Flow Time"')))
        .when(kind == 3, F.regexp_replace(v, '"Destination Port":-?\\d+', '"Destination Port":3000000000'))
        .when(kind == 4, F.concat(F.lit("["), v, F.lit("]")))
        .when(kind == 5, F.regexp_replace(v, '"Total Fwd Packets":-?\\d+', '"Total Fwd Packets":null'))
        .when(kind == 6, F.regexp_replace(v, '"Total Fwd Packets":-?\\d+', '"Total Fwd Packets":"80.9"'))
        .when(kind == 7, F.regexp_replace(v, '"Total Fwd Packets":-?\\d+', '"Total Fwd Packets":true'))
        .otherwise(v)
    )
    return r.select("vec_id", broken.alias("value"))


@query(
    "flow_partition",
    f"""{_DETECTED} SELECT CASE vec_id % 11 WHEN 0 THEN 'null_record' WHEN 1 THEN 'malformed_json' WHEN 2 THEN 'bad_length'
  ELSE CASE WHEN {_NOT_NORMAL} THEN 'alert' ELSE 'no alert' END END AS outcome, count(*) AS n
FROM predicted GROUP BY 1""",
)
def flow_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record is an alert, no alert, or in the quarantine with a reason; some are null, broken or rejected by the model."""
    broken = F.when(F.col("vec_id") % 11 == 1, F.lit("{")).when(F.col("vec_id") % 11 != 0, F.col("value"))
    raw = flow_records(spark, sf_dir).withColumn("value", broken)

    def rejecting(df: DataFrame) -> DataFrame:
        return scorer(df).withColumn("probabilities", F.when(F.col("vec_id") % 11 != 2, F.col("probabilities")))

    scored = score_records(read_all(raw), rejecting)
    hit = is_alert(F.col("label"), F.col("confidence"))
    outcome = F.coalesce(F.col("parse_error"), F.when(hit, F.lit("alert")).otherwise("no alert"))
    return scored.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "quarantine_reasons",
    """SELECT CASE vec_id % 11 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'probe'
    WHEN 2 THEN 'missing:Flow Duration' WHEN 3 THEN 'overflow:Destination Port'
    ELSE 'malformed_json' END AS parse_error, count(*) AS n
FROM embeddings WHERE vec_id % 11 < 5 GROUP BY 1""",
)
def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = parse_flows(_damaged(spark, sf_dir), aliases=False)
    return bad.groupBy("parse_error").agg(F.count(F.lit(1)).alias("n"))


@query(
    "parse_flows",
    f"""WITH {FLOWS_SQL} SELECT vec_id, source_ip, destination_ip,
  CAST(raw[1] AS INTEGER) AS "destinationPort", CAST(raw[2] AS BIGINT) AS "flowDuration",
  CASE vec_id % 11 WHEN 5 THEN 0 WHEN 6 THEN 80 WHEN 7 THEN 1 ELSE CAST(raw[3] AS INTEGER) END
    AS "totalFwdPackets",
  round(raw[13], 3) AS "flowBytesPerS", CAST(raw[52] AS BIGINT) AS "idleMin"
FROM flows WHERE vec_id % 11 >= 5""",
)
def parse_flows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good records of the damaged table, lenient number reading included."""
    flows, _ = parse_flows(_damaged(spark, sf_dir), aliases=False)
    return flows.select(
        "vec_id",
        "source_ip",
        "destination_ip",
        "destinationPort",
        "flowDuration",
        "totalFwdPackets",
        F.round("flowBytesPerS", 3).alias("flowBytesPerS"),
        "idleMin",
    )


_TYPES_SQL = "[" + ", ".join(f"'{f.kind}'" for f in FEATURES) + "]"


@query(
    "lenient_numbers",
    """SELECT event_id,
  CASE event_type WHEN 'click' THEN CAST(trunc(value) AS BIGINT) WHEN 'view' THEN CAST(trunc(value) AS BIGINT)
    WHEN 'signup' THEN 1 WHEN 'purchase' THEN 0 ELSE 0 END AS whole,
  CASE event_type WHEN 'click' THEN value WHEN 'view' THEN value WHEN 'signup' THEN 1.0
    ELSE 0.0 END AS fraction
FROM events""",
)
def lenient_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, numeric text, booleans, nulls and other text read as numbers."""
    from ..functions.coercion import lenient_number

    kind, number = F.col("event_type"), F.col("value").cast("string")
    text = (
        F.when(kind == "click", number)
        .when(kind == "view", F.concat(F.lit('"'), number, F.lit('"')))
        .when(kind == "signup", "true")
        .when(kind == "purchase", "null")
        .otherwise('"abc"')
    )
    e = table(spark, sf_dir, "events").select("event_id", F.parse_json(text).alias("v"))
    return e.select(
        "event_id",
        F.expr(lenient_number("v", "bigint")).alias("whole"),
        F.expr(lenient_number("v", "double")).alias("fraction"),
    )


@query(
    "json_fields",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  coalesce(json_extract_string(props, '$.source_ip'), 'unknown') AS source_ip FROM events""",
)
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text as a tree; an optional string with its default."""
    e = table(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").alias("v"))
    return e.select(
        "event_id",
        F.try_variant_get("v", "$.k", "bigint").alias("k"),
        F.coalesce(F.try_variant_get("v", "$.source_ip", "string"), F.lit("unknown")).alias("source_ip"),
    )


# Records in the spelling of the traffic generator, labels included.
def _generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    values = raw_values("embedding")
    named = [values[f.key].alias(f.alias) for f in FEATURES if f.alias]
    spellings = F.array(*[F.lit(x) for x in TRAFFIC_LABELS])
    label = F.get(spellings, (F.col("label") % 7).cast("int"))
    record = F.struct(
        *named,
        *addresses(F.col("vec_id")),
        label.alias("attackType"),
        (F.lit(NOW_MS) - F.col("vec_id") * 1000).alias("timestamp"),
    )
    return e.select("vec_id", F.to_json(record).alias("value"))


_SPELLED = (
    "CASE label % 7 "
    + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(TRAFFIC_LABELS))
    + " END"
)
_MODEL_LABEL = (
    "CASE label % 7 "
    + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(TRAFFIC_LABELS.values()))
    + " END"
)
_ABSENT = sum(f.alias is None for f in FEATURES)


@query(
    "generated_flows",
    f"""SELECT vec_id, {_SPELLED} AS attack_label, {_MODEL_LABEL} AS label,
  {NOW_MS} - vec_id * 1000 AS event_ms, vec_id * 1000 AS latency_ms,
  CAST({_ABSENT} AS INTEGER) AS n_missing, 'missing:Destination Port' AS parse_error FROM embeddings""",
)
def generated_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generator-spelled records: ground truth, event time, and why they are set aside."""
    r = read_records(_generated(spark, sf_dir))
    return r.select(
        "vec_id",
        "attack_label",
        normalise_label(F.col("attack_label")).alias("label"),
        "event_ms",
        event_latency_ms(F.col("event_ms"), F.lit(NOW_MS)).alias("latency_ms"),
        F.size("missing_features").alias("n_missing"),
        "parse_error",
    )


_ALIASED = [i for i, f in enumerate(FEATURES) if f.alias]


@query(
    "generated_flows_imputed",
    f"""WITH {FLOWS_SQL} SELECT vec_id,
  round(list_sum(list_transform({[i + 1 for i in _ALIASED]}, lambda i: features[i]::DOUBLE)), 2) AS total
FROM flows""",
)
def generated_flows_imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absent features filled with the trained mean: only the present ones move the sum."""
    from ..operators.features import assemble

    flows, _ = parse_flows(_generated(spark, sf_dir), impute="mean")
    scaled = scale(assemble(flows, COLUMNS), MEANS, SCALES)
    present = [F.get("features", F.lit(i)).cast("double") for i in _ALIASED]
    return scaled.select("vec_id", F.round(sum(present[1:], present[0]), 2).alias("total"))


@query(
    "decode_labels",
    f"""SELECT vec_id, CAST(label - 1 AS INTEGER) AS class_index,
  {class_name_sql('label - 1')} AS label FROM embeddings""",
)
def decode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexes from -1 to 8: out of range on both sides."""
    e = table(spark, sf_dir, "embeddings").select(
        "vec_id", (F.col("label") - 1).cast("int").alias("class_index")
    )
    return e.withColumn("label", decode_label(F.col("class_index")))


@query(
    "encode_labels",
    """SELECT vec_id, CAST(CASE WHEN label - 1 BETWEEN 0 AND 6 THEN label - 1 ELSE -1 END AS INTEGER)
  AS class_index, -1 AS lower_case FROM embeddings""",
)
def encode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decode_labels(spark, sf_dir)
    return d.select(
        "vec_id",
        encode_label(F.col("label")).alias("class_index"),
        encode_label(F.lower("label")).alias("lower_case"),
    )


@query(
    "severity",
    f"""WITH d AS (SELECT vec_id, {class_name_sql('label - 1')} AS label FROM embeddings)
SELECT vec_id, label, {severity_sql('label')} AS severity FROM d""",
)
def severity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decode_labels(spark, sf_dir)
    return d.select("vec_id", "label", severity(F.col("label")).alias("severity"))


@query(
    "class_vocabulary",
    f"""{_PREDICTED}, names AS (SELECT CAST(i AS INTEGER) AS class_index FROM range(7) r(i))
SELECT n.class_index, {class_name_sql('n.class_index')} AS label, count(p.vec_id) AS n
FROM names n LEFT JOIN predicted p USING (class_index) GROUP BY n.class_index""",
)
def class_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every class of the model with its number of predictions."""
    counts = predicted_vectors(spark, sf_dir).groupBy("class_index").agg(F.count(F.lit(1)).alias("n"))
    return (
        classes(spark)
        .join(counts, "class_index", "left")
        .select("class_index", "label", F.coalesce("n", F.lit(0)).alias("n"))
    )


@query(
    "scored_flows",
    f"""{_DETECTED}
SELECT attack_type AS label, count(*) AS n, round(avg(conf), 6) AS mean_confidence
FROM predicted GROUP BY 1""",
)
def scored_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flows, alerting or not, by predicted class."""
    flows, _ = parse_flows(flow_records(spark, sf_dir))
    scored = score_flows(flows, scorer)
    return scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 6).alias("mean_confidence")
    )


@query(
    "alert_latency",
    f"""{_PREDICTED}
SELECT vec_id, CAST({NOW_MS} AS BIGINT) AS detected_at, attack_type FROM predicted WHERE {_NOT_NORMAL}""",
)
def alert_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts straight from vectors, stamped with the given detection time."""
    p = predicted_vectors(spark, sf_dir).select(
        "*",
        F.lit("unknown").alias("source_ip"),
        F.lit("unknown").alias("destination_ip"),
        F.lit(None).cast("int").alias("destinationPort"),
        F.lit(None).cast("bigint").alias("flowDuration"),
        F.lit(None).cast("int").alias("totalFwdPackets"),
    )
    alerts = to_alerts(p, now=F.lit(NOW_MS), keep=["vec_id"])
    return alerts.select("vec_id", F.col("timestamp").alias("detected_at"), "attack_type")
