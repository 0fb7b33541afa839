"""Edge cases of parsing, vectors, scoring and alerts."""

import json
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from flowspark.functions.coercion import lenient_number
from flowspark.functions.labels import (
    classes,
    decode_label,
    encode_label,
    normalise_label,
    severity,
)
from flowspark.functions.network import ipv4_number, ipv4_text
from flowspark.functions.onnx_linear import linear_onnx
from flowspark.functions.schema import CLASSES, FEATURES, MEANS, SCALES, TRAFFIC_LABELS
from flowspark.functions.vectors import argmax
from flowspark.operators.alerts import alert_json, is_alert, predict, to_alerts
from flowspark.operators.features import assemble, fit_scaler, scale
from flowspark.operators.parse import bad_length, parse_flows, read_records
from flowspark.operators.scoring import score_linear, score_onnx
from flowspark.plans.intrusions import detect_intrusions

GOOD = {f.key: 1.5 if f.kind == "double" else 7 for f in FEATURES}


def record(**changes):
    r = {**GOOD, "source_ip": "10.0.0.5"}
    for k, v in changes.items():
        key = k.replace("_", " ")
        if v is ...:
            r.pop(key)
        else:
            r[key] = v
    return json.dumps(r)


def parsed(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, value string")
    return [r.asDict() for r in read_records(df, aliases=False).orderBy("id").collect()]


@pytest.mark.parametrize(
    ("text", "error"),
    [
        ("{", "malformed_json"),
        ("", "malformed_json"),
        ("null", "malformed_json"),
        ("[1]", "malformed_json"),
        ("[" + record() + "]", "malformed_json"),
        (record().replace("1.5", "NaN", 1), "malformed_json"),
        (record(Flow_Duration=...), "missing:Flow Duration"),
        (record(Flow_Duration=..., Idle_Min=...), "missing:Flow Duration"),
        ('{"probe": true, "timestamp": 1}', "probe"),
        ('{"attackType": "DoS"}', "missing:Destination Port"),
        (record(Destination_Port=3000000000), "overflow:Destination Port"),
        (record(Idle_Min=1e30), "overflow:Idle Min"),
        (record(), None),
        (record() + " trailing", None),
        (record().replace("{", '{"Idle Min": 3, ', 1), None),
    ],
)
def test_parse_error(spark, text, error):
    assert parsed(spark, text)[0]["parse_error"] == error


@pytest.mark.parametrize(
    ("value", "whole", "fraction"),
    [
        (None, 0, 0.0),
        ("12", 12, 12.0),
        ("abc", 0, 0.0),
        (True, 1, 1.0),
        (80.9, 80, 80.9),
        (-80.9, -80, -80.9),
        ("80.9", 80, 80.9),
        ({"a": 1}, 0, 0.0),
        ([1], 0, 0.0),
    ],
)
def test_lenient_numbers(spark, value, whole, fraction):
    text = record(Total_Fwd_Packets=value, Idle_Min=value, Idle_Mean=value)
    r = parsed(spark, text)[0]
    assert r["parse_error"] is None
    assert (r["totalFwdPackets"], r["idleMin"], r["idleMean"]) == (whole, whole, fraction)


def test_large_longs_stay_exact(spark):
    r = parsed(spark, record(Idle_Min=9007199254740993, Total_Fwd_Packets="3"))[0]
    assert r["idleMin"] == 9007199254740993


def test_infinite_text(spark):
    r = parsed(spark, record(Idle_Mean="Infinity"))[0]
    assert math.isinf(r["idleMean"]) and r["parse_error"] is None
    assert parsed(spark, record(Idle_Min="Infinity"))[0]["parse_error"] == "overflow:Idle Min"


def test_last_duplicate_wins(spark):
    text = record().replace("{", '{"Idle Min": 3, ', 1)
    assert parsed(spark, text)[0]["idleMin"] == 7


def test_addresses(spark):
    bare = {k: v for k, v in GOOD.items()}
    rows = parsed(spark, record(), json.dumps(bare), json.dumps({**bare, "source_ip": None}))
    assert [r["source_ip"] for r in rows] == ["10.0.0.5", "unknown", "unknown"]


def test_flows_and_quarantine_partition_the_input(spark):
    df = spark.createDataFrame([(1, record()), (2, "{"), (3, None)], "id int, value string")
    good, bad = parse_flows(df)
    assert [r["id"] for r in good.collect()] == [1]
    assert sorted((r["id"], r["parse_error"]) for r in bad.collect()) == [(2, "malformed_json"), (3, "null_record")]


def test_aliases_and_imputation(spark):
    generated = {f.alias: 3 for f in FEATURES if f.alias}
    df = spark.createDataFrame([(json.dumps({**generated, "attackType": "PortScan"}),)], "value string")
    _, bad = parse_flows(df)
    row = bad.first()
    assert len(row["missing_features"]) == sum(f.alias is None for f in FEATURES)
    good, bad = parse_flows(df, impute="mean")
    r = good.first()
    assert (r["idleMean"], r["flowDuration"], r["attack_label"]) == (FEATURES[49].mean, 3, "PortScan")
    assert bad.isEmpty()


def test_coercion_keeps_null_for_absent(spark):
    df = spark.sql("SELECT try_variant_get(parse_json('{}'), '$.a', 'variant') AS v")
    assert df.selectExpr(lenient_number("v", "int")).first()[0] is None


def test_float32(spark):
    df = spark.createDataFrame([(16777217, 0.1)], "a bigint, b double")
    v = assemble(df, ["a", "b"]).first()["features"]
    assert v == [16777216.0, float(np.float32(0.1))]


def test_trained_scaler_is_single_precision(spark):
    raw = [1000.25 * (i + 1) for i in range(52)]
    df = spark.createDataFrame([(raw,)], "features array<float>")
    got = np.array(scale(df).first()["features"], dtype=np.float32)
    x, m, s = (np.array(a, dtype=np.float32) for a in (raw, MEANS, SCALES))
    assert (got == (x - m) / s).all()


def test_zero_scale(spark):
    df = spark.createDataFrame([([3.0, 3.0],)], "features array<float>")
    assert scale(df, [1.0, 1.0], [0.0, 2.0], guard_zero=True).first()["features"] == [2.0, 1.0]


def test_wrong_length(spark):
    df = spark.createDataFrame([([1.0] * 51,)], "features array<float>")
    assert scale(df).first()["features"] is None
    assert df.select(bad_length(F.col("features"))).first()[0] == "bad_length"
    with pytest.raises(Exception, match="expected 52 features, got 51"):
        scale(df, strict=True).collect()


def test_fit_scaler(spark):
    df = spark.createDataFrame([([1.0, 5.0],), ([3.0, 5.0],)], "features array<float>")
    assert [tuple(r) for r in fit_scaler(df).orderBy("pos").collect()] == [(0, 2.0, 1.0), (1, 5.0, 1.0)]


NAN = float("nan")


@pytest.mark.parametrize(
    ("p", "best"),
    [
        ([0.2, 0.5, 0.3], 1),
        ([0.4, 0.4, 0.2], 0),
        ([NAN, 0.9, 0.1], 0),
        ([0.1, NAN, 0.3], 2),
        ([0.1, 0.3, NAN], 1),
    ],
)
def test_argmax(spark, p, best):
    df = spark.createDataFrame([(p,)], "p array<double>")
    assert df.selectExpr(argmax("p")).first()[0] == best


def test_alert_predicate(spark):
    rows = [("DoS", 0.5), ("DoS", 0.51), ("Normal Traffic", 0.9), ("Unknown", 0.9), ("DoS", NAN), ("DoS", None)]
    df = spark.createDataFrame(rows, "label string, confidence double")
    got = [r[0] for r in df.select(is_alert(F.col("label"), F.col("confidence"))).collect()]
    assert got == [False, True, False, True, False, False]


def test_labels(spark):
    df = spark.createDataFrame([(-1,), (0,), (6,), (7,), (None,)], "i int")
    assert [r[0] for r in df.select(decode_label(F.col("i"))).collect()] == [
        "Unknown", "Bots", "Web Attacks", "Unknown", "Unknown",
    ]
    names = spark.createDataFrame([("DoS",), ("dos",), ("Normal",), ("Normal Traffic",)], "x string")
    x = F.col("x")
    got = [tuple(r) for r in names.select(encode_label(x), normalise_label(x), severity(x)).collect()]
    assert got == [
        (3, "DoS", "HIGH"), (-1, "Unknown", "UNKNOWN"), (-1, "Normal Traffic", "UNKNOWN"),
        (4, "Normal Traffic", "UNKNOWN"),
    ]
    assert [tuple(r) for r in classes(spark).collect()] == list(enumerate(CLASSES))
    assert set(TRAFFIC_LABELS.values()) == set(CLASSES)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-3, 3, width=32), min_size=52, max_size=52), st.floats(-5, 5))
def test_scorers_agree(spark, x, shift):
    w = [[((i * 5 + j) % 7 - 3) / 10 for j in range(7)] for i in range(52)]
    b = [0.1 * j + shift for j in range(7)]
    df = spark.createDataFrame([(x,)], "features array<float>")
    columns = score_linear(df, w, b).first()["probabilities"]
    model = score_onnx(df, linear_onnx(w, b)).first()["probabilities"]
    z = np.array(x) @ np.array(w) + np.array(b)
    e = np.exp(z - z.max())
    assert np.allclose(columns, e / e.sum(), atol=1e-12)
    assert np.allclose(columns, model, atol=1e-5)


def test_onnx_sets_bad_rows_aside(spark, tmp_path):
    path = tmp_path / "model.onnx"
    path.write_bytes(linear_onnx([[0.1] * 7] * 52, [0.0] * 7))
    df = spark.createDataFrame(
        [(1, [1.0] * 52), (2, [1.0] * 51), (3, None), (4, [2.0] * 52)], "id int, features array<float>"
    )
    rows = {r["id"]: r["probabilities"] for r in score_onnx(df, str(path)).collect()}
    assert rows[2] is None and rows[3] is None
    assert len(rows[1]) == len(rows[4]) == 7


def test_alert_json_is_valid(spark):
    hostile = 'a"b\\c'
    df = spark.createDataFrame(
        [(hostile, "x", 80, 5, 6, [0.0, 0.0, 0.0, 0.87654, 0.1, 0.0, 0.02346])],
        "source_ip string, destination_ip string, destinationPort int, flowDuration bigint, "
        "totalFwdPackets int, probabilities array<double>",
    )
    alert = json.loads(alert_json(to_alerts(predict(df), now=F.lit(123))).first()["value"])
    assert list(alert) == [
        "timestamp", "source_ip", "destination_ip", "destination_port", "attack_type", "confidence",
        "all_probabilities", "flow_duration", "total_fwd_packets", "severity",
    ]
    assert alert["source_ip"] == hostile and alert["timestamp"] == 123
    assert (alert["attack_type"], alert["confidence"], alert["severity"]) == ("DoS", 0.8765, "HIGH")
    assert list(alert["all_probabilities"]) == list(CLASSES)


def test_detection_counts_malformed_records(spark):
    df = spark.createDataFrame([(record(),), ("{",)], "value string")
    seen, raised = Observation("seen"), Observation("raised")
    always_dos = lambda d: d.withColumn(
        "probabilities", F.array(*[F.lit(1.0 if i == 3 else 0.0) for i in range(7)])
    )
    found = detect_intrusions(df, always_dos, scaler="identity", observe=(seen, raised))
    assert len(found.alerts.collect()) == 1
    assert seen.get["total_flows_processed"] == 2
    assert raised.get["intrusions_detected"] == 1


def test_model_with_other_width_raises_no_alert(spark):
    df = spark.createDataFrame([(record(),)], "value string")
    short = lambda d: d.withColumn("probabilities", F.array(F.lit(1.0)))
    assert detect_intrusions(df, short).alerts.isEmpty()


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=5))
def test_addresses_round_trip(spark, numbers):
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    back = df.select("n", ipv4_number(ipv4_text(F.col("n"))).alias("m")).collect()
    assert all(r["n"] == r["m"] for r in back)


def test_bad_addresses(spark):
    df = spark.createDataFrame([("256.1.1.1",), ("1.2.3",), ("x",), ("",)], "ip string")
    assert [r[0] for r in df.select(ipv4_number(F.col("ip"))).collect()] == [None] * 4
