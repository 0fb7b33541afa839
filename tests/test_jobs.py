"""Stores, joins, splits, streams and their restarts."""

import datetime as dt
import json
import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from flowspark.catalog.metrics import all_metrics
from flowspark.functions.schema import FEATURES, TRAINING_SCHEMA
from flowspark.operators.enrich import disjoint_ranges, enrich_geo, enrich_lookup, flag_sessions
from flowspark.operators.evaluate import class_metrics, compare_predictions, mismatches, reconcile, stratified_split
from flowspark.operators.histogram import merged_quantile, rank_error, sketch_windows
from flowspark.operators.prefix import prefix_sum
from flowspark.operators.windows import require_nonempty, windowed_counts
from flowspark.plans.alerting import (
    Evaluation,
    Expression,
    Reading,
    evaluate_alert_rules,
    expression_points,
    group_notifications,
    infrastructure_rules,
    intrusion_rules,
    session_rules,
)
from flowspark.plans.intrusions import detect_intrusions, run_detection
from flowspark.session import work_dir
from flowspark.sources.hash_store import read_hash, upsert_hash
from flowspark.sources.records import read_text_records, split_training_csv, to_json_records, write_text_records
from flowspark.streaming.metrics import SCHEMA, MetricsListener, counter_totals, progress_rows

SECOND = 1_000_000


def test_empty_store_is_an_error(spark):
    with pytest.raises(ValueError, match="no click_count hashes"):
        require_nonempty(spark.range(0), "click_count hashes")


def test_store_prefix_and_days(spark, tmp_path):
    rows = [("click_count:/a", "2025-06-10T05:04:00", 35), ("click_count:/a", "2025-06-11T00:00:00", 2), ("other", "2025-06-10T00:00:00", 1)]
    df = spark.createDataFrame(rows, "key string, field string, value bigint")
    upsert_hash(df, 0, str(tmp_path))
    upsert_hash(df.filter("key <> 'other'").withColumn("value", F.lit(99).cast("bigint")), 2, str(tmp_path))
    upsert_hash(df.limit(0), 3, str(tmp_path))
    got = read_hash(spark, str(tmp_path), "click_count:", last_day="2025-06-10").collect()
    assert [tuple(r) for r in got] == [("click_count:/a", "2025-06-10T05:04:00", 99)]


def test_salted_join_keeps_every_row(spark):
    hot = [(i, "hot" if i % 3 else f"k{i}") for i in range(300)]
    fact = spark.createDataFrame(hot, "id int, key string")
    dim = spark.createDataFrame([("hot", 1.0), ("k3", 2.0), ("unused", 3.0)], "key string, risk double")
    plain = enrich_lookup(fact, dim, "key", {"risk": 0.0}).orderBy("id").collect()
    salted = enrich_lookup(fact, dim, "key", {"risk": 0.0}, max_broadcast_rows=1, hot_rows=10)
    assert salted.orderBy("id").collect() == plain
    assert [r["risk"] for r in plain[:4]] == [0.0, 1.0, 1.0, 2.0]


def test_geo_edges(spark):
    ranges = spark.createDataFrame([(65536, 200000, "A"), (200001, 200001, "B")], "lo bigint, hi bigint, country string")
    ips = ["0.1.0.0", "0.3.13.64", "0.3.13.65", "0.3.13.66", "bad", None]
    df = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "i int, ip string")
    for rows in (10_000, 1):
        got = enrich_geo(df, ranges, max_broadcast_rows=rows, hot_rows=1).orderBy("i").collect()
        assert [r["country"] for r in got] == ["A", "A", "B", "unknown", "unknown", "unknown"]


def test_flags_are_strict(spark):
    df = spark.createDataFrame([(0.8,), (0.81,), (float("nan"),)], "score double")
    assert [r[0] for r in flag_sessions(df).collect()] == [0.81]


def test_split_is_exact_for_every_label(spark):
    df = spark.range(5000).withColumn("label", F.when(F.col("id") % 50 < 48, "big").otherwise("small"))
    s = stratified_split(df, "label", by="id", train=0.75)
    counts = {tuple(r[:2]): r[2] for r in s.groupBy("label", "split").count().collect()}
    assert counts == {("big", "train"): 3600, ("big", "test"): 1200, ("small", "train"): 150, ("small", "test"): 50}
    assert s.count() == s.select("id").distinct().count() == 5000


def test_class_without_predictions(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "a"), ("b", "a")], "actual string, predicted string")
    got = {r["label"]: r for r in class_metrics(df).collect()}
    assert got["b"]["f1"] == 0.0 and got["b"]["support"] == 1
    assert got["a"]["recall"] == 1.0 and got["a"]["accuracy"] == pytest.approx(2 / 3)


def test_mismatches(spark):
    a = spark.createDataFrame([(1, "x", 0.9), (2, "x", 0.9), (3, "x", 0.9)], "id int, label string, confidence double")
    b = spark.createDataFrame([(1, "x", 0.9), (2, "y", 0.9), (4, "x", 0.9)], "id int, label string, confidence double")
    assert sorted(r["id"] for r in mismatches(compare_predictions(a, b, "id")).collect()) == [2, 3, 4]


def test_stream_restart_reads_new_files_only(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def add(text):
        write_text_records(spark.createDataFrame([(text,)], "value string"), source, format="text")

    def run():
        stream = read_text_records(spark, source, format="text")
        write_text_records(stream, out, format="text", checkpoint=check, available_now=True).awaitTermination()

    add("first")
    run()
    add("second")
    run()
    run()
    assert sorted(r["value"] for r in spark.read.text(out).collect()) == ["first", "second"]


def test_stream_needs_a_checkpoint(spark, tmp_path):
    stream = read_text_records(spark, str(tmp_path), format="text")
    with pytest.raises(ValueError, match="checkpoint"):
        write_text_records(stream, str(tmp_path / "out"), format="text")


def test_late_rows_are_dropped(spark, tmp_path):
    source, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))

    def add(*times):
        df = spark.createDataFrame([("/a", t) for t in times], "page string, t string")
        df.select("page", F.col("t").cast("timestamp").alias("ts")).write.mode("append").parquet(source)

    def run():
        views = spark.readStream.schema("page string, ts timestamp").parquet(source)
        counts = windowed_counts(views, "page", watermark="10 minutes")
        q = (
            counts.writeStream.outputMode("update")
            .foreachBatch(lambda b, i: upsert_hash(b, i, table))
            .option("checkpointLocation", check)
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()

    add("2025-06-10 05:04:01", "2025-06-10 05:04:30")
    run()
    add("2025-06-10 06:00:00")
    run()
    add("2025-06-10 06:01:00")
    run()
    add("2025-06-10 05:04:59", "2025-06-10 06:00:30")
    run()
    got = {r["field"]: r["value"] for r in read_hash(spark, table).collect()}
    assert got == {"2025-06-10T05:04:00": 2, "2025-06-10T06:00:00": 2, "2025-06-10T06:01:00": 1}


def test_detection_stream_has_two_outputs(spark, tmp_path):
    good = json.dumps({f.key: 1 for f in FEATURES})
    source = str(tmp_path / "in")
    write_text_records(spark.createDataFrame([(good,), ("{",)], "value string"), source, format="text")

    def dos(df):
        return df.withColumn("probabilities", F.array(*[F.lit(float(i == 3)) for i in range(7)]))

    def writer(name):
        return lambda df, batch: df.write.mode("overwrite").json(str(tmp_path / name / f"batch={batch}"))

    raw = read_text_records(spark, source, format="text")
    run_detection(
        raw, dos, writer("alerts"), writer("bad"), str(tmp_path / "check"), available_now=True, now=F.lit(5)
    ).awaitTermination()
    alert = spark.read.json(str(tmp_path / "alerts")).first()
    assert (alert["attack_type"], alert["timestamp"], alert["destination_port"]) == ("DoS", 5, 1)
    assert [r["parse_error"] for r in spark.read.json(str(tmp_path / "bad")).collect()] == ["malformed_json"]


def test_no_record_is_lost(spark, tmp_path):
    good = json.dumps({f.key: 1 for f in FEATURES})
    rows = [(1, good), (2, None), (3, "{"), (4, ""), (5, json.dumps({f.key: 2 for f in FEATURES}))]
    df = spark.createDataFrame(rows, "id int, value string")

    def rejects_second(x):
        p = F.array(*[F.lit(float(i == 3)) for i in range(7)])
        return x.withColumn("probabilities", F.when(F.col("id") != 5, p))

    found = detect_intrusions(df, rejects_second, now=F.lit(5), keep=["id"])
    bad = {r["id"]: r["parse_error"] for r in found.quarantine.collect()}
    assert bad == {2: "null_record", 3: "malformed_json", 4: "malformed_json", 5: "bad_length"}
    assert [r["id"] for r in found.alerts.collect()] == [1]


def test_counted_stream_over_batches_and_a_restart(spark, tmp_path):
    good = json.dumps({f.key: 1 for f in FEATURES})
    source, metrics = str(tmp_path / "in"), str(tmp_path / "metrics")

    def dos(df):
        return df.withColumn("probabilities", F.array(*[F.lit(float(i == 3)) for i in range(7)]))

    def run():
        raw = read_text_records(spark, source, format="parquet", maxFilesPerTrigger="1")
        q = run_detection(
            raw, dos, lambda df, b: df.write.mode("append").json(str(tmp_path / "a")),
            lambda df, b: df.write.mode("append").json(str(tmp_path / "q")),
            str(tmp_path / "check"), available_now=True, now=F.lit(5), observe=("flows_in", "alerts_out"),
        )
        q.awaitTermination()
        listener.wait_for(q)

    listener = MetricsListener(spark, metrics)
    spark.streams.addListener(listener)
    try:
        for values in ([good], [good, None], ["{"]):
            spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").parquet(source)
        run()
        spark.createDataFrame([(good,)], "value string").coalesce(1).write.mode("append").parquet(source)
        run()
    finally:
        spark.streams.removeListener(listener)
    totals = counter_totals(spark.read.schema(SCHEMA).parquet(metrics).filter("labels['job'] = 'flows_in'"))
    last = {r["name"]: r["v"] for r in totals.groupBy("name").agg(F.max("value").alias("v")).collect()}
    assert (last["total_flows_processed"], last["intrusions_detected"]) == (5.0, 3.0)
    assert spark.read.json(str(tmp_path / "a")).count() == 3 and spark.read.json(str(tmp_path / "q")).count() == 2


def test_equal_facts_are_spread(spark):
    from flowspark.operators.joins import _salted, is_small

    fact = spark.createDataFrame([("hot",)] * 1000, "key string").repartition(4)
    assert _salted(fact, F.lit(16)).select("_salt").distinct().count() > 8
    wide = spark.range(100).select(F.lit("x" * 1000).alias("s"))
    assert is_small(wide) and not is_small(wide, max_bytes=50_000) and not is_small(wide, max_rows=99)


def test_rule_bounds_reach_the_scan(spark, tmp_path):
    rows = [("up", {"job": "j"}, i, 1.0) for i in range(0, 7200, 15)]
    df = spark.createDataFrame(rows, "name string, labels map<string,string>, s bigint, value double")
    df.select("name", "labels", F.timestamp_seconds("s").alias("ts"), "value").write.parquet(str(tmp_path / "m"))
    ev = Evaluation(start=3600 * SECOND, end=3660 * SECOND)
    points = expression_points(Expression(Reading("up")), spark.read.parquet(str(tmp_path / "m")), ev)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # the whole list of pushed filters
    plan = points._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan
    assert [r["us"] // SECOND for r in points.orderBy("us").collect()] == [3600, 3615, 3630, 3645, 3660]


def test_alerts_count_once_per_group(spark):
    points = [("g", "r", s, 15 * SECOND * i, "firing", "t", f"d{s}") for s in ("a", "b") for i in range(2)]
    df = spark.createDataFrame(points, "rule_group string, rule string, series string, us bigint, state string, summary string, description string")
    got = [tuple(r) for r in group_notifications(df).collect()]
    assert got == [(0, "slack-alerts", 2, "t", None)]


def test_null_keys_are_kept(spark):
    fact = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(40)], "id int, key string")
    dim = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "key string, risk double")
    got = enrich_lookup(fact, dim, "key", {"risk": 0.0}, max_broadcast_rows=1, hot_rows=5).collect()
    assert sorted((r["id"], r["risk"]) for r in got) == [(i, 0.0 if i % 2 else 1.0) for i in range(40)]
    total = prefix_sum(fact, ["key"], ["id"], F.lit(1), F.floor(F.col("id") / 7), "n")
    assert total.count() == 40 and total.agg(F.max("n")).first()[0] == 20


def test_work_folder_is_the_named_one(tmp_path):
    named = {"spark.checkpoint.dir": "hdfs://shared/"}
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=named, sparkContext=context)
    assert work_dir(session, "x").startswith("hdfs://shared/x-")
    named.clear()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(session, "x")


def test_progress_samples(spark, tmp_path):
    progress = {
        "id": "x", "name": "job", "timestamp": "2025-01-01T00:00:00.000Z", "batchId": 3, "numInputRows": 5,
        "observedMetrics": {"in": {"total_flows_processed": 5}}, "stateOperators": [{"numRowsDroppedByWatermark": 2}],
        "batchDuration": 9,
    }
    rows = progress_rows(progress)
    values = {r[1]: r[3] for r in rows}
    assert values == {"input_rows": 5.0, "total_flows_processed": 5.0, "rows_dropped_by_watermark": 2.0, "batch_ms": 9.0}
    runs = [("a", 0, 1.0), ("a", 1, 2.0), ("a", 1, 2.0), ("b", 0, 4.0)]  # one batch reported twice, one restart
    again = [(rows[0][0], "n", {"job": "j", "run": r, "batch": str(b)}, v) for r, b, v in runs]
    df = spark.createDataFrame(again, "ts timestamp, name string, labels map<string,string>, value double")
    assert sorted(r["value"] for r in counter_totals(df).collect()) == [1.0, 3.0, 7.0]

    class Event:
        class progress:
            json = json.dumps({**progress})

    MetricsListener(spark, str(tmp_path / "m")).onQueryProgress(Event)
    assert spark.read.parquet(str(tmp_path / "m")).count() == 4


def test_default_rules_run(spark, sf_dir):
    rules = intrusion_rules("svc0", "svc1") + infrastructure_rules() + session_rules()
    alerts = evaluate_alert_rules(rules, all_metrics(spark, sf_dir), Evaluation(step_s=60))
    notes = group_notifications(alerts)
    assert set(alerts.columns) >= {"rule", "severity", "state", "description"}
    assert notes.columns == ["group_us", "receiver", "n_alerts", "title", "text"]


def test_json_records_round_trip(spark):
    df = spark.createDataFrame([(1, "a\"b")], "x int, y string")
    assert json.loads(to_json_records(df).first()["value"]) == {"x": 1, "y": 'a"b'}


def test_binary_records_keep_their_bytes(spark, tmp_path):
    path = str(tmp_path / "avro")
    spark.createDataFrame([(bytearray(b"\x00\xff\x80"),)], "value binary").write.parquet(path)
    got = read_text_records(spark, path, format="parquet", stream=False, binary=True).first()
    assert bytes(got["value"]) == b"\x00\xff\x80"


def test_training_lines_are_rows_or_set_aside(spark, tmp_path):
    names = TRAINING_SCHEMA.names
    good = ["1"] * (len(names) - 1) + ["DoS"]
    lines = [",".join(names), ",".join(good), ",".join(["x"] + good[1:]), ",".join(good[:-1]), ",".join(good + ["y"]), ",".join(good[:-1] + [""]), ",".join(["1.5"] + good[1:])]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(str(tmp_path / "t"))
    rows, bad = split_training_csv(spark, str(tmp_path / "t"))
    assert [(r[0], r[-1]) for r in rows.collect()] == [(1, "DoS")]
    assert sorted((r["parse_error"], lines.index(r["value"])) for r in bad.collect()) == sorted(
        [(f"bad_cell:{names[0]}", 2), ("bad_columns", 3), ("bad_columns", 4), (f"empty:{names[-1]}", 5), (f"bad_cell:{names[0]}", 6)]
    )


def test_reconcile_names_every_case(spark):
    schema = "k string, label string, confidence double"
    online = [("a", "x", 0.5), ("b", "x", 0.5), ("b", "x", 0.5), ("c", "y", 0.5), ("d", "x", 0.6), ("e", "x", None), (None, "x", 0.1), ("g", None, None)]
    offline = [("a", "x", 0.5 + 1e-7), ("b", "x", 0.5), ("c", "x", 0.5), ("d", "x", 0.5), ("e", "x", 0.5), (None, "x", 0.1), ("f", "x", 0.5), ("g", None, None)]
    got = {r["k"]: r["outcome"] for r in reconcile(spark.createDataFrame(online, schema), spark.createDataFrame(offline, schema), "k").collect()}
    assert got == {"a": "same", "b": "doubled", "c": "differing", "d": "differing", "e": "differing", None: "same", "f": "lost", "g": "same"}
    back = {r["k"]: r["outcome"] for r in reconcile(spark.createDataFrame(offline, schema), spark.createDataFrame(online, schema), "k").collect()}
    assert back["f"] == "extra"


def test_narrowest_range_wins(spark):
    ranges = [(0, 400_000, "w"), (100, 200, "n"), (150, 300, "m"), (150, 300, "l"), (0, 400_000, "v"), (70_000, 60_000, "never"), (None, 5, "x"), (200_000, 200_000, "one")]
    df = spark.createDataFrame(ranges, "lo bigint, hi bigint, country string")
    pieces = [tuple(r)[1:] for r in disjoint_ranges(df).orderBy("lo").collect()]
    for (_, a, _), (b, _, _) in zip(pieces, pieces[1:]):
        assert a < b  # disjoint
    for n in (0, 99, 100, 150, 200, 201, 300, 301, 65_535, 65_536, 199_999, 200_000, 400_000, 400_001):
        around = [(hi - lo, lo, c) for lo, hi, c in ranges if lo is not None and lo <= n <= hi]
        assert [c for lo, hi, c in pieces if lo <= n <= hi] == ([min(around)[2]] if around else [])


def test_counters_by_all_labels(spark):
    ts = dt.datetime(2025, 6, 10)
    rows = [(ts, "b", {"job": "j", "le": le, "batch": str(n)}, v) for n in (0, 1) for le, v in (("1", 2.0), ("+Inf", 3.0))]
    df = spark.createDataFrame(rows + rows[:1], SCHEMA)
    got = {(r["labels"]["le"], r["value"]) for r in counter_totals(df).collect()}
    assert got == {("1", 2.0), ("1", 4.0), ("+Inf", 3.0), ("+Inf", 6.0)}
    assert "batch" not in counter_totals(df).first()["labels"]


def test_merged_sketches_are_near_the_rank(spark):
    df = spark.range(20_000).select(F.timestamp_seconds("id").alias("ts"), (F.col("id") * 7919 % 20_000).alias("v"), (F.col("id") % 2).alias("g"))
    s = sketch_windows(df, "v", "ts", "10 minutes", ["g"], k=200)
    assert s.count() == 2 * 34
    for r in merged_quantile(s, 0.9, ["g"], k=200).collect():
        assert r["n"] == 10_000 and abs(r["value"] / 20_000 - 0.9) < 3 * rank_error(200)


def test_lookups_that_follow_each_other_count_facts_once(spark):
    from flowspark.operators.joins import HotKeys

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def key(i):
        seen.add(1)
        return None if i % 5 == 0 else f"k{i % 5 % 3}"

    fact = spark.range(400).withColumn("key", key.asNondeterministic()("id")).repartition(4)
    dim = spark.createDataFrame([("k0", 1.0, "x"), ("k1", 2.0, "y")], "key string, risk double, status string")

    def looked_up(hot_rows):
        hot = HotKeys(fact, hot_rows)
        df = enrich_lookup(fact, dim, "key", {"risk": 0.0}, small=False, hot=hot)
        return enrich_lookup(df, dim, "key", {"status": "none"}, small=False, hot=hot)

    found = [sorted(tuple(r) for r in looked_up(n).collect()) for n in (1000, 100, 10)]
    assert found[0] == found[1] == found[2] and len(found[0]) == 400
    assert {r[1:] for r in found[0]} == {(None, 0.0, "none"), ("k0", 1.0, "x"), ("k1", 2.0, "y"), ("k2", 0.0, "none")}
    seen.value = 0
    looked_up(1000).collect()
    assert seen.value == 2 * 400  # one count, one join; each lookup counted before
    plan = looked_up(1000)._jdf.queryExecution().executedPlan().toString()
    assert "_salt" not in plan


def test_ui_events_are_read_once(spark):
    from flowspark.sources.records import bad_ui_events, parse_ui_events

    records = spark.createDataFrame([('{"event_id": "a", "user_id": "u"}',), ("{",), (None,), ('{"user_id": "u"}',)], "value string")
    events, bad = parse_ui_events(records), bad_ui_events(records)
    assert [(r.event_id, r.user_id) for r in events.collect()] == [("a", "u")]
    assert sorted(r.parse_error for r in bad.collect()) == ["malformed", "missing:event_id", "null_record"]
    assert events._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_cells_of_one_file_of_ranges_are_cut_by_many_tasks(spark, monkeypatch):
    from flowspark.operators import enrich

    def ranges():
        lo = F.col("id") * 40_000
        return spark.range(60).coalesce(1).select(lo.alias("lo"), (lo + 500_000 + F.col("id") % 7).alias("hi"), F.concat(F.lit("c"), "id").alias("country"))

    plain = sorted(tuple(r) for r in disjoint_ranges(ranges()).collect())
    monkeypatch.setattr(enrich, "_CELLS", 50)
    cut = disjoint_ranges(ranges())
    assert sorted(tuple(r) for r in cut.collect()) == plain
    # 60 ranges of 8 or 9 cells
    assert re.search(r"hashpartitioning\(lo#\d+L, hi#\d+L, country#\d+, (9|1[01])\)", cut._jdf.queryExecution().executedPlan().toString())
