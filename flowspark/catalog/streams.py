"""Queries that run the jobs as streams over the given tables and read what they wrote."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schema import ALERT_SCHEMA
from ..operators.alerts import alert_json
from ..operators.evaluate import reconcile
from ..operators.series import SECOND, micros
from ..operators.windows import field_text
from ..plans.alerting import Evaluation, evaluate_alert_rules, session_rules
from ..plans.intrusions import detect_intrusions, predict_stream, predictions
from ..plans.page_views import count_records, stream_page_view_counts
from ..plans.sessions import LATENCY_BOUNDS, prepare_dimensions, score_stream
from ..session import work_dir
from ..sources.hash_store import read_hash
from ..sources.records import start, write_text_records
from ..streaming.hold import hold_stream
from ..streaming.late import part
from ..streaming.metrics import SCHEMA, MetricsListener, counter_totals
from .flows import _DETECTED, _NOT_NORMAL, scorer
from .metrics import quantile_sql, rate_sql
from .pages import COUNTS_SQL, page_records, page_views
from .registry import query
from .sessions import _UI, BIAS, WEIGHTS, damaged_ui_records, session_dimensions
from .views import NOW_MS, flow_records, severity_sql, stream_table, table


@query("stream_page_views", COUNTS_SQL)
def stream_page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "stream-pages")
    views = page_views(stream_table(spark, sf_dir, "events"))
    stream_page_view_counts(views, f"{path}/table", f"{path}/checkpoint", available_now=True).awaitTermination()
    return read_hash(spark, f"{path}/table", "click_count:")


@query(
    "stream_intrusions",
    f"""{_DETECTED} SELECT source_ip, destination_ip, CAST(raw[1] AS INTEGER) AS destination_port, attack_type,
  round(conf, 4) AS confidence, {severity_sql('attack_type')} AS severity FROM predicted WHERE {_NOT_NORMAL}""",
)
def stream_intrusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow records in, alert texts out through a text sink, read back with the alert schema."""
    path = work_dir(spark, "stream-alerts")
    raw = flow_records(spark, sf_dir, stream=True)
    alerts = alert_json(detect_intrusions(raw, scorer, now=F.lit(NOW_MS)).alerts)
    write_text_records(
        alerts, f"{path}/alerts", format="text", checkpoint=f"{path}/checkpoint", available_now=True
    ).awaitTermination()
    back = spark.read.text(f"{path}/alerts").select(F.from_json("value", ALERT_SCHEMA).alias("a"))
    return back.select(
        "a.source_ip", "a.destination_ip", "a.destination_port", "a.attack_type", "a.confidence", "a.severity"
    )


_HOLD, _SILENT = 600, 6 * 3600
_DELAY_DAYS, _ARRIVALS = 4, 4

#: Events come in four arrivals of eight days each, one in ten an arrival too late: some of these behind the watermark.
_ARRIVAL_SQL = f"least(day(ts) // 8 + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END, {_ARRIVALS - 1})"


def arrivals(events: DataFrame) -> DataFrame:
    late = F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    block = F.floor(F.dayofmonth("ts") / 8) + late
    return events.withColumn("arrival", F.least(block, F.lit(_ARRIVALS - 1)).cast("int"))


def watermarks_sql(delay_days: int = _DELAY_DAYS) -> str:
    """``w(arrival, wm)``: the watermark in force at each arrival, and after the last one; events in ``e(us, arrival)``."""
    return f"""w AS (SELECT a AS arrival, (max(us) // 1000 - {delay_days * 86_400_000}) * 1000 AS wm
  FROM range(1, {_ARRIVALS + 1}) r(a) JOIN e ON e.arrival < a GROUP BY a)"""


@query(
    "stream_hold",
    f"""WITH e AS (SELECT 'svc' || (user_id % 5) AS series, epoch_us(ts) AS us, event_type IN ('error', 'click') AS c,
  {_ARRIVAL_SQL} AS arrival FROM events),
{watermarks_sql()},
p AS (SELECT e.*, coalesce(us <= wm, false) AS late FROM e LEFT JOIN w USING (arrival)),
s AS (SELECT series, us, bool_or(c) AS c FROM p WHERE NOT late AND us <= (SELECT wm FROM w WHERE arrival = {_ARRIVALS}) GROUP BY ALL),
g AS (SELECT *, c AND (lag(us) OVER o IS NULL OR NOT lag(c) OVER o OR us - lag(us) OVER o > {_SILENT * SECOND}) AS begins,
  lead(us) OVER o AS next FROM s WINDOW o AS (PARTITION BY series ORDER BY us)),
k AS (SELECT *, sum(begins::INTEGER) OVER (PARTITION BY series ORDER BY us) AS k FROM g),
r AS (SELECT series, k, min(us) AS since, max(us) AS last, max_by(next, us) AS next FROM k WHERE c GROUP BY ALL),
f AS (SELECT r.series, r.k, since, min(us) AS us, any_value(last) AS last, any_value(r.next) AS next
  FROM r JOIN k ON k.series = r.series AND k.k = r.k AND k.c AND k.us - since >= {_HOLD * SECOND} GROUP BY ALL),
x AS (SELECT series, since, CASE WHEN next - last <= {_SILENT * SECOND} THEN next
  WHEN next IS NOT NULL OR last + {_SILENT * SECOND} <= (SELECT wm FROM w WHERE arrival = {_ARRIVALS}) THEN last + {_SILENT * SECOND} END AS us FROM f)
SELECT series, since AS since_us, us, 'firing' AS state, true AS condition FROM f
UNION ALL SELECT series, since, us, 'resolved', false FROM x WHERE us IS NOT NULL
UNION ALL SELECT series, NULL, us, 'late', c FROM p WHERE late""",
)
def stream_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Firing and resolved transitions from keyed state, with late points, over out-of-order arrivals and restarts."""
    path = work_dir(spark, "stream-hold")
    e = arrivals(table(spark, sf_dir, "events"))
    points = e.select(
        "arrival",
        F.lit("Errors").alias("rule"),
        F.concat(F.lit("svc"), (F.col("user_id") % 5).cast("string")).alias("series"),
        micros(F.col("ts")).alias("us"),
        F.col("event_type").isin("error", "click").alias("condition"),
    )
    for arrival in range(_ARRIVALS):  # each run of the job goes on from the checkpoint of the one before
        points.filter(F.col("arrival") == arrival).drop("arrival").write.mode("append").parquet(f"{path}/in")
        source = spark.readStream.schema(points.drop("arrival").schema).parquet(f"{path}/in")
        held = hold_stream(source, for_s=_HOLD, silent_s=_SILENT, delay=f"{_DELAY_DAYS} days")
        writer = held.writeStream.format("parquet").outputMode("append").option("path", f"{path}/out")
        start(writer, f"{path}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{path}/out").drop("rule")


_BAD_SQL = "CASE event_id % 9 WHEN 0 THEN 'null_record' WHEN 1 THEN 'malformed' WHEN 2 THEN 'missing:page' WHEN 3 THEN 'bad_time' END"


@query(
    "stream_late_views",
    f"""WITH e AS (SELECT event_id, event_type, {_BAD_SQL} AS bad, CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) // 1000 * 1000 ELSE epoch_us(ts) END AS us,
  {_ARRIVAL_SQL} AS arrival FROM events),
w AS (SELECT a AS arrival, max(us) - {_DELAY_DAYS * 86_400 * SECOND} AS wm FROM range(1, {_ARRIVALS}) r(a) JOIN e ON e.bad IS NULL AND e.arrival < a GROUP BY a),
p AS (SELECT e.*, '/' || event_type AS page, coalesce(us < wm, false) AS late FROM e LEFT JOIN w USING (arrival) WHERE bad IS NULL)
SELECT 'counted' AS part, 'click_count:' || page AS key, strftime(date_trunc('minute', make_timestamp(us)), '%Y-%m-%dT%H:%M:%S') AS field,
  count(*) AS value FROM p WHERE NOT late GROUP BY ALL
UNION ALL SELECT 'late', page, strftime(date_trunc('minute', make_timestamp(us)), '%Y-%m-%dT%H:%M:%S'), count(*) FROM p WHERE late GROUP BY ALL
UNION ALL SELECT 'bad', bad, '', count(*) FROM e WHERE bad IS NOT NULL GROUP BY ALL""",
)
def stream_late_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views from topic records in four arrivals, the job restarted for each: every record is counted, late or bad."""
    path = work_dir(spark, "stream-late")
    records = page_records(arrivals(table(spark, sf_dir, "events")), "arrival")
    delay = dt.timedelta(days=_DELAY_DAYS)
    for arrival in range(_ARRIVALS):
        records.filter(F.col("arrival") == arrival).select("value").write.mode("append").parquet(f"{path}/in")
        source = spark.readStream.schema("value string").parquet(f"{path}/in")
        _, counted = count_records(source, f"{path}/job", watermark=delay, compact_every=2, available_now=True)
        counted.awaitTermination()
    counts = read_hash(spark, f"{path}/job/table", "click_count:")
    late = spark.read.schema("page string, ts timestamp").parquet(part(f"{path}/job/views", late=True))
    late = late.select(F.col("page").alias("key"), field_text(F.date_trunc("minute", "ts")).alias("field"))
    bad = spark.read.schema("parse_error string").parquet(f"{path}/job/bad/batch_id=*")
    bad = bad.select(F.col("parse_error").alias("key"), F.lit("").alias("field"))
    rest = late.withColumn("part", F.lit("late")).unionByName(bad.withColumn("part", F.lit("bad")))
    rest = rest.groupBy("part", "key", "field").agg(F.count(F.lit(1)).alias("value"))
    return counts.withColumn("part", F.lit("counted")).unionByName(rest)


@query(
    "stream_reconciliation",
    f"""{_DETECTED}, r AS (SELECT vec_id, vec_id % 13 = 1 AS bad FROM predicted),
d AS (SELECT *, CASE WHEN vec_id % 10 = 1 THEN 'lost' WHEN vec_id % 10 = 2 THEN 'doubled' WHEN vec_id % 10 = 3 OR (vec_id % 10 = 4 AND NOT bad) THEN 'differing' ELSE 'same' END AS outcome FROM r)
SELECT 'as run' AS side, 'same' AS outcome, count(*) AS n, 0.0::DOUBLE AS max_gap FROM r
UNION ALL SELECT 'damaged', outcome, count(*), max(CASE WHEN outcome = 'lost' OR bad THEN NULL WHEN vec_id % 10 = 4 THEN 0.25::DOUBLE ELSE 0 END) FROM d GROUP BY 2
UNION ALL SELECT 'damaged', 'extra', 1, NULL""",
)
def stream_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scoring stream that breaks down after writing a batch and is started again, record by record against the batch job.

    The same with its results damaged on purpose: what was lost, doubled, changed or made up is named.
    """
    path = work_dir(spark, "reconcile")
    raw = flow_records(spark, sf_dir).withColumn("value", F.when(F.col("vec_id") % 13 != 1, F.col("value")))
    written: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/batch_id={batch_id}")
        written.append(batch_id)
        if len(written) == 2:  # its results are there, but the checkpoint does not know
            raise RuntimeError("stopped")

    for half in (0, 1, 1):
        if len(written) < 2:
            raw.filter(F.col("vec_id") % 2 == half).write.mode("append").parquet(f"{path}/in")
        source = spark.readStream.schema(raw.schema).parquet(f"{path}/in")
        try:
            predict_stream(source, scorer, write, f"{path}/checkpoint", available_now=True).awaitTermination()
        except StreamingQueryException:
            if len(written) != 2:
                raise
    online = spark.read.schema("vec_id bigint, label string, confidence double").parquet(f"{path}/out/batch_id=*")
    offline = predictions(raw, scorer)
    tenth = F.col("vec_id") % 10
    damaged = online.filter(tenth != 1).unionByName(online.filter(tenth == 2)).withColumns(
        {
            "label": F.when(tenth == 3, "other").otherwise(F.col("label")),
            "confidence": F.when(tenth == 4, F.col("confidence") + 0.25).otherwise(F.col("confidence")),
        }
    )
    made_up = online.limit(1).select(F.lit(-1).cast("bigint").alias("vec_id"), "label", "confidence")
    sides = {"as run": online, "damaged": damaged.unionByName(made_up)}
    return reduce(
        DataFrame.unionByName,
        [
            reconcile(df, offline, "vec_id").groupBy(F.lit(name).alias("side"), "outcome").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("gap"), 6).alias("max_gap"))
            for name, df in sides.items()
        ],
    )


_RULE_RANGE, _DAY = 20 * 86_400, 86_400
_SESSION_RULES = {r.name: replace(r, limit=limit) for r, limit in zip(session_rules(), (0.0001, 500))}
_BOUNDS_SQL = ", ".join(f"'{b}'" for b in (*LATENCY_BOUNDS, "+Inf"))


@query(
    "session_job",
    f"""WITH {_UI}, ev AS (SELECT CAST(event_id AS VARCHAR) AS event_id, event_id % 7 AS kind, epoch_us(ts) // 1000 * 1000 AS us, {_ARRIVAL_SQL} AS arrival FROM events),
fl AS (SELECT s.*, ev.arrival FROM scored s JOIN ev USING (event_id) WHERE score > 0.8 AND kind > 2),
b AS (SELECT arrival, max(us) AS us FROM ev WHERE kind > 2 GROUP BY 1),
n AS (SELECT b.us, 'flags' AS series, (SELECT count(*) FROM fl WHERE fl.arrival = b.arrival) AS c FROM b
  UNION ALL SELECT b.us, le, (SELECT count(*) FROM fl WHERE fl.arrival = b.arrival AND (le = '+Inf' OR latency_ms <= try_cast(le AS INTEGER)))
  FROM b, (SELECT unnest([{_BOUNDS_SQL}]) AS le)),
t AS (SELECT series, us, CAST(sum(c) OVER (PARTITION BY series ORDER BY us) AS DOUBLE) AS value FROM n),
tf AS (SELECT * FROM t WHERE series = 'flags'), tb AS (SELECT * FROM t WHERE series <> 'flags'),
{rate_sql('rf', 'tf', _RULE_RANGE, _DAY)}, {rate_sql('rb', 'tb', _RULE_RANGE, _DAY)},
c AS (SELECT us, CASE WHEN series = '+Inf' THEN 'inf'::DOUBLE ELSE CAST(series AS DOUBLE) END AS le, value AS c FROM rb),
{quantile_sql('p95', 'c', 0.95, 'us')}
SELECT 'flag' AS part, session_id AS key, CAST(count(*) AS BIGINT) AS us, round(max(score), 6) AS value FROM fl GROUP BY 2
UNION ALL SELECT 'bad', CASE event_id % 7 WHEN 0 THEN 'null_record' WHEN 1 THEN 'malformed' ELSE 'missing:event_id' END, count(*), 0 FROM events WHERE event_id % 7 < 3 GROUP BY 2
UNION ALL SELECT 'counter', series, us, value FROM t
UNION ALL SELECT 'rule', 'HighFraudFlagRate', us, round(value * 60, 6) FROM rf WHERE round(value * 60, 6) > 0.0001
UNION ALL SELECT 'rule', 'PipelineLatencySLABreach', us, round(value, 6) FROM p95 WHERE round(value, 6) > 500""",
)
def session_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session scoring over four arrivals: flags, bad events, the counters its samples make, and the rules that read them."""
    path = work_dir(spark, "session-job")
    events = arrivals(table(spark, sf_dir, "events"))
    dimensions = prepare_dimensions(**session_dimensions(spark, sf_dir))
    for arrival in range(_ARRIVALS):
        damaged_ui_records(events.filter(F.col("arrival") == arrival)).write.mode("append").parquet(f"{path}/in")
        source = spark.readStream.schema("value string").parquet(f"{path}/in")
        now = F.col("timestamp") + F.col("latency_ms")
        score_stream(source, dimensions, WEIGHTS, BIAS, f"{path}/job", now=now, available_now=True).awaitTermination()
    parts = F.split("value", ",")
    flags = spark.read.text(f"{path}/job/flags/batch_id=*").select(parts[0].alias("key"), parts[1].cast("double").alias("value"))
    flags = flags.groupBy("key").agg(F.count(F.lit(1)).alias("us"), F.round(F.max("value"), 6).alias("value"))
    bad = spark.read.schema("parse_error string").parquet(f"{path}/job/bad/batch_id=*").groupBy(F.col("parse_error").alias("key"))
    bad = bad.agg(F.count(F.lit(1)).alias("us")).withColumn("value", F.lit(0.0))
    counters = counter_totals(spark.read.schema(SCHEMA).parquet(f"{path}/job/samples/batch_id=*"))
    totals = counters.select(F.coalesce(F.col("labels")["le"], F.lit("flags")).alias("key"), micros(F.col("ts")).alias("us"), "value")
    ev = Evaluation(step_s=_DAY, range_s=_RULE_RANGE, hold_s=0, mode="simple", digits=6)
    fired = evaluate_alert_rules(list(_SESSION_RULES.values()), counters, ev).select(F.col("rule").alias("key"), "us", "value")
    found = {"flag": flags, "bad": bad, "counter": totals, "rule": fired}
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("part"), "key", "us", "value") for name, df in found.items()])


@query(
    "stream_counters",
    f"""{_DETECTED} SELECT 'total_flows_processed' AS name, CAST(count(*) AS DOUBLE) AS value FROM predicted
UNION ALL SELECT 'intrusions_detected', CAST(count(*) AS DOUBLE) FROM predicted WHERE {_NOT_NORMAL}""",
)
def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job counters of a detection stream, exported to the metrics table."""
    path = work_dir(spark, "stream-counters")
    raw = flow_records(spark, sf_dir, stream=True)
    alerts = alert_json(detect_intrusions(raw, scorer, observe=("flows_in", "alerts_out")).alerts)
    listener = MetricsListener(spark, f"{path}/metrics")
    spark.streams.addListener(listener)
    try:
        job = write_text_records(
            alerts, f"{path}/alerts", format="text", checkpoint=f"{path}/checkpoint", available_now=True, name=f"detect-{path[-32:]}"
        )
        job.awaitTermination()
        listener.wait_for(job)
    finally:
        spark.streams.removeListener(listener)
    samples = spark.read.schema(SCHEMA).parquet(f"{path}/metrics").filter(F.col("labels")["job"] == job.name)
    totals = counter_totals(samples)
    counters = totals.filter(F.col("name").isin("total_flows_processed", "intrusions_detected"))
    return counters.groupBy("name").agg(F.max("value").alias("value"))
