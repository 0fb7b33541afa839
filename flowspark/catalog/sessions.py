"""Queries on enrichment and session scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.network import ipv4_number, ipv4_text
from ..operators.enrich import enrich_geo, enrich_lookup, flag_text
from ..operators.joins import HotKeys
from ..plans.sessions import LATENCY_BOUNDS, enrich_events, flag_metrics, prepare_dimensions, score_sessions, write_flags
from ..session import work_dir
from ..sources.records import bad_ui_events, parse_ui_events, to_json_records
from .registry import query
from .views import NOW_MS, table

WEIGHTS = {"risk": 2.0, "failures": 0.3, "is_locked": 1.5, "is_foreign": 1.0, "latency_ms": 0.001}
BIAS = -2.0


def ui_events(events: DataFrame) -> DataFrame:
    number = F.pmod(F.col("event_id") * F.lit(519_024_703), F.lit(2**29))
    day = F.date_format("ts", "yyyyMMdd")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), day).alias("session_id"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        F.lit("button").alias("element_id"),
        F.sha2("props", 256).alias("input_hash"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        (F.col("value") * 10).cast("bigint").alias("latency_ms"),
        F.concat(F.lit("d"), (F.col("user_id") % 50).cast("string")).alias("device_fingerprint"),
        ipv4_text(number).alias("ip"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UI events by way of their JSON text."""
    return parse_ui_events(to_json_records(ui_events(table(spark, sf_dir, "events"))))


def session_dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    user = F.col("c_custkey").cast("string")
    device = F.concat(F.lit("d"), (F.col("c_custkey") % 50).cast("string"))
    base = F.col("n_nationkey").cast("bigint") * F.lit(2**24)
    return {
        "device_risk": c.filter("c_custkey % 50 < 40")
        .groupBy(device.alias("device_fingerprint"))
        .agg((F.max("c_acctbal") / 10000).alias("risk")),
        "account_status": c.filter("c_custkey % 3 <> 0").select(
            user.alias("user_id"), F.when(F.col("c_acctbal") < 2000, "locked").otherwise("active").alias("status")
        ),
        "login_failures": c.filter("c_nationkey % 2 = 0").select(
            user.alias("user_id"), F.col("c_nationkey").cast("int").alias("failures")
        ),
        "geo_ranges": n.select(
            base.alias("lo"), (base + F.lit(2**24 - 1)).alias("hi"), F.col("n_name").alias("country")
        ),
    }


_UI = """ui AS (SELECT CAST(event_id AS VARCHAR) AS event_id,
  user_id || '-' || strftime(ts, '%Y%m%d') AS session_id, CAST(user_id AS VARCHAR) AS user_id,
  epoch_us(ts) // 1000 AS timestamp, CAST(trunc(value * 10) AS BIGINT) AS latency_ms,
  'd' || (user_id % 50) AS device, (event_id * 519024703) % 536870912 AS ip_number FROM events),
device_risk AS (SELECT 'd' || (c_custkey % 50) AS device, max(c_acctbal) / 10000 AS risk
  FROM customer WHERE c_custkey % 50 < 40 GROUP BY 1),
account_status AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id,
  CASE WHEN c_acctbal < 2000 THEN 'locked' ELSE 'active' END AS status FROM customer WHERE c_custkey % 3 <> 0),
login_failures AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, CAST(c_nationkey AS INTEGER) AS failures
  FROM customer WHERE c_nationkey % 2 = 0),
geo AS (SELECT n_nationkey::BIGINT * 16777216 AS lo, n_nationkey::BIGINT * 16777216 + 16777215 AS hi, n_name FROM nation),
enriched AS (SELECT ui.*, coalesce(risk, 0) AS risk, coalesce(status, 'unknown') AS status,
  coalesce(failures, 0) AS failures, coalesce(n_name, 'unknown') AS country
  FROM ui LEFT JOIN device_risk USING (device) LEFT JOIN account_status USING (user_id)
  LEFT JOIN login_failures USING (user_id) LEFT JOIN geo ON ip_number BETWEEN lo AND hi),
scored AS (SELECT *, 1 / (1 + exp(-(2.0::DOUBLE * risk + 0.3::DOUBLE * failures
  + 1.5::DOUBLE * CASE WHEN status = 'locked' THEN 1 ELSE 0 END
  + 1.0::DOUBLE * CASE WHEN country = 'unknown' THEN 1 ELSE 0 END + 0.001::DOUBLE * latency_ms - 2.0::DOUBLE))) AS score
  FROM enriched)"""


@query("enrich_lookup", f"WITH {_UI} SELECT event_id, round(risk, 6) AS risk, status, failures FROM enriched")
def enrich_lookup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = session_dimensions(spark, sf_dir)
    events = _events(spark, sf_dir)
    hot = HotKeys(events)
    df = enrich_lookup(events, d["device_risk"], "device_fingerprint", {"risk": 0.0}, hot=hot)
    df = enrich_lookup(df, d["account_status"], "user_id", {"status": "unknown"}, hot=hot)
    df = enrich_lookup(df, d["login_failures"], "user_id", {"failures": 0}, hot=hot)
    return df.select("event_id", F.round("risk", 6).alias("risk"), "status", "failures")


@query(
    "enrich_lookup_salted",
    f"WITH {_UI} SELECT event_id, round(risk, 6) AS risk FROM enriched",
)
def enrich_lookup_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a dimension taken as too large to broadcast, with hot keys split."""
    risk = session_dimensions(spark, sf_dir)["device_risk"]
    df = enrich_lookup(
        _events(spark, sf_dir), risk, "device_fingerprint", {"risk": 0.0}, max_broadcast_rows=10, hot_rows=50
    )
    return df.select("event_id", F.round("risk", 6).alias("risk"))


@query("enrich_geo", f"WITH {_UI} SELECT event_id, ip_number, country FROM enriched")
def enrich_geo_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = enrich_geo(_events(spark, sf_dir), session_dimensions(spark, sf_dir)["geo_ranges"])
    return df.select("event_id", ipv4_number(F.col("ip")).alias("ip_number"), "country")


@query("enrich_geo_salted", f"WITH {_UI} SELECT event_id, ip_number, country FROM enriched")
def enrich_geo_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = session_dimensions(spark, sf_dir)["geo_ranges"]
    df = enrich_geo(_events(spark, sf_dir), ranges, max_broadcast_rows=10, hot_rows=2)
    return df.select("event_id", ipv4_number(F.col("ip")).alias("ip_number"), "country")


@query(
    "enrich_geo_nested",
    f"""WITH {_UI}, ranges AS (SELECT lo, hi, n_name FROM geo
  UNION ALL SELECT s_nationkey::BIGINT * 16777216 + s_suppkey * 40000, s_nationkey::BIGINT * 16777216 + s_suppkey * 40000 + 100000 + s_suppkey % 7, 'near ' || s_suppkey % 10 FROM supplier
  UNION ALL SELECT s_nationkey::BIGINT * 16777216 + s_suppkey * 40000 - 9, s_nationkey::BIGINT * 16777216 + s_suppkey * 40000 + 9000000, 'far ' || s_suppkey % 10 FROM supplier),
found AS (SELECT event_id, ip_number, arg_min(r.n_name, (r.hi - r.lo, r.lo, r.n_name)) AS country
  FROM ui LEFT JOIN ranges r ON ip_number BETWEEN lo AND hi GROUP BY ALL)
SELECT event_id, ip_number, coalesce(country, 'unknown') AS country FROM found""",
)
def enrich_geo_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges within and across each other: the narrowest wins, and no event becomes two."""
    wide = session_dimensions(spark, sf_dir)["geo_ranges"]
    s = table(spark, sf_dir, "supplier")
    lo = F.col("s_nationkey").cast("bigint") * F.lit(2**24) + F.col("s_suppkey") * 40000
    tenth = (F.col("s_suppkey") % 10).cast("string")
    near = s.select(lo.alias("lo"), (lo + 100000 + F.col("s_suppkey") % 7).alias("hi"), F.concat(F.lit("near "), tenth).alias("country"))
    far = s.select((lo - 9).alias("lo"), (lo + 9_000_000).alias("hi"), F.concat(F.lit("far "), tenth).alias("country"))
    df = enrich_geo(_events(spark, sf_dir), wide.unionByName(near).unionByName(far))
    return df.select("event_id", ipv4_number(F.col("ip")).alias("ip_number"), "country")


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = enrich_events(_events(spark, sf_dir), prepare_dimensions(**session_dimensions(spark, sf_dir)))
    return score_sessions(enriched, WEIGHTS, BIAS, now=F.lit(NOW_MS))


@query(
    "score_sessions",
    f"""WITH {_UI} SELECT event_id, session_id, round(score, 6) AS score,
  {NOW_MS} - timestamp AS pipeline_latency_ms FROM scored WHERE score > 0.8""",
)
def score_sessions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged(spark, sf_dir).select(
        "event_id", "session_id", F.round("score", 6).alias("score"), "pipeline_latency_ms"
    )


@query(
    "session_flags",
    f"""WITH {_UI} SELECT session_id, count(*) AS n, round(max(score), 6) AS top
FROM scored WHERE score > 0.8 GROUP BY 1""",
)
def session_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags as ``session,score`` text, read back and summed up per session."""
    text = flag_text(_flagged(spark, sf_dir))
    parts = F.split("value", ",")
    back = text.select(parts[0].alias("session_id"), parts[1].cast("double").alias("score"))
    return back.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max("score"), 6).alias("top")
    )


def damaged_ui_records(events: DataFrame) -> DataFrame:
    """UI events as records of a topic, some of them damaged."""
    text = ui_events(events)
    number = F.col("event_id").cast("bigint") % 7
    json = F.to_json(F.struct(*text.columns))
    cases = F.when(number == 1, F.lit("{")).when(number == 2, F.replace(json, F.lit('"event_id"'), F.lit('"id"')))
    value = F.when(number == 0, F.lit(None)).otherwise(F.coalesce(cases, json)).cast("string").alias("value")
    return text.select(value)


@query(
    "bad_ui_events",
    """SELECT CASE event_id % 7 WHEN 0 THEN 'null_record' WHEN 1 THEN 'malformed' WHEN 2 THEN 'missing:event_id' ELSE 'event' END AS outcome,
  count(*) AS n FROM events GROUP BY 1""",
)
def ui_event_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record is an event or set aside with a reason."""
    damaged = damaged_ui_records(table(spark, sf_dir, "events"))
    good = parse_ui_events(damaged).select(F.lit("event").alias("outcome"))
    bad = bad_ui_events(damaged).select(F.col("parse_error").alias("outcome"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(
    "flag_output",
    f"""WITH {_UI} SELECT session_id, count(*) AS n, round(max(score), 6) AS top FROM scored WHERE score > 0.8 GROUP BY 1""",
)
def flag_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags written as text to a sink and read back."""
    path = work_dir(spark, "flags")
    write_flags(_flagged(spark, sf_dir), path, format="text")
    parts = F.split("value", ",")
    back = spark.read.text(path).select(parts[0].alias("session_id"), parts[1].cast("double").alias("score"))
    return back.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("score"), 6).alias("top"))


_BUCKETS_SQL = " UNION ALL ".join(
    f"SELECT 'latency_ms_bucket' AS name, '{b}' AS le, CAST(count(*) FILTER (WHERE {NOW_MS} - timestamp <= {b}) AS DOUBLE) AS value FROM flagged"
    for b in LATENCY_BOUNDS
)


@query(
    "flag_metrics",
    f"""WITH {_UI}, flagged AS (SELECT * FROM scored WHERE score > 0.8)
SELECT 'flagged_sessions_total' AS name, NULL AS le, CAST(count(*) AS DOUBLE) AS value FROM flagged
UNION ALL {_BUCKETS_SQL}
UNION ALL SELECT 'latency_ms_bucket', '+Inf', CAST(count(*) AS DOUBLE) FROM flagged""",
)
def flag_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counter and the latency buckets that the session rules watch, from the job itself."""
    samples = flag_metrics(_flagged(spark, sf_dir), F.timestamp_millis(F.lit(NOW_MS)), job="sessions")
    return samples.select("name", F.col("labels")["le"].alias("le"), "value")
