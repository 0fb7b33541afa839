"""Queries on time series: the events table as monitoring samples.

Events lie minutes apart at the small scales, so the queries use hour-long ranges
and coarse grids where the rules have five minutes and 15 seconds.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.histogram import exact_quantiles, histogram, histogram_quantile, merged_quantile, rank_error, sketch_windows
from ..operators.prefix import prefix_sum
from ..operators.series import (
    SECOND,
    agg_by,
    hold,
    instant,
    label,
    mapped,
    rate,
    retain,
    select_series,
    threshold,
)
from ..plans.alerting import (
    LATENCY_P95,
    MEMORY_USAGE,
    Evaluation,
    Expression,
    Reading,
    evaluate_rule,
    evaluate_together,
    expression_points,
    group_notifications,
    infrastructure_rules,
    intrusion_rules,
    plain_decimal,
    rendered,
    rule_table,
    session_rules,
)
from ..session import work_dir
from .registry import query
from .views import table

HOUR = 3600
BOUNDS = [100, 250, 500, 1000]
_RESET = "2024-01-16 00:00:00"  # counters restart here


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _labels(**named: Column) -> Column:
    return F.create_map(*[x for k, c in named.items() for x in (F.lit(k), c)])


def _sample(rows: DataFrame, name: str, labels: Column, value: Column) -> DataFrame:
    return rows.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit(name).alias("name"),
        labels.alias("labels"),
        value.cast("double").alias("value"),
    )


def _counter(
    rows: DataFrame, name: str, by: Column, labels: Column, step: Column, scale: float = 1.0, *, reset: str = _RESET, chunk: str = "day"
) -> DataFrame:
    """Running total of ``step`` per series, restarting once."""
    keyed = rows.withColumn("_series", by).withColumn("_half", F.col("ts") >= F.lit(reset).cast("timestamp_ntz"))
    piece = F.date_trunc(chunk, F.col("ts"))
    total = prefix_sum(keyed, ["_series", "_half"], ["ts", "event_id"], step, piece, "total")
    return _sample(total, name, labels, F.col("total") / F.lit(scale))


def _host(modulus: int = 8) -> Column:
    return F.concat(F.lit("host"), (F.col("user_id") % modulus).cast("string"))


def _service() -> Column:
    return F.concat(F.lit("svc"), (F.col("user_id") % 5).cast("string"))


def _mode() -> Column:
    return F.when(F.col("event_type").isin("click", "view", "signup"), "idle").otherwise("busy")


def _latency() -> Column:
    return (F.col("value") * 10).cast("bigint")


def metric(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Samples of one metric, one per event."""
    e = _events(spark, sf_dir)
    kind = F.col("event_type")
    one = F.lit(1)
    if name == "total_flows_processed":
        return _counter(e, name, kind, _labels(job=kind), one)
    if name == "intrusions_detected":
        hit = F.when(F.col("value") > 40, 1).otherwise(0)
        return _counter(e, name, kind, _labels(job=kind), hit)
    if name == "flagged_sessions_total":
        hit = F.when(F.col("value") > 90, 1).otherwise(0)
        return _counter(e, name, kind, _labels(job=kind), hit)
    if name == "up":
        return _sample(e, name, _labels(job=_service()), F.when(kind == "error", 0).otherwise(1))
    if name == "node_cpu_seconds_total":
        by = F.concat(_host(), _mode())
        millis = F.floor(F.col("value") * 1000)
        return _counter(e, name, by, _labels(instance=_host(), mode=_mode()), millis, 1000.0)
    if name == "node_memory_MemAvailable_bytes":
        return _sample(e, name, _labels(instance=_host()), F.floor(F.col("value")))
    if name == "node_memory_MemTotal_bytes":
        return _sample(e, name, _labels(instance=_host()), F.lit(500) + F.col("user_id") % 8)
    if name == "airflow_dag_run_total":
        return _counter(e, name, kind, _labels(dag=kind), one)
    if name == "airflow_dag_run_failed_total":
        return _counter(e, name, kind, _labels(dag=kind), F.when(F.col("user_id") % 4 == 0, 1).otherwise(0))
    if name == "latency_ms_bucket":
        bounds = F.array(*[F.lit(str(b)) for b in BOUNDS], F.lit("+Inf"))
        each = e.withColumn("le", F.explode(bounds))
        inside = F.when(F.col("le") == "+Inf", 1).otherwise(
            (_latency() <= F.col("le").try_cast("int")).cast("int")
        )
        # even and odd users are served by different jobs
        job = F.concat(F.lit("job"), (F.col("user_id") % 2).cast("string"))
        by = F.concat(job, F.lit("/"), F.col("le"))
        return _counter(each, name, by, _labels(job=job, le=F.col("le")), inside)
    raise ValueError(f"unknown metric {name!r}")


NAMES = (
    "total_flows_processed",
    "intrusions_detected",
    "up",
    "node_cpu_seconds_total",
    "node_memory_MemAvailable_bytes",
    "node_memory_MemTotal_bytes",
    "flagged_sessions_total",
    "latency_ms_bucket",
)


def all_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [metric(spark, sf_dir, n) for n in NAMES])


# ---- SQL twins: series CTEs with columns series, us, value


def _counter_sql(cte: str, by: str, series: str, step: str, scale: str = "1", source: str = "events", reset: str = _RESET) -> str:
    return f"""{cte} AS (SELECT {series} AS series, epoch_us(ts) AS us,
  CAST(sum({step}) OVER (PARTITION BY {by}, ts >= TIMESTAMP '{reset}' ORDER BY ts, event_id
    ROWS UNBOUNDED PRECEDING) AS DOUBLE) / {scale} AS value FROM {source})"""


_JOB = "'{\"job\":\"' || event_type || '\"}'"
_DAG = "'{\"dag\":\"' || event_type || '\"}'"
_HOST = "'{\"instance\":\"host' || (user_id % 8) || '\"}'"
_FLOWS = _counter_sql("flows", "event_type", _JOB, "1")
_INTRUSIONS = _counter_sql("intrusions", "event_type", _JOB, "CASE WHEN value > 40 THEN 1 ELSE 0 END")
_FLAGGED = _counter_sql("flagged", "event_type", _JOB, "CASE WHEN value > 90 THEN 1 ELSE 0 END")
_UP = """up AS (SELECT '{"job":"svc' || (user_id % 5) || '"}' AS series, epoch_us(ts) AS us,
  CASE WHEN event_type = 'error' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS value FROM events)"""
_IDLE = _counter_sql(
    "idle",
    "user_id % 8",
    "'{\"instance\":\"host' || (user_id % 8) || '\",\"mode\":\"idle\"}'",
    "CAST(floor(value * 1000) AS BIGINT)",
    "1000",
    "(SELECT * FROM events WHERE event_type IN ('click', 'view', 'signup'))",
)
_FREE = f"free AS (SELECT {_HOST} AS series, epoch_us(ts) AS us, floor(value) AS value FROM events)"
_TOTAL = f"total AS (SELECT {_HOST} AS series, epoch_us(ts) AS us, CAST(500 + user_id % 8 AS DOUBLE) AS value FROM events)"
_RUNS = _counter_sql("runs", "event_type", _DAG, "1")
_FAILED = _counter_sql("failed", "event_type", _DAG, "CASE WHEN user_id % 4 = 0 THEN 1 ELSE 0 END")
_BUCKETS = _counter_sql(
    "buckets",
    "user_id % 2, le",
    "'{\"job\":\"job' || (user_id % 2) || '\",\"le\":\"' || le || '\"}'",
    "CASE WHEN le = '+Inf' OR CAST(trunc(value * 10) AS BIGINT) <= try_cast(le AS INTEGER) THEN 1 ELSE 0 END",
    "1",
    "(SELECT *, unnest(['" + "', '".join(str(b) for b in BOUNDS) + "', '+Inf']) AS le FROM events)",
)


def _grid_sql(cte: str, source: str, step: int, reach: int) -> str:
    s, r = step * SECOND, reach * SECOND
    return f"""{cte} AS (SELECT series, unnest(range((lo + {s - 1}) // {s}, (hi + {r - 1}) // {s} + 1)) * {s} AS t
  FROM (SELECT series, min(us) AS lo, max(us) AS hi FROM {source} GROUP BY series))"""


def rate_sql(out: str, source: str, range_s: int, step_s: int, mode: str = "simple") -> str:
    """CTEs ending in ``out(series, us, value)``."""
    span = range_s * SECOND
    if mode == "simple":
        value = f"inc / {range_s}"
    else:
        value = f"""inc * (seen + CASE WHEN front < coalesce(zero, front) THEN front ELSE coalesce(zero, front) END
      + CASE WHEN back >= 1.1::DOUBLE * seen / (n - 1) THEN seen / (n - 1) / 2 ELSE back END) / seen / {range_s}"""
    return f"""{out}_d AS (SELECT series, us, value, coalesce(CASE WHEN value < lag(value) OVER w THEN value
    ELSE value - lag(value) OVER w END, 0) AS d FROM {source} WINDOW w AS (PARTITION BY series ORDER BY us)),
{_grid_sql(out + "_g", source, step_s, range_s)},
{out}_w AS (SELECT g.series, g.t, count(*) AS n, sum(d) - arg_min(d, us) AS inc, arg_min(value, us) AS v0,
    CAST(max(us) - min(us) AS DOUBLE) AS seen, CAST(min(us) - (g.t - {span}) AS DOUBLE) AS f0,
    CAST(g.t - max(us) AS DOUBLE) AS back
  FROM {out}_g g JOIN {out}_d s ON g.series = s.series AND s.us > g.t - {span} AND s.us <= g.t
  GROUP BY g.series, g.t HAVING count(*) >= 2),
{out}_e AS (SELECT *, CASE WHEN f0 >= 1.1::DOUBLE * seen / (n - 1) THEN seen / (n - 1) / 2 ELSE f0 END AS front,
    CASE WHEN inc > 0 AND v0 >= 0 THEN seen * v0 / inc END AS zero FROM {out}_w),
{out} AS (SELECT series, t AS us, {value} AS value FROM {out}_e)"""


def instant_sql(out: str, source: str, lookback_s: int, step_s: int) -> str:
    back = lookback_s * SECOND
    return f"""{_grid_sql(out + "_g", source, step_s, lookback_s)},
{out} AS (SELECT g.series, g.t AS us, s.value FROM {out}_g g
  ASOF JOIN {source} s ON g.series = s.series AND g.t >= s.us WHERE s.us > g.t - {back})"""


def hold_sql(out: str, source: str, for_s: int, step_s: int, by: str = "series") -> str:
    """Gaps and islands: a run of consecutive true steps fires once it is old enough."""
    step = step_s * SECOND
    return f"""{out}_i AS (SELECT *, us - {step} * row_number() OVER (PARTITION BY {by} ORDER BY us) AS island FROM {source}),
{out} AS (SELECT * EXCLUDE (island), CASE WHEN us - min(us) OVER (PARTITION BY {by}, island) >= {for_s * SECOND}
  THEN 'firing' ELSE 'pending' END AS state FROM {out}_i)"""


def _rounded(points: DataFrame, digits: int = 6) -> DataFrame:
    return points.select("series", "us", F.round("value", digits).alias("value"))


_ROUNDED = "SELECT series, us, round(value, 6) AS value FROM "


def _samples(spark: SparkSession, sf_dir: str, name: str, **match) -> DataFrame:
    return select_series(metric(spark, sf_dir, name), name, **match)


@query("metric_samples", f"WITH {_FLOWS} SELECT series, us, value FROM flows")
def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A counter per event type, with a restart: running totals over the whole table."""
    return _samples(spark, sf_dir, "total_flows_processed")


@query("rate_simple", f"WITH {_FLOWS}, {rate_sql('r', 'flows', HOUR, 300)} {_ROUNDED} r")
def rate_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _samples(spark, sf_dir, "total_flows_processed")
    return _rounded(rate(s, range_s=HOUR, step_s=300, mode="simple"))


@query("rate_extrapolated", f"WITH {_FLOWS}, {rate_sql('r', 'flows', HOUR, 300, 'ext')} {_ROUNDED} r")
def rate_extrapolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _samples(spark, sf_dir, "total_flows_processed")
    return _rounded(rate(s, range_s=HOUR, step_s=300))


@query("instant_lookup", f"WITH {_UP}, {instant_sql('i', 'up', HOUR, 300)} SELECT series, us, value FROM i")
def instant_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instant(_samples(spark, sf_dir, "up"), step_s=300, lookback_s=HOUR).select("series", "us", "value")


_DOWN = f"{_UP}, {instant_sql('i', 'up', HOUR, 300)}, down AS (SELECT * FROM i WHERE value = 0)"


@query("hold", f"WITH {_DOWN}, {hold_sql('h', 'down', 900, 300)} SELECT series, us, state FROM h")
def hold_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = instant(_samples(spark, sf_dir, "up"), step_s=300, lookback_s=HOUR)
    return hold(threshold(points, "==", 0), for_s=900, step_s=300).select("series", "us", "state")


@query(
    "evaluation_grid",
    f"WITH {_UP}, {instant_sql('i', 'up', 300, 60)} SELECT series, count(*) AS n, min(us) AS first_us, max(us) AS last_us FROM i GROUP BY series",
)
def evaluation_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of a one-minute grid that have a fresh sample."""
    points = instant(_samples(spark, sf_dir, "up"), step_s=60, lookback_s=300)
    return points.groupBy("series").agg(
        F.count(F.lit(1)).alias("n"), F.min("us").alias("first_us"), F.max("us").alias("last_us")
    )


@query(
    "label_match",
    """SELECT event_type, count(*) AS n FROM events
WHERE event_type = 'click' OR regexp_full_match(event_type, 'sign.*|v.ew') GROUP BY 1""",
)
def label_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality and anchored regular expressions on labels."""
    m = _sample(_events(spark, sf_dir), "seen", _labels(job=F.col("event_type")), F.lit(1))
    exact = select_series(m, "seen", equal={"job": "click"})
    matched = select_series(m, "seen", regex={"job": "sign.*|v.ew"})
    both = exact.unionByName(matched).withColumn("event_type", label("job"))
    return both.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "thresholds",
    """SELECT count(*) FILTER (WHERE value > 10) AS above, count(*) FILTER (WHERE value < 1) AS below,
  count(*) FILTER (WHERE floor(value) = 0) AS zero FROM events""",
)
def thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).select("value")
    kept = [
        threshold(e, ">", 10).select(F.lit("above").alias("k")),
        threshold(e, "<", 1).select(F.lit("below").alias("k")),
        threshold(mapped(e, F.floor), "==", 0).select(F.lit("zero").alias("k")),
    ]
    return reduce(DataFrame.unionByName, kept).agg(
        *[F.count_if(F.col("k") == k).alias(k) for k in ("above", "below", "zero")]
    )


@query(
    "retention",
    """SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 200 HOURS""",
)
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    kept = retain(e, 200, F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"))
    return kept.select("event_id", "value")


_AVG = f"""avg_idle AS (SELECT '{{"instance":"' || json_extract_string(series, '$.instance') || '"}}' AS series,
  us, avg(value) AS value FROM r GROUP BY 1, 2)"""


@query(
    "avg_by_instance",
    f"WITH {_IDLE}, {rate_sql('r', 'idle', 6 * HOUR, HOUR)}, {_AVG} {_ROUNDED} avg_idle",
)
def avg_by_instance(spark: SparkSession, sf_dir: str) -> DataFrame:
    idle = _samples(spark, sf_dir, "node_cpu_seconds_total", equal={"mode": "idle"})
    return _rounded(agg_by(rate(idle, range_s=6 * HOUR, step_s=HOUR, mode="simple"), ["instance"], "avg"))


@query(
    "max_by_job",
    f"WITH {_UP}, {instant_sql('i', 'up', HOUR, 300)} SELECT series, us, max(value) AS value FROM i "
    "WHERE regexp_full_match(series, '.*svc[0-2].*') GROUP BY ALL",
)
def max_by_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    up = _samples(spark, sf_dir, "up", regex={"job": "svc[0-2]"})
    return agg_by(instant(up, step_s=300, lookback_s=HOUR), ["job"], "max").select("series", "us", "value")


_SUM_LE = f"""by_le AS (SELECT json_extract_string(series, '$.le') AS le, us, sum(value) AS value FROM r GROUP BY 1, 2)"""


@query(
    "sum_by_le",
    f"""WITH {_BUCKETS}, {rate_sql('r', 'buckets', 6 * HOUR, HOUR)}, {_SUM_LE}
SELECT le, us, round(value, 6) AS value FROM by_le""",
)
def sum_by_le(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rate(_samples(spark, sf_dir, "latency_ms_bucket"), range_s=6 * HOUR, step_s=HOUR, mode="simple")
    return agg_by(r, ["le"], "sum").select(
        label("le").alias("le"), "us", F.round("value", 6).alias("value")
    )


def quantile_sql(out: str, source: str, q: float, by: str) -> str:
    """``source(by, le DOUBLE, c)`` with cumulative counts -> ``out(by, value)``."""
    return f"""{out}_w AS (SELECT {by}, le, c, lag(le) OVER w AS lower, coalesce(lag(c) OVER w, 0) AS below,
    {q} * max(c) OVER (PARTITION BY {by}) AS rnk, max(c) OVER (PARTITION BY {by}) AS total
  FROM {source} WINDOW w AS (PARTITION BY {by} ORDER BY le)),
{out}_h AS (SELECT * FROM {out}_w WHERE total > 0 AND c >= rnk
  QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY le) = 1),
{out} AS (SELECT {by}, CASE WHEN le = 'inf'::DOUBLE THEN lower
  ELSE coalesce(lower, 0) + (le - coalesce(lower, 0)) * (rnk - below) / (c - below) END AS value FROM {out}_h)"""


_LE = "CASE WHEN le = '+Inf' THEN 'inf'::DOUBLE ELSE CAST(le AS DOUBLE) END"
_P95 = f"""{_BUCKETS}, {rate_sql('r', 'buckets', 6 * HOUR, HOUR)}, {_SUM_LE},
c AS (SELECT us, {_LE} AS le, value AS c FROM by_le), {quantile_sql('p95', 'c', 0.95, 'us')}"""


@query("latency_p95", f"WITH {_P95} SELECT us, round(value, 4) AS value FROM p95")
def latency_p95_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Evaluation(step_s=HOUR, range_s=6 * HOUR, mode="simple")
    p = expression_points(LATENCY_P95, metric(spark, sf_dir, "latency_ms_bucket"), ev)
    return p.select("us", F.round("value", 4).alias("value"))


_EDGES = [10, 50, 100, 250, 500, 1000, 2500]
_HIST_SQL = f"""lat AS (SELECT event_type, CAST(trunc(value * 10) AS BIGINT) AS ms FROM events),
hist AS (SELECT event_type, le, count(*) FILTER (WHERE ms <= le) AS c FROM lat,
  (SELECT unnest([{', '.join(f'{b}::DOUBLE' for b in _EDGES)}, 'inf'::DOUBLE]) AS le) GROUP BY 1, 2)"""


def _latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("event_type", _latency().alias("ms"))


@query("latency_histogram", f"WITH {_HIST_SQL} SELECT event_type, CAST(le AS VARCHAR) AS le, c AS n FROM hist")
def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = histogram(_latencies(spark, sf_dir), "ms", _EDGES, ["event_type"])
    le = F.when(F.col("le") == float("inf"), "inf").otherwise(F.col("le").cast("string"))
    return h.select("event_type", le.alias("le"), F.col("count").alias("n"))


@query(
    "histogram_quantile",
    f"WITH {_HIST_SQL}, {quantile_sql('p', 'hist', 0.95, 'event_type')} SELECT event_type, round(value, 4) AS p95 FROM p",
)
def histogram_quantile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = histogram(_latencies(spark, sf_dir), "ms", _EDGES, ["event_type"])
    p = histogram_quantile(h, 0.95, ["event_type"])
    return p.select("event_type", F.round("value", 4).alias("p95"))


@query(
    "latency_percentiles",
    """WITH lat AS (SELECT event_type, CAST(trunc(value * 10) AS BIGINT) AS ms FROM events)
SELECT event_type, round(quantile_cont(ms, 0.5), 4) AS p50, round(quantile_cont(ms, 0.95), 4) AS p95,
  round(quantile_cont(ms, 0.99), 4) AS p99 FROM lat GROUP BY 1""",
)
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles, by running totals over counts of distinct latencies."""
    bucket = F.floor(F.col("v") / 100)
    q = exact_quantiles(_latencies(spark, sf_dir), "ms", [0.5, 0.95, 0.99], ["event_type"], bucket)

    def at(p: float) -> Column:
        return F.round(F.max(F.when(F.col("q") == p, F.col("value"))), 4)

    return q.groupBy("event_type").agg(at(0.5).alias("p50"), at(0.95).alias("p95"), at(0.99).alias("p99"))


@query(
    "approximate_p95",
    """WITH lat AS (SELECT event_type, CAST(trunc(value * 10) AS BIGINT) AS ms FROM events)
SELECT event_type, quantile_disc(ms, 0.95) AS p95 FROM lat GROUP BY 1""",
)
def approximate_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentile from a sketch: one mergeable summary per group, exact below its accuracy."""
    return _latencies(spark, sf_dir).groupBy("event_type").agg(
        F.percentile_approx("ms", 0.95, 100_000).alias("p95")
    )


@query(
    "merged_p95",
    """WITH lat AS (SELECT event_type, week(ts) AS week, CAST(trunc(value * 10) AS BIGINT) AS ms FROM events)
SELECT event_type, week, count(*) AS n, round(quantile_cont(ms, 0.95), 4) AS exact, true AS within_error FROM lat GROUP BY ALL""",
)
def merged_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of an hour each, stored and merged by week, against the exact percentile and the ranks of all values."""
    e = _events(spark, sf_dir).withColumn("ms", _latency())
    path = work_dir(spark, "sketches")
    sketch_windows(e, "ms", "ts", "1 hour", ["event_type"]).write.parquet(path)
    stored = spark.read.parquet(path).withColumn("week", F.weekofyear("start").cast("bigint"))
    found = merged_quantile(stored, 0.95, ["event_type", "week"])
    rows = e.select("event_type", F.weekofyear("ts").cast("bigint").alias("week"), "ms")
    ranks = rows.join(F.broadcast(found), ["event_type", "week"]).groupBy("event_type", "week", "n").agg(
        F.avg((F.col("ms") < F.col("value")).cast("double")).alias("below"), F.avg((F.col("ms") <= F.col("value")).cast("double")).alias("upto")
    )
    near = 2 * rank_error()  # far beyond the 99 of 100 cases
    within = (F.col("below") <= 0.95 + near) & (F.col("upto") >= 0.95 - near)
    exact = exact_quantiles(rows, "ms", [0.95], ["event_type", "week"], F.floor(F.col("v") / 100))
    exact = exact.select("event_type", "week", F.round("value", 4).alias("exact"))
    return ranks.select("event_type", "week", "n", within.alias("within_error")).join(exact, ["event_type", "week"])


_RUN_RATES = f"{_RUNS}, {rate_sql('a', 'runs', HOUR, 300)}, {_FAILED}, {rate_sql('b', 'failed', HOUR, 300)}"


_RUN_NAMES = ("airflow_dag_run_total", "airflow_dag_run_failed_total")
_RUN_EV = Evaluation(step_s=300, range_s=HOUR, mode="simple")


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [metric(spark, sf_dir, n) for n in _RUN_NAMES])


@query(
    "rate_difference",
    f"WITH {_RUN_RATES} SELECT series, us, round(a.value - b.value, 6) AS value FROM a JOIN b USING (series, us)",
)
def rate_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    total, failed = (Reading(n, HOUR) for n in _RUN_NAMES)
    return _rounded(expression_points(Expression(total, failed, combine="difference"), _runs(spark, sf_dir), _RUN_EV))


@query(
    "run_success_ratio",
    f"""WITH {_RUN_RATES} SELECT series, us, round(1 - b.value / a.value, 6) AS value
FROM a JOIN b USING (series, us) WHERE a.value <> 0""",
)
def run_success_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    total, failed = (Reading(n, HOUR) for n in _RUN_NAMES)
    return _rounded(expression_points(Expression(failed, total, scale=-1.0, offset=1.0), _runs(spark, sf_dir), _RUN_EV))


_MEMORY = f"""{_FREE}, {instant_sql('f', 'free', HOUR, 300)}, {_TOTAL}, {instant_sql('t', 'total', HOUR, 300)},
memory AS (SELECT series, us, (1 - f.value / t.value) * 100 AS value FROM f JOIN t USING (series, us))"""


@query("memory_usage", f"WITH {_MEMORY} {_ROUNDED} memory")
def memory_usage_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Evaluation(step_s=300, lookback_s=HOUR)
    names = ("node_memory_MemAvailable_bytes", "node_memory_MemTotal_bytes")
    both = metric(spark, sf_dir, names[0]).unionByName(metric(spark, sf_dir, names[1]))
    return _rounded(expression_points(MEMORY_USAGE, both, ev))


@query(
    "annotations",
    """SELECT event_id, 'Only ' || CAST(floor(value) AS BIGINT) || ' flows per second' AS a,
  'Instance host' || (user_id % 8) || ' is busy beyond its limit' AS b FROM events""",
)
def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {r.name: r for r in intrusion_rules("a", "b") + infrastructure_rules()}
    e = _events(spark, sf_dir).select(
        "event_id",
        F.floor("value").cast("double").alias("value"),
        F.to_json(F.struct(_host().alias("instance"))).alias("series"),
    )
    return e.select(
        "event_id",
        rendered(rules["LowFlowProcessingRate"].description).alias("a"),
        rendered(rules["HighCPUUsage"].description).alias("b"),
    )


def _plain_sql(x: str) -> str:
    return f"rtrim(rtrim(CAST(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)) AS VARCHAR), '0'), '.')"


@query(
    "annotation_numbers",
    f"SELECT event_id, {_plain_sql('value / 4194304')} AS tiny, {_plain_sql('value * 1048576')} AS large, {_plain_sql('value')} AS own FROM events",
)
def annotation_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fractional, tiny and large values as they appear in annotations."""
    value = F.col("value").cast("double")
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        plain_decimal(value / 4194304).alias("tiny"),
        plain_decimal(value * 1048576).alias("large"),
        plain_decimal(value).alias("own"),
    )


# ---- rules

EV = Evaluation(step_s=300, lookback_s=HOUR, range_s=HOUR, hold_s=900, mode="simple")
_SLOW = replace(EV, step_s=HOUR, range_s=6 * HOUR, hold_s=2 * HOUR)


def _tuned(name: str, **changes):
    rules = intrusion_rules("svc0", "svc1") + infrastructure_rules() + session_rules()
    return replace(next(r for r in rules if r.name == name), **changes)


# The data has a few events per hour, hence lower limits on rates.
RULES = {
    "high_intrusion_rate": (_tuned("HighIntrusionRate", limit=0.0005), EV, "intrusions_detected"),
    "job_down": (_tuned("JobDown"), EV, "up"),
    "source_down": (_tuned("SourceDown"), EV, "up"),
    "low_flow_processing_rate": (_tuned("LowFlowProcessingRate", limit=0.0006), EV, "total_flows_processed"),
    "high_cpu_usage": (_tuned("HighCPUUsage", limit=98), _SLOW, "node_cpu_seconds_total"),
    "high_memory_usage": (_tuned("HighMemoryUsage"), EV, None),
    "high_fraud_flag_rate": (_tuned("HighFraudFlagRate", limit=0.01), replace(EV, hold_s=0), "flagged_sessions_total"),
    "latency_breach": (_tuned("PipelineLatencySLABreach", limit=900), replace(_SLOW, hold_s=0), "latency_ms_bucket"),
}


def _rule_sql(source: str, out: str, condition: str, key: str) -> str:
    rule, ev, _ = RULES[key]
    where = f"{out}_c AS (SELECT series, us, round(value, 6) AS value FROM {out} WHERE {condition})"
    return f"{source}, {where}, {hold_sql(out + '_h', out + '_c', int(ev.hold_s), ev.step_s)}"


_RULE_SQL = {
    "high_intrusion_rate": (
        _rule_sql(f"{_INTRUSIONS}, {rate_sql('hi', 'intrusions', HOUR, 300)}", "hi", "value > 0.0005", "high_intrusion_rate"),
        "hi_h",
    ),
    "job_down": (
        _rule_sql(f"{_UP}, {instant_sql('jd', 'up', HOUR, 300)}", "jd", "value = 0 AND series LIKE '%svc0%'", "job_down"),
        "jd_h",
    ),
    "source_down": (
        _rule_sql(f"{_UP}, {instant_sql('sd', 'up', HOUR, 300)}", "sd", "value = 0 AND series LIKE '%svc1%'", "source_down"),
        "sd_h",
    ),
    "low_flow_processing_rate": (
        _rule_sql(f"{_FLOWS}, {rate_sql('lf', 'flows', HOUR, 300)}", "lf", "value < 0.0006", "low_flow_processing_rate"),
        "lf_h",
    ),
    "high_cpu_usage": (
        _rule_sql(
            f"{_IDLE}, {rate_sql('r', 'idle', 6 * HOUR, HOUR)}, {_AVG}, cpu AS (SELECT series, us, 100 - value * 100 AS value FROM avg_idle)",
            "cpu", "value > 98", "high_cpu_usage",
        ),
        "cpu_h",
    ),
    "high_memory_usage": (_rule_sql(_MEMORY, "memory", "value > 90", "high_memory_usage"), "memory_h"),
    "high_fraud_flag_rate": (
        _rule_sql(
            f"{_FLAGGED}, {rate_sql('ff0', 'flagged', HOUR, 300)}, ff AS (SELECT series, us, value * 60 AS value FROM ff0)",
            "ff", "value > 0.01", "high_fraud_flag_rate",
        ),
        "ff_h",
    ),
    "latency_breach": (
        _rule_sql(f"{_P95}, lp AS (SELECT '{{}}' AS series, us, value FROM p95)", "lp", "value > 900", "latency_breach"),
        "lp_h",
    ),
}


def _rule_input(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    name = RULES[key][2]
    if name:
        return metric(spark, sf_dir, name)
    return metric(spark, sf_dir, "node_memory_MemAvailable_bytes").unionByName(
        metric(spark, sf_dir, "node_memory_MemTotal_bytes")
    )


def _register_rule(key: str) -> None:
    rule, ev, _ = RULES[key]
    ctes, out = _RULE_SQL[key]
    sql = f"WITH {ctes} SELECT '{rule.name}' AS rule, '{rule.severity}' AS severity, series, us, value, state FROM {out}"

    @query(f"rule_{key}", sql)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = evaluate_rule(rule, _rule_input(spark, sf_dir, key), ev)
        return found.select("rule", "severity", "series", "us", F.round("value", 6).alias("value"), "state")


for _key in RULES:
    _register_rule(_key)

def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules of all groups, each at its own step and range, in one pass."""
    asked = [(rule, replace(ev, digits=6)) for rule, ev, _ in RULES.values()]
    return evaluate_together(asked, all_metrics(spark, sf_dir))


def _description_sql(template: str) -> str:
    text = template.replace("'", "''")
    text = text.replace("{{ $value }}", f"' || {_plain_sql('value')} || '")
    return "'" + text.replace("{{ $labels.instance }}", "' || json_extract_string(series, '$.instance') || '") + "'"


def _union_sql() -> str:
    """Every rule as a derived table: each brings its own CTEs."""
    parts = []
    for k in RULES:
        ctes, out = _RULE_SQL[k]
        r = RULES[k][0]
        parts.append(
            f"SELECT * FROM (WITH {ctes} SELECT '{r.name}' AS rule, '{r.severity}' AS severity, "
            f"'{r.summary}' AS summary, {_description_sql(r.description)} AS description, series, us, state FROM {out}) {k}"
        )
    return " UNION ALL ".join(parts)


@query(
    "alert_stream",
    f"SELECT rule, severity, series, state, count(*) AS n, min(us) AS first_us, max(us) AS last_us FROM ({_union_sql()}) GROUP BY ALL",
)
def alert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight rules as one stream of alerts."""
    return _stream(spark, sf_dir).groupBy("rule", "severity", "series", "state").agg(
        F.count(F.lit(1)).alias("n"), F.min("us").alias("first_us"), F.max("us").alias("last_us")
    )


@query(
    "notifications",
    f"""WITH each AS (
  SELECT us - us % 30000000 AS group_us, rule, series, max_by(summary, us) AS summary, max_by(description, us) AS description
  FROM ({_union_sql()}) WHERE state = 'firing' GROUP BY 1, 2, 3)
SELECT group_us, 'slack-alerts' AS receiver, count(*) AS n_alerts,
  CASE WHEN min(summary) = max(summary) THEN min(summary) END AS title,
  CASE WHEN min(description) = max(description) THEN min(description) END AS text
FROM each GROUP BY 1""",
)
def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_notifications(_stream(spark, sf_dir))


@query(
    "rule_metadata",
    "WITH r(rule, severity, threshold) AS (VALUES "
    + ", ".join(
        f"('{r.name}', '{r.severity}', {float(r.limit)}::DOUBLE)"
        for r in intrusion_rules("a", "b") + infrastructure_rules() + session_rules()
    )
    + ") SELECT rule, severity, threshold, count(e.value) AS n_above FROM r LEFT JOIN events e ON e.value > threshold GROUP BY ALL",
)
def rule_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each rule with the number of raw values above its limit."""
    rules = rule_table(spark, intrusion_rules("a", "b") + infrastructure_rules() + session_rules())
    limits = {r.limit for r in intrusion_rules("a", "b") + infrastructure_rules() + session_rules()}
    counts = _events(spark, sf_dir).agg(
        *[F.count_if(F.col("value") > float(x)).alias(str(float(x))) for x in sorted(limits)]
    )
    above = counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(float(x)).alias("threshold"), F.col(f"`{float(x)}`").alias("n_above"))
                    for x in sorted(limits)
                ]
            )
        )
    )
    return rules.join(above, "threshold").select("rule", "severity", "threshold", "n_above")
