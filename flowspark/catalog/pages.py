"""Queries on page views, the feature table and event counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.evaluate import profile, value_counts
from ..operators.features import fit_labels
from ..operators.windows import field_text, hash_key, nonempty_report, strip_prefix, windowed_counts
from ..plans.page_views import page_view_counts
from ..session import work_dir
from ..sources.hash_store import compact_hash, field_maps, read_hash, upsert_hash
from ..sources.records import bad_page_views, parse_page_views
from .registry import query
from .views import table


def page_views(events: DataFrame) -> DataFrame:
    return events.select(F.concat(F.lit("/"), F.col("event_type")).alias("page"), "ts", "user_id")


def _views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_views(table(spark, sf_dir, "events"))


COUNTS_SQL = """SELECT 'click_count:/' || event_type AS key,
  strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%S') AS field, count(*) AS value
FROM events GROUP BY 1, 2"""


@query("page_view_counts", COUNTS_SQL)
def page_view_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed_counts(_views(spark, sf_dir), "page")


@query("stored_page_view_counts", COUNTS_SQL)
def stored_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scheduled batch: count, store, read back, check that there is something."""
    path = work_dir(spark, "page-views")
    return page_view_counts(_views(spark, sf_dir), path, batch_id=0)


@query(
    "hash_upsert",
    f"""SELECT key, field, CASE WHEN field < '2024-01-20' THEN value
  ELSE value + 1000 END AS value FROM ({COUNTS_SQL})""",
)
def hash_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second, overlapping batch wins; a repeat of it and a compaction change nothing."""
    path = work_dir(spark, "hash")
    counts = windowed_counts(_views(spark, sf_dir), "page")
    later = counts.filter(F.col("field") >= "2024-01-20").withColumn("value", F.col("value") + 1000)
    upsert_hash(counts, 0, path)
    upsert_hash(later, 1, path)
    upsert_hash(later, 1, path)
    compact_hash(spark, path)
    return read_hash(spark, path, "click_count:")


_BATCHES, _COMPACT_EVERY = 50, 12


@query(
    "hash_batches",
    f"""WITH n AS (SELECT event_id % {_BATCHES} AS b, 'click_count:/' || event_type AS key,
  strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') AS field, count(*) AS value FROM events GROUP BY ALL)
SELECT {_BATCHES} AS as_of, key, field, arg_max(value, b) AS value FROM n GROUP BY ALL
UNION ALL SELECT 24, key, field, arg_max(value, b) FROM n WHERE b < 24 GROUP BY ALL""",
)
def hash_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty batches with compactions between them; a reader from before a compaction still reads the state it began with."""
    path = work_dir(spark, "hash-batches")
    views = table(spark, sf_dir, "events")
    counts = views.withColumn("b", F.col("event_id") % _BATCHES).groupBy(
        "b",
        hash_key(F.concat(F.lit("/"), F.col("event_type"))).alias("key"),
        field_text(F.date_trunc("hour", "ts")).alias("field"),
    ).agg(F.count(F.lit(1)).alias("value"))
    staged = work_dir(spark, "hash-staged")
    counts.write.parquet(staged)
    counts = spark.read.schema(counts.schema).parquet(staged)
    early = None
    for b in range(_BATCHES):
        upsert_hash(counts.filter(F.col("b") == b), b, path)
        if b == 23:
            early = read_hash(spark, path)  # planned now, run after a compaction and more batches
        if (b + 1) % _COMPACT_EVERY == 0:
            compact_hash(spark, path, keep=4)
    now = read_hash(spark, path).select(F.lit(_BATCHES).alias("as_of"), "key", "field", "value")
    return now.unionByName(early.select(F.lit(24).alias("as_of"), "key", "field", "value"))


@query(
    "hash_fields",
    f"""SELECT key, substr(field, 1, 10) AS day, CAST(count(*) AS INTEGER) AS n_fields,
  CAST(sum(value) AS BIGINT) AS total, min(field) AS first_field FROM ({COUNTS_SQL}) GROUP BY 1, 2""",
)
def hash_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields of each key, one map per day."""
    maps = field_maps(windowed_counts(_views(spark, sf_dir), "page"))
    values = F.map_values("fields")
    return maps.select(
        "key",
        "day",
        F.size("fields").alias("n_fields"),
        F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
        F.array_min(F.map_keys("fields")).alias("first_field"),
    )


@query(
    "hash_keys",
    """SELECT event_id, 'click_count:/' || event_type AS key, '/' || event_type AS page,
  strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') AS field FROM events""",
)
def hash_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    key = hash_key(F.concat(F.lit("/"), F.col("event_type")))
    return e.select(
        "event_id",
        key.alias("key"),
        strip_prefix(key).alias("page"),
        field_text(F.date_trunc("hour", "ts")).alias("field"),
    )


@query(
    "nonempty_check",
    f"""SELECT 'click_count hashes' AS "check", count(*) > 0 AS passed, count(*) AS n FROM ({COUNTS_SQL})""",
)
def nonempty_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nonempty_report(windowed_counts(_views(spark, sf_dir), "page"), "click_count hashes")


@query("class_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(table(spark, sf_dir, "events"), "event_type")


@query(
    "fit_labels",
    """SELECT event_type AS label, CAST(row_number() OVER (ORDER BY event_type) - 1 AS INTEGER) AS class_index
FROM (SELECT DISTINCT event_type FROM events)""",
)
def fit_labels_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_labels(table(spark, sf_dir, "events"), "event_type")


_PROFILED = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@query(
    "profile",
    " UNION ALL ".join(
        f'SELECT \'{c}\' AS "column", count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns, '
        f"count(*) - count({c}) AS n_nulls FROM events"
        for c in _PROFILED
    ),
)
def profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(table(spark, sf_dir, "events").select(*_PROFILED))


@query(
    "event_latency",
    """SELECT event_id, epoch_us(ts) // 1000 AS event_ms, 1735689600000 - epoch_us(ts) // 1000 AS latency_ms FROM events""",
)
def event_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch milliseconds to time stamps and back, and the age of each event."""
    from ..operators.alerts import event_latency_ms
    from .views import NOW_MS

    ms = table(spark, sf_dir, "events").select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("event_ms")
    )
    back = F.unix_millis(F.timestamp_millis("event_ms"))
    return ms.select(
        "event_id", back.alias("event_ms"), event_latency_ms(back, F.lit(NOW_MS)).alias("latency_ms")
    )


def page_records(e: DataFrame, *others: str) -> DataFrame:
    """Page views as records of a topic, some of them damaged, with other columns of the events."""
    ts = F.col("ts").cast("timestamp")
    time = F.when(F.col("event_id") % 2 == 0, F.unix_millis(ts).cast("string")).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    page = F.when(F.col("event_id") % 9 != 2, F.concat(F.lit("/"), F.col("event_type")))
    text = F.to_json(F.struct(page.alias("page"), F.col("user_id").cast("string").alias("user_id"), F.when(F.col("event_id") % 9 == 3, "soon").otherwise(time).alias("timestamp")))
    damaged = F.when(F.col("event_id") % 9 == 1, "{").otherwise(text)
    return e.select(F.when(F.col("event_id") % 9 != 0, damaged).alias("value"), *others)


@query(
    "page_view_records",
    """SELECT CASE event_id % 9 WHEN 0 THEN 'null_record' WHEN 1 THEN 'malformed' WHEN 2 THEN 'missing:page' WHEN 3 THEN 'bad_time'
  ELSE '/' || event_type || strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%S') END AS outcome, count(*) AS n
FROM events GROUP BY 1""",
)
def page_view_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic records to page views per minute; what is none is set aside with a reason."""
    raw = page_records(table(spark, sf_dir, "events"))
    minute = F.date_format(F.date_trunc("minute", "ts"), "yyyy-MM-dd'T'HH:mm:ss")
    good = parse_page_views(raw).select(F.concat("page", minute).alias("outcome"))
    bad = bad_page_views(raw).select(F.col("parse_error").alias("outcome"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
