"""Reading and writing records: message topics, files, training tables.

The Kafka and Avro paths need Spark's own connector packages on the class path;
every other format comes with Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions.fence import once
from ..functions.schema import TRAINING_SCHEMA, UI_EVENT_SCHEMA

CHECKPOINT_INTERVAL = "10 seconds"


def read_text_records(
    spark: SparkSession,
    source: str,
    *,
    format: str = "kafka",
    stream: bool = True,
    starting: str | None = None,
    ending: str | None = None,
    servers: str | None = None,
    binary: bool = False,
    **options: str,
) -> DataFrame:
    """Raw records as text in column ``value``: flows, page views or UI events.

    With ``binary`` the value stays bytes, as Avro records need it.

    ``source`` is a topic for ``kafka``, else a path (``text``: one record per line;
    ``parquet``: a string column ``value``). A stream starts at the latest offsets
    and then goes on from its checkpoint; a batch reads from the earliest to the
    latest. ``starting`` and ``ending`` override that. Kafka needs ``servers``; its
    other settings, such as a consumer ``kafka.group.id``, are ``options``.
    """
    reader = spark.readStream if stream else spark.read
    if format == "kafka":
        _need(servers)
        reader = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", source)
            .option("startingOffsets", starting or ("latest" if stream else "earliest"))
        )
        if not stream:
            reader = reader.option("endingOffsets", ending or "latest")
        rows = reader.options(**options).load()
        return rows.select("value" if binary else F.col("value").cast("string").alias("value"))
    return reader.format(format).schema(f"value {'binary' if binary else 'string'}").options(**options).load(source)


def _need(servers: str | None) -> str:
    if not servers:
        raise ValueError("name the Kafka servers")
    return servers


def write_text_records(
    df: DataFrame,
    target: str,
    *,
    format: str = "kafka",
    checkpoint: str | None = None,
    available_now: bool = False,
    servers: str | None = None,
    name: str | None = None,
    **options: str,
) -> StreamingQuery | None:
    """Write column ``value`` to a topic or path; returns the query for a stream.

    A stream always has a checkpoint, so it continues where it stopped and file
    sinks hold each record once.
    """
    rows = df.select(F.col("value").cast("string").alias("value"))
    if format == "kafka":
        options = {"kafka.bootstrap.servers": _need(servers), "topic": target, **options}
    else:
        options = {"path": target, **options}
    if not df.isStreaming:
        rows.write.format(format).mode("append").options(**options).save()
        return None
    return start(
        rows.writeStream.format(format).outputMode("append").options(**options),
        checkpoint,
        available_now=available_now,
        name=name,
    )


def start(
    writer: DataStreamWriter,
    checkpoint: str | None,
    *,
    available_now: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Start a stream: every 10 seconds, or once over what is there with ``available_now``."""
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder")
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=CHECKPOINT_INTERVAL).start()


def to_json_records(df: DataFrame) -> DataFrame:
    """Whole rows as JSON text."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def parse_ui_events(df: DataFrame, *, avro_schema: str | None = None) -> DataFrame:
    """UI events from JSON text, or from Avro where a schema is given and the package is there.

    The rest is what ``bad_ui_events`` gives: no record is in neither.
    """
    return ui_events_of(ui_records(df, avro_schema))


def bad_ui_events(df: DataFrame, *, avro_schema: str | None = None) -> DataFrame:
    """``value`` and ``parse_error`` of records that are no event: null, unreadable or without an id."""
    return bad_events_of(ui_records(df, avro_schema))


def ui_events_of(records: DataFrame) -> DataFrame:
    """The events among what ``ui_records`` has read."""
    return records.select("_event.*").filter(F.col("event_id").isNotNull())


def bad_events_of(records: DataFrame) -> DataFrame:
    """The others, with the reason."""
    rows = records.filter(F.col("_event.event_id").isNull())
    empty = F.forall(F.array(*[F.col(f"_event.{f}").isNull() for f in UI_EVENT_SCHEMA.names]), lambda x: x)
    reason = F.when(F.col("value").isNull(), "null_record").when(empty, "malformed").otherwise("missing:event_id")
    return rows.select("value", reason.alias("parse_error"))


PAGE_VIEW_SCHEMA = "page string, user_id string, timestamp string"


def _page_view_records(df: DataFrame) -> DataFrame:
    view = F.from_json(F.col("value"), PAGE_VIEW_SCHEMA)
    ms = F.col("_view.timestamp").try_cast("bigint")
    text = F.try_to_timestamp("_view.timestamp")
    return df.withColumn("_view", view).withColumn("_ts", F.coalesce(F.timestamp_millis(ms), text))


def parse_page_views(df: DataFrame) -> DataFrame:
    """``page, ts, user_id`` from JSON text; the time is epoch milliseconds or a time stamp as text.

    The rest is what ``bad_page_views`` gives: no record is in neither.
    """
    rows = _page_view_records(df).filter(F.col("_view.page").isNotNull() & F.col("_ts").isNotNull())
    return rows.select("_view.page", F.col("_ts").alias("ts"), "_view.user_id")


def bad_page_views(df: DataFrame) -> DataFrame:
    """``value`` and ``parse_error`` of records without a page or a readable time."""
    rows = _page_view_records(df).filter(F.col("_view.page").isNull() | F.col("_ts").isNull())
    reason = (
        F.when(F.col("value").isNull(), "null_record")
        .when(F.col("_view.page").isNotNull(), "bad_time")
        .when(F.col("_ts").isNotNull() | F.col("_view.user_id").isNotNull(), "missing:page")
        .otherwise("malformed")
    )
    return rows.select("value", reason.alias("parse_error"))


def ui_records(df: DataFrame, avro_schema: str | None = None) -> DataFrame:
    """``df`` with the ``_event`` its ``value`` holds, read once."""
    if avro_schema:
        from pyspark.sql.avro.functions import from_avro

        record = from_avro(F.col("value"), avro_schema, {"mode": "PERMISSIVE"})
    else:
        record = F.from_json(F.col("value").cast("string"), UI_EVENT_SCHEMA)
    return once(df, _event=record)


def read_training_csv(spark: SparkSession, path: str) -> DataFrame:
    """Training table with a header and a fixed schema; nothing is inferred."""
    return spark.read.csv(path, header=True, schema=TRAINING_SCHEMA, enforceSchema=False)


def split_training_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(rows, bad)``: typed training rows, and the raw ``value`` and ``parse_error`` of all other lines.

    A line is bad with ``bad_columns`` if it has not as many cells as the schema, with ``empty:<heading>`` or
    ``bad_cell:<heading>`` for its first cell that is empty or does not read as its type.
    Header lines, one per file, are neither. Cells do not run over line ends.
    """
    names = [f.name for f in TRAINING_SCHEMA.fields]
    cells = ", ".join(f"`c{i}` string" for i in range(len(names)))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    lines = spark.read.text(path).filter(F.col("value") != ",".join(names))
    read = lines.withColumn("_row", F.from_csv("value", f"{cells}, _corrupt string", options))
    texts = {f"c{i}": F.col(f"_row.c{i}") for i in range(len(names))}
    read = read.select("value", F.col("_row._corrupt").isNotNull().alias("_odd"), *[c.alias(n) for n, c in texts.items()])
    typed = {f.name: F.col(f"c{i}").try_cast(f.dataType) for i, f in enumerate(TRAINING_SCHEMA.fields)}
    reasons = [
        F.when(F.col(f"c{i}").isNull(), f"empty:{n}").when(typed[n].isNull(), f"bad_cell:{n}") for i, n in enumerate(names)
    ]
    checked = once(read, **{"parse_error": F.when(F.col("_odd"), "bad_columns").otherwise(F.coalesce(*reasons))})
    rows = checked.filter(F.col("parse_error").isNull()).select(*[c.alias(n) for n, c in typed.items()])
    return rows, checked.filter(F.col("parse_error").isNotNull()).select("value", "parse_error")
