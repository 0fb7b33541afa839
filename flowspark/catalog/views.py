"""Flow, page-view and metric tables derived from the given parquet tables.

The given tables hold no network flows, so the queries read views of them: vectors
stand for scaled flow features, events for page views and monitoring samples.
Every view keeps all rows of its table. Each has a SQL twin for the comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schema import FEATURES, N_CLASSES, N_FEATURES
from ..session import tune

# Weights of the test classifier in closed form, so that SQL can write them too.
WEIGHTS = [
    [(((i * 7 + j * 3) % 11) - 5) / 10.0 for j in range(N_CLASSES)] for i in range(N_FEATURES)
]
BIAS = [0.0] * N_CLASSES
GAIN = 4.0  # spreads the probabilities so that every class occurs

# Detection time of the batch queries, so that results do not depend on the clock.
NOW_MS = 1_735_689_600_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream."""
    schema = table(spark, sf_dir, name).schema
    # a pattern, since a stream takes a single file by no other name
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_id, actual_index, features``: scaled flow vectors."""
    e = table(spark, sf_dir, "embeddings")
    gained = ", ".join(f"CAST(get(embedding, {i}) * {GAIN}D AS float)" for i in range(N_FEATURES))
    return e.select(
        "vec_id",
        (F.col("label") % N_CLASSES).cast("int").alias("actual_index"),
        F.expr(f"array({gained})").alias("features"),
    )


VECTORS_SQL = f"""vectors AS (
  SELECT vec_id, CAST(label % {N_CLASSES} AS INTEGER) AS actual_index,
         list_transform(embedding[1:{N_FEATURES}], lambda x: CAST(x * 4 AS FLOAT)) AS features
  FROM embeddings)"""


def raw_values(embedding: str) -> dict[str, Column]:
    """Feature values by heading that the trained scaler maps back to about ``GAIN * embedding``."""
    return {
        f.key: F.expr(
            f"CAST(CAST(get({embedding}, {i}) AS double) * {GAIN}D * {f.scale!r}D + {f.mean!r}D AS {f.kind})"
        )
        for i, f in enumerate(FEATURES)
    }


def flow_records(spark: SparkSession, sf_dir: str, *, stream: bool = False) -> DataFrame:
    """``vec_id, value``: one JSON flow record per vector."""
    e = (stream_table if stream else table)(spark, sf_dir, "embeddings")
    values = [c.alias(k) for k, c in raw_values("embedding").items()]
    record = F.struct(*values, *addresses(F.col("vec_id")))
    return e.select("vec_id", F.to_json(record).alias("value"))


def addresses(vec_id: Column) -> list[Column]:
    """Two address fields; every fifth record has no source address."""
    source = F.when(vec_id % 5 != 0, F.concat(F.lit("10.0.0."), (vec_id % 250).cast("string")))
    return [
        source.alias("source_ip"),
        F.concat(F.lit("192.168.1."), (vec_id % 200).cast("string")).alias("destination_ip"),
    ]


def _list(values) -> str:
    return "[" + ", ".join(repr(float(v)) for v in values) + "]::DOUBLE[]"


_MEANS = _list(f.mean for f in FEATURES)
_SCALES = _list(f.scale for f in FEATURES)
_WHOLE = "[" + ", ".join("false" if f.kind == "double" else "true" for f in FEATURES) + "]"

# raw: feature values as the parser sees them; scaled: float32, as the scaler leaves them
FLOWS_SQL = f"""constants AS (SELECT {_MEANS} AS m, {_SCALES} AS s, {_WHOLE} AS whole),
flows0 AS (
  SELECT vec_id, CAST(label % {N_CLASSES} AS INTEGER) AS actual_index, m, s,
         list_transform(range(1, {N_FEATURES + 1}), lambda i:
           CASE WHEN whole[i] THEN trunc(embedding[i]::DOUBLE * 4.0::DOUBLE * s[i] + m[i])
                ELSE embedding[i]::DOUBLE * 4.0::DOUBLE * s[i] + m[i] END) AS raw
  FROM embeddings, constants),
flows AS (
  SELECT vec_id, actual_index, raw,
         list_transform(range(1, {N_FEATURES + 1}), lambda i:
           (raw[i]::FLOAT - m[i]::FLOAT) / s[i]::FLOAT) AS features,
         CASE WHEN vec_id % 5 <> 0 THEN '10.0.0.' || (vec_id % 250) ELSE 'unknown' END AS source_ip,
         '192.168.1.' || (vec_id % 200) AS destination_ip
  FROM flows0)"""


def scored_sql(source: str) -> str:
    """Probabilities and the winning class over ``source.features``."""
    dots = ", ".join(
        "list_dot_product(list_transform(features, lambda x: x::DOUBLE), "
        + _list(row[j] for row in WEIGHTS)
        + ")"
        for j in range(N_CLASSES)
    )
    return f"""logits AS (SELECT *, [{dots}] AS z FROM {source}),
exps AS (SELECT *, list_transform(z, lambda x: exp(x - list_max(z))) AS e FROM logits),
probs AS (SELECT * EXCLUDE (z, e), list_transform(e, lambda x: x / list_sum(e)) AS p FROM exps),
scored AS (
  SELECT *, CAST(list_position(p, list_max(p)) - 1 AS INTEGER) AS class_index,
         list_max(p) AS conf FROM probs),
predicted AS (
  SELECT *, {class_name_sql('class_index')} AS attack_type FROM scored)"""


def class_name_sql(index: str) -> str:
    from ..functions.schema import CLASSES

    cases = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CLASSES))
    return f"CASE {index} {cases} ELSE 'Unknown' END"


def severity_sql(label: str) -> str:
    return (
        f"CASE WHEN {label} IN ('DDoS', 'DoS') THEN 'HIGH' "
        f"WHEN {label} IN ('Brute Force', 'Web Attacks') THEN 'MEDIUM' "
        f"WHEN {label} IN ('Bots', 'Port Scanning') THEN 'LOW' ELSE 'UNKNOWN' END"
    )
