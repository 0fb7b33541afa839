"""Queries on training-set preparation, baselines and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import decode_label
from ..functions.onnx_linear import linear_onnx
from ..functions.schema import FEATURES, LABEL_COLUMN
from ..operators.alerts import predict
from ..operators.evaluate import class_metrics, compare_predictions, confusion, stratified_split
from ..operators.features import fit_scaler
from ..operators.scoring import load_model, score_model, score_onnx, tune
from ..plans.comparison import compare_online_offline
from ..plans.training import prepare, train_and_evaluate
from ..session import work_dir
from ..sources.records import read_training_csv, split_training_csv
from .flows import predicted_vectors, scorer
from .registry import query
from .views import BIAS, VECTORS_SQL, WEIGHTS, class_name_sql, raw_values, scored_sql, table, vectors

_PREDICTED = f"WITH {VECTORS_SQL}, {scored_sql('vectors')}"


@query(
    "fit_scaler",
    f"""WITH {VECTORS_SQL}, x AS (SELECT unnest(range(1, 53)) AS i, features FROM vectors)
SELECT CAST(i - 1 AS INTEGER) AS pos, round(avg(features[i]::DOUBLE), 6) AS mean,
  round(stddev_pop(features[i]::DOUBLE), 6) AS std FROM x GROUP BY i""",
)
def fit_scaler_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fit_scaler(vectors(spark, sf_dir))
    return f.select("pos", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


_SPLIT_SQL = """SELECT {id} AS id, {label} AS label,
  CASE WHEN row_number() OVER (PARTITION BY {label} ORDER BY md5({id} || ':42'), {id})
    <= round(0.8 * count(*) OVER (PARTITION BY {label})) THEN 'train' ELSE 'test' END AS split FROM {source}"""


@query("stratified_split", _SPLIT_SQL.format(id="event_id", label="event_type", source="events"))
def stratified_split_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact 80/20 split per label, row by row the same as a full sort gives."""
    s = stratified_split(table(spark, sf_dir, "events"), "event_type", by="event_id")
    return s.select(F.col("event_id").alias("id"), F.col("event_type").alias("label"), "split")


@query(
    "split_counts",
    f"""SELECT label, split, count(*) AS n FROM ({_SPLIT_SQL.format(id="doc_id", label="quality", source="labels")}) GROUP BY 1, 2""",
)
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three quarters of the rows have one label."""
    s = stratified_split(table(spark, sf_dir, "labels"), "quality", by="doc_id")
    return s.groupBy(F.col("quality").alias("label"), "split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "encode_and_scale",
    f"""WITH {VECTORS_SQL}, named AS (SELECT vec_id, {class_name_sql('actual_index')} AS label, features FROM vectors),
s AS ({_SPLIT_SQL.format(id="vec_id", label="label", source="named")}),
j AS (SELECT n.vec_id, n.label, n.features, s.split FROM named n JOIN s ON n.vec_id = s.id),
m AS (SELECT avg(features[1]::DOUBLE) AS m1, stddev_pop(features[1]::DOUBLE) AS s1 FROM j WHERE split = 'train')
SELECT vec_id, split, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS class_index,
  round(((features[1] - m1::FLOAT) / s1::FLOAT)::DOUBLE, 4) AS first FROM j, m""",
)
def encode_and_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split, label codes, and a scaler fitted on the training part only."""
    v = _named(spark, sf_dir)
    a, b, *_ = prepare(v, None, "attack", "vec_id", train=0.8, seed=42)
    both = a.unionByName(b)
    return both.select(
        "vec_id", "split", "class_index", F.round(F.get("features", F.lit(0)).cast("double"), 4).alias("first")
    )


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).withColumn("attack", decode_label(F.col("actual_index"))).drop("actual_index")


@query(
    "confusion_matrix",
    """SELECT quality AS actual, count(*) FILTER (WHERE toxic = 0) AS "0", count(*) FILTER (WHERE toxic = 1) AS "1"
FROM labels GROUP BY 1""",
)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "labels").select(F.col("quality").alias("actual"), F.col("toxic").alias("predicted"))
    return confusion(t, [0, 1])


@query(
    "class_metrics",
    f"""{_PREDICTED}, ap AS (SELECT {class_name_sql('actual_index')} AS a, attack_type AS p FROM predicted),
names AS (SELECT a AS label FROM ap UNION SELECT p FROM ap),
c AS (SELECT label, (SELECT count(*) FROM ap WHERE a = label) AS support,
  (SELECT count(*) FROM ap WHERE p = label) AS np, (SELECT count(*) FROM ap WHERE a = label AND p = label) AS hits FROM names),
r AS (SELECT label, support, CASE WHEN np = 0 THEN 0 ELSE hits / np::DOUBLE END AS precision,
  CASE WHEN support = 0 THEN 0 ELSE hits / support::DOUBLE END AS recall FROM c)
SELECT label, support, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END, 6) AS f1,
  round((SELECT avg(CASE WHEN a = p THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FROM ap), 6) AS accuracy FROM r""",
)
def class_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = predicted_vectors(spark, sf_dir).select(
        decode_label(F.col("actual_index")).alias("actual"), F.col("label").alias("predicted")
    )
    m = class_metrics(p)
    return m.select("label", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "accuracy")])


_CSV_REASONS = f"""CASE vec_id % 8 WHEN 0 THEN 'bad_cell:{FEATURES[1].key}' WHEN 1 THEN 'empty:{FEATURES[3].key}' WHEN 2 THEN 'bad_columns'
  WHEN 3 THEN 'bad_columns' WHEN 4 THEN 'empty:{LABEL_COLUMN}' ELSE {class_name_sql('label % 7')} END"""


@query(
    "training_lines",
    f"""SELECT {_CSV_REASONS} AS outcome, count(*) AS n,
  CAST(sum(CASE WHEN vec_id % 8 > 4 THEN trunc(embedding[1]::DOUBLE * 4.0::DOUBLE * {FEATURES[0].scale!r}::DOUBLE + {FEATURES[0].mean!r}::DOUBLE) END) AS BIGINT) AS ports
FROM embeddings GROUP BY 1""",
)
def training_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A training file with unreadable cells, empty ones and too many or few: every line is a row or set aside."""
    e = table(spark, sf_dir, "embeddings")
    label = decode_label((F.col("label") % 7).cast("int"))
    kind = F.col("vec_id") % 8
    cells = [c.cast("string") for c in raw_values("embedding").values()] + [label]
    cells[1] = F.when(kind == 0, F.lit("1x")).otherwise(cells[1])
    cells[3] = F.when(kind == 1, F.lit("")).otherwise(cells[3])
    cells[-1] = F.when(kind == 4, F.lit("")).otherwise(cells[-1])
    line = F.array_join(F.array(*cells), ",")
    line = F.when(kind == 2, F.concat(line, F.lit(",more"))).when(kind == 3, F.substring_index(line, ",", 40)).otherwise(line)
    path = work_dir(spark, "training-lines")
    e.select(line.alias("value")).write.text(path)
    header = ",".join([*(f.key for f in FEATURES), LABEL_COLUMN])
    spark.createDataFrame([(header,)], "value string").write.mode("append").text(path)
    rows, bad = split_training_csv(spark, path)
    port = F.col(f"`{FEATURES[0].key}`").cast("bigint")
    good = rows.groupBy(F.col(f"`{LABEL_COLUMN}`").alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.sum(port).alias("ports"))
    rest = bad.groupBy(F.col("parse_error").alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("bigint").alias("ports"))
    return good.unionByName(rest)


@query(
    "compare_predictions",
    f"""{_PREDICTED}, a AS (SELECT vec_id, attack_type FROM predicted WHERE class_index <> 0),
b AS (SELECT vec_id, attack_type FROM predicted WHERE class_index <> 6)
SELECT vec_id, a.attack_type AS online_label, b.attack_type AS offline_label,
  CASE WHEN b.vec_id IS NULL THEN 'online_only' WHEN a.vec_id IS NULL THEN 'offline_only' ELSE 'both' END AS presence,
  a.attack_type IS NOT DISTINCT FROM b.attack_type AS same_label FROM a FULL JOIN b USING (vec_id)""",
)
def compare_predictions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column scores against model-file scores, each side lacking one class."""
    online = predicted_vectors(spark, sf_dir).filter("class_index <> 0")
    offline = predict(score_onnx(vectors(spark, sf_dir), linear_onnx(WEIGHTS, BIAS))).filter("class_index <> 6")
    return compare_predictions(online, offline, "vec_id").drop("gap")


@query(
    "online_offline_summary",
    f"{_PREDICTED} SELECT 'both' AS presence, count(*) AS n, count(attack_type) AS n_same_label FROM predicted",
)
def online_offline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two scorers agree on the class of every row."""
    online = predicted_vectors(spark, sf_dir)
    offline = predict(score_onnx(vectors(spark, sf_dir), linear_onnx(WEIGHTS, BIAS)))
    summary, _ = compare_online_offline(online, offline, "vec_id")
    return summary.drop("max_gap")


@query(
    "training_csv",
    f"""SELECT {class_name_sql('label % 7')} AS label, count(*) AS n, 0 AS n_nulls FROM embeddings GROUP BY 1""",
)
def training_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training table written as CSV with a header and read with the fixed schema."""
    e = table(spark, sf_dir, "embeddings")
    values = raw_values("embedding")
    label = decode_label((F.col("label") % 7).cast("int")).alias(LABEL_COLUMN)
    path = work_dir(spark, "training-csv")
    e.select(*[c.alias(k) for k, c in values.items()], label).write.csv(path, header=True)
    back = read_training_csv(spark, path)
    nulls = sum((F.col(f"`{f.key}`").isNull().cast("int") for f in FEATURES[1:]), F.col(f"`{FEATURES[0].key}`").isNull().cast("int"))
    return back.groupBy(F.col(f"`{LABEL_COLUMN}`").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.max(nulls).alias("n_nulls")
    )


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors whose class the linear scorer decides, so that there is something to learn."""
    scored = predict(scorer(vectors(spark, sf_dir)))
    return scored.select("vec_id", "features", F.col("label").alias("attack"))


@query("random_forest_metrics")
def random_forest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = train_and_evaluate(_labelled(spark, sf_dir), columns=None, label="attack", by="vec_id", kind="random_forest")
    return t.metrics


@query("logistic_metrics")
def logistic_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = train_and_evaluate(_labelled(spark, sf_dir), columns=None, label="attack", by="vec_id", kind="logistic")
    return t.metrics


@query(
    "model_quality",
    f"""{_PREDICTED}, named AS (SELECT vec_id, attack_type AS label FROM predicted),
s AS ({_SPLIT_SQL.format(id="vec_id", label="label", source="named")})
SELECT kind, label, count(*) AS support, true AS beats_majority
FROM s, (SELECT unnest(['random_forest', 'logistic']) AS kind) WHERE split = 'test' GROUP BY ALL""",
)
def model_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both baselines on the held-out part: its rows per class, and whether they do better than the most frequent class."""
    parts = []
    for kind in ("random_forest", "logistic"):
        t = train_and_evaluate(_labelled(spark, sf_dir), columns=None, label="attack", by="vec_id", kind=kind)
        m = t.metrics.filter("support > 0")
        share = m.agg((F.max("support") / F.sum("support")).alias("share"))
        beats = (F.col("accuracy") > F.col("share")).alias("beats_majority")
        parts.append(m.join(F.broadcast(share)).select(F.lit(kind).alias("kind"), "label", "support", beats))
    return parts[0].unionByName(parts[1])


@query("reloaded_model", "SELECT CAST(0 AS BIGINT) AS n_different, count(*) AS n FROM embeddings")
def reloaded_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved and reloaded model scores every row as the fitted one does."""
    path = work_dir(spark, "model")
    data = _labelled(spark, sf_dir)
    t = train_and_evaluate(data, columns=None, label="attack", by="vec_id", kind="logistic", path=path)
    a = predict(score_model(data, t.model), t.classes)
    b = predict(score_model(data, load_model(path)), t.classes)
    both = compare_predictions(a, b, "vec_id")
    return both.agg(
        F.count_if((F.col("presence") != "both") | ~F.col("same_label") | (F.col("gap") > 1e-12)).alias("n_different"),
        F.count(F.lit(1)).alias("n"),
    )


@query("tuning_trials")
def tuning_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid search of 20 trials on accuracy; one row per trial, best first."""
    data = _labelled(spark, sf_dir)
    train, _, *_ = prepare(data, None, "attack", "vec_id", train=0.8, seed=42)
    _, trials = tune(train, {"regParam": [0.0001, 0.001, 0.01, 0.1, 1.0], "maxIter": [5, 10, 20, 30]})
    rows = [(i, p["regParam"], int(p["maxIter"]), float(a)) for i, (p, a) in enumerate(trials)]
    return spark.createDataFrame(rows, "place int, reg_param double, max_iter int, accuracy double")
