"""Classifiers as distributed scoring jobs, and the baselines that produce them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fence import all_but, fence
from ..functions.schema import N_CLASSES, N_FEATURES
from ..functions.vectors import linear
from ..session import ship_package
from .parse import bad_length

Matrix = Sequence[Sequence[float]]


def score_linear(
    df: DataFrame,
    weights: Matrix,
    bias: Sequence[float],
    *,
    vector: str = "features",
    out: str = "probabilities",
) -> DataFrame:
    """Softmax over a linear layer, in column arithmetic: no Python worker, no exchange.

    A vector with a NULL element gets NULL probabilities.
    """
    k = len(bias)
    inputs = [f"get(_v, {i})" for i in range(len(weights))]
    z = [f"{text} AS _z{j}" for j, text in enumerate(linear(inputs, weights, bias))]
    e = {f"_e{j}": f"exp(_z{j} - greatest({', '.join(f'_z{i}' for i in range(k))}))" for j in range(k)}
    total = " + ".join(e)
    p = f"array({', '.join(f'{c} / ({total})' for c in e)})"
    # The vector is made once in front of the sums. These stay a projection, which is
    # always compiled; the fence behind it keeps filters on the result from reaching them.
    whole = fence(df, _v=f"`{vector}`")
    sums = whole.selectExpr(all_but(whole, ("_v",)), *z)
    powers = fence(sums, drop=tuple(f"_z{j}" for j in range(k)), **e)
    return powers.selectExpr(all_but(powers, tuple(e)), f"{p} AS `{out}`")


_sessions: dict[str, Any] = {}


def _onnx_session(digest: str, model: Any) -> Any:
    """One inference session per Python worker, kept between tasks until another model comes."""
    import onnxruntime as ort

    if digest not in _sessions:
        options = ort.SessionOptions()
        options.intra_op_num_threads = 1  # the worker has one core; Spark runs many workers
        _sessions.clear()
        _sessions[digest] = ort.InferenceSession(model.value, options, providers=["CPUExecutionProvider"])
    return _sessions[digest]


def score_onnx(
    df: DataFrame,
    model: str | bytes,
    *,
    n_features: int = N_FEATURES,
    n_classes: int = N_CLASSES,
    vector: str = "features",
    out: str = "probabilities",
) -> DataFrame:
    """Run an ONNX classifier (input ``features`` [n, 52], output ``output`` [n, 7]) by Arrow batch.

    ``model`` is a path on the driver or the model itself; it is broadcast, and known
    by its content, so that a new model under an old name is a new model. A batch the
    model rejects is retried row by row, and a row it rejects, a vector of another
    length or one with a NULL element gets NULL probabilities.
    """
    if isinstance(model, str):
        with open(model, "rb") as f:
            model = f.read()
    digest, shared = hashlib.sha256(model).hexdigest(), df.sparkSession.sparkContext.broadcast(model)
    ship_package(df.sparkSession)
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(T.FloatType()))])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        session = _onnx_session(digest, shared)

        def infer(x: Any) -> Any:
            y = session.run(["output"], {"features": x})[0]
            if y.shape[1] != n_classes:
                raise ValueError(f"expected {n_classes} classes, got {y.shape[1]}")
            return y

        def infer_rows(x: Any) -> tuple[Any, Any]:
            ok = np.ones(len(x), dtype=bool)
            y = np.zeros((len(x), n_classes), dtype=np.float32)
            for i in range(len(x)):
                try:
                    y[i] = infer(x[i : i + 1])[0]
                except Exception:
                    ok[i] = False
            return y, ok

        for batch in batches:
            column = batch.column(batch.schema.get_field_index(vector))
            sizes = np.asarray(pa.compute.list_value_length(column).fill_null(-1))
            gaps = np.asarray(column.flatten().is_null())
            whole = np.bincount(np.repeat(np.arange(len(sizes)), np.maximum(sizes, 0)), gaps, len(sizes)) == 0
            fits = np.flatnonzero((sizes == n_features) & whole)
            flat = column.take(pa.array(fits)).flatten()
            x = np.asarray(flat, dtype=np.float32).reshape(len(fits), n_features)
            y, ok = np.zeros((0, n_classes), dtype=np.float32), np.zeros(0, dtype=bool)
            if len(fits):
                try:
                    y, ok = infer(x), np.ones(len(x), dtype=bool)
                except Exception:
                    y, ok = infer_rows(x)
            scored = np.zeros(batch.num_rows, dtype=bool)
            scored[fits[ok]] = True
            offsets = np.concatenate([[0], np.cumsum(scored) * n_classes]).astype(np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(offsets),
                pa.array(y[ok].ravel(), type=pa.float32()),
                mask=pa.array(~scored),
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists], names=[*batch.schema.names, out]
            )

    import pyarrow.compute  # noqa: F401  (binds pa.compute for the closure above)

    return df.mapInArrow(score, schema)


def bad_probabilities(vector: str = "probabilities", n: int = N_CLASSES) -> Any:
    """Reason ``bad_length`` unless the model gave one probability per class."""
    return bad_length(F.col(vector), n)


def _with_vector(df: DataFrame, vector: str) -> DataFrame:
    return df.withColumn("_features", array_to_vector(F.col(vector).cast("array<double>")))


def _estimator(kind: str, label: str, seed: int, params: Mapping[str, Any] | None = None) -> Any:
    if kind == "random_forest":
        given = {"numTrees": 20, "maxDepth": 5, "seed": seed, **(params or {})}
        return RandomForestClassifier(featuresCol="_features", labelCol=label, **given)
    if kind == "logistic":
        given = {"maxIter": 50, "regParam": 0.01, **(params or {})}
        return LogisticRegression(featuresCol="_features", labelCol=label, **given)
    raise ValueError(f"unknown baseline {kind!r}")


def fit_baseline(
    df: DataFrame,
    kind: str,
    *,
    seed: int = 42,
    vector: str = "features",
    label: str = "class_index",
    params: Mapping[str, Any] | None = None,
) -> PipelineModel:
    """Fit ``random_forest`` or ``logistic`` on a vector column and class indexes.

    ``params`` go to the estimator: trees, depth, iterations, regularisation.
    """
    data = _with_vector(df, vector).withColumn(label, F.col(label).cast("double"))
    return Pipeline(stages=[_estimator(kind, label, seed, params)]).fit(data)


def tune(
    df: DataFrame,
    grid: Mapping[str, Sequence[Any]],
    *,
    kind: str = "logistic",
    train_ratio: float = 0.8,
    parallelism: int = 4,
    seed: int = 42,
    vector: str = "features",
    label: str = "class_index",
) -> tuple[Model, list[tuple[dict[str, Any], float]]]:
    """Try every point of ``grid`` (parameter name -> values) and keep the most accurate.

    Returns the best model and ``(parameters, accuracy)`` of each trial, best first.
    """
    estimator = _estimator(kind, label, seed)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    search = TrainValidationSplit(
        estimator=estimator,
        estimatorParamMaps=builder.build(),
        evaluator=MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy"),
        trainRatio=train_ratio,
        parallelism=parallelism,
        seed=seed,
    )
    data = _with_vector(df, vector).withColumn(label, F.col(label).cast("double"))
    fitted = search.fit(data)
    trials = [
        ({p.name: v for p, v in point.items()}, accuracy)
        for point, accuracy in zip(search.getEstimatorParamMaps(), fitted.validationMetrics)
    ]
    return fitted.bestModel, sorted(trials, key=lambda t: -t[1])


def score_model(
    df: DataFrame, model: Any, *, vector: str = "features", out: str = "probabilities"
) -> DataFrame:
    """Score with any fitted Spark classifier; class ``i`` is element ``i`` of the result."""
    scored = model.transform(_with_vector(df, vector))
    return scored.select(*df.columns, vector_to_array("probability").alias(out))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
