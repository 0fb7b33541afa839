"""Fit, evaluate and keep a baseline classifier."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.evaluate import class_metrics, confusion, stratified_split
from ..operators.features import assemble, fit_labels, fit_scaler, scale, scaler_constants
from ..operators.alerts import predict
from ..operators.joins import PINNED_ROWS, pinned
from ..operators.scoring import fit_baseline, save_model, score_model
from ..session import work_dir


class Trained(NamedTuple):
    model: PipelineModel
    classes: list[str]
    mean: list[float]
    std: list[float]
    predictions: DataFrame
    confusion: DataFrame
    metrics: DataFrame


def prepare(
    df: DataFrame, columns: Sequence[str] | None, label: str, by: str, *, train: float, seed: int
) -> tuple[DataFrame, DataFrame, list[str], list[float], list[float]]:
    """Split, encode the labels and scale by the training part's constants.

    Returns train and test frames with ``features`` and ``class_index``. ``columns``
    is None if ``features`` is there already. The vectors are written once to the
    shared work folder: fitting reads them many times, and only the columns it needs.
    """
    path = work_dir(df.sparkSession, "vectors")
    (assemble(df, columns) if columns else df).write.parquet(path)
    vectors = df.sparkSession.read.parquet(path)
    split = stratified_split(vectors, label, by=by, train=train, seed=seed)
    codes = pinned(fit_labels(vectors, label), PINNED_ROWS)
    names = [r["label"] for r in codes.orderBy("class_index").collect()]
    coded = split.join(codes, F.col(label) == codes["label"]).drop(codes["label"])
    mean, std = scaler_constants(fit_scaler(coded.filter("split = 'train'")))
    scaled = scale(coded, mean, std, guard_zero=True)
    return scaled.filter("split = 'train'"), scaled.filter("split = 'test'"), names, mean, std


def train_and_evaluate(
    df: DataFrame,
    *,
    columns: Sequence[str] | None,
    label: str,
    by: str,
    kind: str = "random_forest",
    train: float = 0.8,
    seed: int = 42,
    path: str | None = None,
) -> Trained:
    """Fit ``kind`` on a stratified split of ``df`` and evaluate it on the rest."""
    fit_part, test_part, names, mean, std = prepare(df, columns, label, by, train=train, seed=seed)
    model = fit_baseline(fit_part, kind, seed=seed)
    if path:
        save_model(model, path)
    scored = predict(score_model(test_part, model), names).withColumnRenamed("label", "predicted")
    predictions = scored.withColumn("actual", F.col(label))
    return Trained(
        model, names, mean, std, predictions, confusion(predictions, names), class_metrics(predictions)
    )
