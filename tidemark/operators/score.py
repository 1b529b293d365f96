"""Batch scoring with feature lookup, and scoring with any Python model."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import FeatureFunction, add_literals
from tidemark.operators.lookup import FeatureLookup, training_set
from tidemark.operators.train import TrainedModel


def score_batch(
    keys: DataFrame,
    specs: Sequence[FeatureLookup | FeatureFunction],
    model: TrainedModel,
    result_type: str = "string",
    prediction: str = "prediction",
) -> DataFrame:
    """Look up features for the key rows and score them; the prediction has ``result_type``."""
    features = training_set(keys, specs, label=None)
    scored = model.score(features, prediction)
    return scored.withColumn(prediction, F.col(prediction).cast(result_type))


def score_with(
    df: DataFrame,
    load: Callable[[], Callable[[pd.DataFrame], pd.Series]],
    inputs: Sequence[str],
    result_type: str = "string",
    prediction: str = "prediction",
) -> DataFrame:
    """Score with any Python model, over Arrow batches.

    ``load`` runs once per task, so the model is not loaded again for every batch; only
    the input columns travel to Python.
    """

    @F.pandas_udf(result_type)
    def predict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = load()
        for columns in batches:
            yield model(pd.concat(columns, axis=1, keys=list(inputs)))

    if len(inputs) == 1:

        @F.pandas_udf(result_type)
        def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:  # noqa: F811
            model = load()
            for column in batches:
                yield model(column.to_frame(inputs[0]))

    return df.withColumn(prediction, predict(*[F.col(c) for c in inputs]))


def stamp_predictions(
    scored: DataFrame, model_name: str, version: str, at: dt.datetime | None = None, drop: Sequence[str] = ("split",)
) -> DataFrame:
    """Predictions as they go to the log: no split, with model name, version and inference time."""
    at = at if at is not None else dt.datetime.now(dt.timezone.utc)
    marks = {"model_name": model_name, "model_version": str(version), "inference_timestamp": at}
    return add_literals(scored.drop(*drop), marks)


def append_new(log: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose ``keys`` the log does not hold yet, so a repeated append adds nothing."""
    return batch.join(log.select(*keys), list(keys), "left_anti")


def can_score(sample: DataFrame, score: Callable[[DataFrame], DataFrame]) -> tuple[bool, str]:
    """Gate: the model must be able to score the sample."""
    try:
        count = score(sample).count()
    except Exception as error:  # the gate reports whatever stops the model
        return False, f"Inference failed: {str(error).splitlines()[0]}"
    return True, f"Scored {count} rows successfully."
