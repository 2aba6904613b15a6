"""Labelled features to a stored classifier and its validation."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from ..operators.learn import evaluate, predict, train_head


def train_and_validate(
    training: DataFrame, validation: DataFrame, features: str, label: str, path: str
) -> DataFrame:
    """Train the head, store it at ``path``, and evaluate the stored model."""
    train_head(training, features, label).write().overwrite().save(path)
    return evaluate(predict(PipelineModel.load(path), validation, features), label)
