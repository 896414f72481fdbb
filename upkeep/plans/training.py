"""Training job: matrix -> fitted pipeline and its metrics."""

from __future__ import annotations

from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from upkeep.learning import Training, metrics, predict, train


def evaluate(trained: Training) -> DataFrame:
    """The metrics table on the validation rows."""
    return metrics(predict(trained.model, trained.validation))


def train_and_evaluate(matrix: DataFrame, **settings: Any) -> tuple[PipelineModel, DataFrame]:
    """The model and its metrics table on the validation rows.

    ``settings`` go to ``train``.
    """
    trained = train(matrix, **settings)
    return trained.model, evaluate(trained)
