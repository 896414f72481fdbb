"""Model directory."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def write_model(model: PipelineModel, path: str) -> None:
    """Save, replacing what is there."""
    model.write().overwrite().save(path)


def read_model(path: str) -> PipelineModel:
    """Load a saved model."""
    return PipelineModel.load(path)
