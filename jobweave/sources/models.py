"""Model persistence in Spark ML's own format."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    try:
        return PipelineModel.load(path)
    except Exception as error:
        raise FileNotFoundError(f"no model could be read from {path}") from error


def model_or_load(model: PipelineModel | None, path: str) -> PipelineModel:
    """The given model, or the saved one when none is given."""
    return load_model(path) if model is None else model
