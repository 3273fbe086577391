"""Saved pipelines."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel


class ModelNotFoundError(FileNotFoundError):
    """No saved pipeline at the given path."""


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    """Load a saved pipeline; a missing artefact is a clear error."""
    try:
        return PipelineModel.load(path)
    except (AnalysisException, Py4JJavaError, ValueError) as error:
        if "not exist" in str(error) or "PATH_NOT_FOUND" in str(error) or "empty" in str(error):
            raise ModelNotFoundError(f"no fitted pipeline at {path}") from error
        raise
