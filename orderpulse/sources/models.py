"""Fitted model folders: save, and load the first one that exists."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel



def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(paths: Sequence[str]) -> PipelineModel:
    """Try the paths in order; say which were tried when none holds a model."""
    for path in paths:
        try:
            return PipelineModel.load(path)
        except (Py4JJavaError, PySparkException, ValueError) as err:
            if not _missing(err):
                raise
    raise FileNotFoundError(f"no fitted model under any of {list(paths)}")


def _missing(err: Exception) -> bool:
    text = str(err)
    return any(
        hint in text
        for hint in ("does not exist", "PATH_NOT_FOUND", "Input path", "empty collection", "FileNotFound")
    )


def pick_model(models: dict[str, str], name: str) -> PipelineModel:
    """Load one model of a name -> path listing, naming the choices on a miss."""
    if name not in models:
        raise KeyError(f"model {name!r} not found; available: {sorted(models)}")
    return load_model([models[name]])


