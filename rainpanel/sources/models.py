"""Saving and loading fitted models."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

# Folder of each model kind under the model directory.
MODEL_FOLDERS = {"gbt": "gbt_model", "rf": "rf_model"}


def model_path(kind: str, directory: str) -> str:
    folder = MODEL_FOLDERS.get(kind.lower())
    if folder is None:
        raise ValueError(f"unknown model kind: {kind}")
    return f"{directory.rstrip('/')}/{folder}"


def save_model(model: PipelineModel, kind: str, directory: str) -> str:
    """Save features and model together, replacing an older one; returns the path."""
    path = model_path(kind, directory)
    model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, kind: str, directory: str) -> PipelineModel:
    """Load a saved model; ``ValueError`` for an unknown kind, ``FileNotFoundError`` when absent."""
    path = model_path(kind, directory)
    try:
        spark.read.text(f"{path}/metadata")
    except AnalysisException as error:
        raise FileNotFoundError(f"no saved model at {path}") from error
    return PipelineModel.load(path)


def save_coefficients(coefficients: DataFrame, path: str) -> None:
    """Fitted coefficients, one row per region, in region order so a lookup skips row groups."""
    ordered = coefficients.repartitionByRange("region").sortWithinPartitions("region")
    ordered.write.mode("overwrite").parquet(path)


def load_coefficients(spark: SparkSession, path: str, region: str | None = None) -> DataFrame:
    coefficients = spark.read.parquet(path)
    return coefficients if region is None else coefficients.filter(F.col("region") == region)
