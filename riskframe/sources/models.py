"""Fitted preparations and models on disk (A3)."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from riskframe.operators.features import FittedFeatures


def save_model(spark: SparkSession, path: str, prepared: FittedFeatures, model) -> None:
    """Write preparation, model and slot names as one pipeline folder."""
    PipelineModel([*prepared.model.stages, model]).write().overwrite().save(f"{path}/pipeline")
    names = spark.createDataFrame([(json.dumps(prepared.names),)], "names string")
    names.write.mode("overwrite").json(f"{path}/names")


def load_model(spark: SparkSession, path: str) -> tuple[FittedFeatures, object]:
    """The preparation and the model, ready to score."""
    stages = PipelineModel.load(f"{path}/pipeline").stages
    names = json.loads(spark.read.schema("names string").json(f"{path}/names").first()["names"])
    return FittedFeatures(PipelineModel(stages[:-1]), names), stages[-1]
