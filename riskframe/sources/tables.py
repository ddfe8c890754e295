"""Parquet tables in one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Reader of one table; its footer is opened for the schema once per process."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)
