"""How Python tasks find this package."""

from __future__ import annotations

import contextlib
import os
from collections.abc import Iterator

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> SparkSession:
    """Let the workers of a local session import the package from the driver's checkout.

    On a cluster the package is shipped with the job (``--py-files`` or an installed wheel); nothing is set there.
    """
    context = spark.sparkContext
    if context.master.startswith("local[") or context.master == "local":
        paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
        if _ROOT not in paths:
            context.environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
    return spark


@contextlib.contextmanager
def light_batches(spark: SparkSession, size: int = 8_000_000) -> Iterator[None]:
    """Within it, jobs send about ``size`` bytes to Python at a time, or one row: every task holds a batch several times over."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, f"{size}b")
    try:
        yield
    finally:
        spark.conf.set(name, before)
