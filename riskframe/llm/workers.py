"""What Python tasks share: how they find this package and where they are."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import SparkSession

from riskframe.plans.workers import ready

__all__ = ["batch", "brief_shuffles", "ready", "release", "short_batches", "shuffle_width", "task_number"]


def task_number() -> int:
    """Number of the running partition; the same when the task is run again."""
    context = TaskContext.get()
    return context.partitionId() if context else 0


def shuffle_width(spark: SparkSession) -> int:
    """How many partitions a shuffle of this session has."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch of plain lists, numpy arrays or Arrow arrays, cast to the schema."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema)


def release() -> None:
    """Give memory that is no longer used back to the system: a worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


@contextlib.contextmanager
def short_batches(spark: SparkSession, rows: int = 1_000) -> Iterator[None]:
    """Within it, jobs send at most ``rows`` rows to Python at a time: long texts make large batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if int(before) > 0:
        rows = min(rows, int(before))
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextlib.contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, what a query has shuffled leaves the disks when the query ends, not when the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
