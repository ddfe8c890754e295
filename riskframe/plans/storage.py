"""Stored intermediates.

A table that several later stages read is written once, as Parquet, to the
folder named by ``spark.checkpoint.dir``. The lineage ends there, a lost
executor only re-reads files, and later readers still prune columns.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
#: Bytes of a row group of a table whose readers shall be able to share its files.
ROW_GROUP = 16_000_000


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; in local mode a temporary one if unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="riskframe-")
    return _LOCAL_ROOTS[context.applicationId]


def session_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/riskframe/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{session_folder(spark)}/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str = "table", partition_by: Sequence[str] = (), row_group: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return a reader of the written table.

    The size of a stored table is known to the planner. Small fitted tables
    (cut points, ranges, fences) are therefore stored and joined without a hint:
    Spark broadcasts them below ``spark.sql.autoBroadcastJoinThreshold`` and
    joins by shuffle above it. With ``partition_by`` (columns of few values) readers
    that ask for one value read its files only. With ``row_group`` (bytes) a file has row groups of about
    that size: readers can only divide a file between them, so a table that is read many times by all cores needs small ones.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    writer = df.write.partitionBy(*partition_by)
    if row_group:  # rows may be large: look at the size after every one
        writer = writer.option("parquet.block.size", row_group).option("parquet.page.size.row.check.min", 1)
    writer.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def drop(*tables: DataFrame) -> None:
    """Delete tables that ``store`` has returned and that nothing reads any more; others are left alone."""
    for table in tables:
        if "stored_at" in vars(table):
            _delete(table.sparkSession, table.stored_at)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_stored(spark: SparkSession) -> None:
    """Delete every table this session has stored; DataFrames reading them become invalid."""
    _delete(spark, session_folder(spark))
