"""Distributed connected components by alternating large and small stars.

Edges are shrunk inside the tasks first (each writes a forest of its own), then every node and its larger neighbours
are tied to the smallest neighbour (large star), and every node and its smaller ones likewise (small star), until
nothing changes. All state is a table in the shared folder; nothing but two numbers a round reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskframe.llm.workers import ready
from riskframe.plans.storage import drop, store

_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its tree) for all nodes of the edges but the smallest ones."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    root = np.arange(len(nodes))
    while True:  # hook larger roots under smaller ones, then jump
        rx, ry = root[x], root[y]
        apart = rx != ry
        if not apart.any():
            break
        x, y, rx, ry = x[apart], y[apart], rx[apart], ry[apart]
        np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further
    below = root != np.arange(len(nodes))
    return nodes[below], nodes[root[below]]


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A forest of the partition's edges, folded as they come; memory follows its distinct nodes."""
    a = b = np.empty(0, np.int64)
    for rows in batches:
        a = np.concatenate([a, rows.column(0).to_numpy(zero_copy_only=False)])
        b = np.concatenate([b, rows.column(1).to_numpy(zero_copy_only=False)])
        if len(a) > 1_000_000:
            a, b = forest(a, b)
    a, b = forest(a, b)
    for start in range(0, len(a), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(a[start:start + 100_000]), pa.array(b[start:start + 100_000])],
                                         schema=_EDGE)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.join(least, "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that an edge names; ``component`` is the smallest node it can reach.

    Nodes are whole numbers. Edges may be repeated, in either direction or from a node to itself; edges with a null end
    are left out; no edges give no rows. Rounds are few (the logarithm of the longest path).
    """
    ready(edges.sparkSession)
    ends = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).dropna()
    loops = ends.filter("a = b").select("a").distinct()
    now = store(ends.filter("a <> b").mapInArrow(_local_forest, "a long, b long"), "forest")
    before = None
    while (state := _state(now)) != before:
        before = state
        if not state[0]:
            break
        last, now = now, store(_small_star(_large_star(now)), "stars")
        drop(last)
    tied = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    alone = loops.select(F.col("a").alias("node")).withColumn("component", F.col("node"))
    return tied.union(roots).union(alone).groupBy("node").agg(F.min("component").alias("component"))
