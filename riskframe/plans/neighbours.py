"""Exact nearest neighbours as a pruned block join.

Of pool rows with equal vectors only those with the smallest keys can be among the k nearest of anything; the others leave
the pool first. The rest goes to the leaves of a k-d tree, large leaves are dealt into blocks. A query first searches its
own leaf; the distance of its k-th find then rules out every branch whose box of rows is farther away, and only the
remaining leaves are searched. A group holds a share of the queries that visit one block, and that block; it emits the k
best per query, never pairs. The answer does not depend on leaves, blocks or shares.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.plans.storage import store
from riskframe.plans.workers import ready

_EPSILON = np.finfo(np.float64).eps


#: Rows a leaf that place the cuts of the tree; they bear on the time only.
_DRAWN = 16
#: Queries of one group, about.
_SHARE = 20_000


@dataclass
class _Tree:
    """A k-d tree: rows with ``x[dim] <= cut`` go left; ``leaf`` numbers the leaves, -1 elsewhere."""

    dim: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaf: np.ndarray

    @classmethod
    def grow(cls, rows: np.ndarray, leaves: int) -> _Tree:
        """Cut the largest part along its widest slot, near its middle, until there are ``leaves`` or no part can be cut."""
        dim, cut, left, right, leaf = [0], [0.0], [-1], [-1], [-1]
        open_ = [(np.arange(len(rows)), 0)]
        done = []
        while open_ and len(open_) + len(done) < leaves:
            at = max(range(len(open_)), key=lambda i: len(open_[i][0]))
            own, node = open_.pop(at)
            part = rows[own]
            slot = int(np.argmax(part.std(axis=0))) if len(own) > 1 else 0
            values = np.unique(part[:, slot]) if len(own) > 1 else np.empty(0)
            if len(values) < 2:
                done.append(node)
                continue
            middle = min(int(np.searchsorted(values, np.median(part[:, slot]))), len(values) - 2)
            if middle > 0 and abs((part[:, slot] <= values[middle - 1]).mean() - 0.5) < abs((part[:, slot] <= values[middle]).mean() - 0.5):
                middle -= 1
            dim[node], cut[node] = slot, float(values[middle])
            below = part[:, slot] <= values[middle]
            for side, some in ((left, own[below]), (right, own[~below])):
                side[node] = len(dim)
                open_.append((some, len(dim)))
                for array, empty in ((dim, 0), (cut, 0.0), (left, -1), (right, -1), (leaf, -1)):
                    array.append(empty)
        for i, node in enumerate(sorted([*done, *(n for _, n in open_)])):
            leaf[node] = i
        return cls(*map(np.array, (dim, cut, left, right, leaf)))

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def settle(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        node = np.zeros(len(x), np.int64)
        moving = np.flatnonzero(self.leaf[node] < 0)
        while len(moving):
            here = node[moving]
            below = x[moving, self.dim[here]] <= self.cut[here]
            node[moving] = np.where(below, self.left[here], self.right[here])
            moving = moving[self.leaf[node[moving]] < 0]
        return self.leaf[node]

    def boxes(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Boxes of all nodes from those of the leaves (infinitely far where there are no rows)."""
        lows, highs = np.empty((len(self.dim), low.shape[1])), np.empty((len(self.dim), low.shape[1]))
        for node in range(len(self.dim) - 1, -1, -1):  # children come after their parent
            if self.leaf[node] >= 0:
                lows[node], highs[node] = low[self.leaf[node]], high[self.leaf[node]]
            else:
                a, b = self.left[node], self.right[node]
                lows[node], highs[node] = np.fmin(lows[a], lows[b]), np.fmax(highs[a], highs[b])
        return lows, highs

    def within(self, x: np.ndarray, limit: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of all leaves whose box is no farther from the row than its limit."""
        row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(row):
            gap = np.nan_to_num(np.fmax(np.fmax(lows[node] - x[row], x[row] - highs[node]), 0.0), nan=0.0, posinf=np.inf)
            near = np.sqrt((gap * gap).sum(axis=1)) * (1.0 - 1e-9) <= limit[row]
            row, node = row[near], node[near]
            end = self.leaf[node] >= 0
            found.append((row[end], self.leaf[node[end]]))
            row, node = row[~end], node[~end]
            row, node = np.concatenate([row, row]), np.concatenate([self.left[node], self.right[node]])
        return np.concatenate([r for r, _ in found]), np.concatenate([c for _, c in found])


def _worth_keeping(pool: DataFrame, k: int) -> DataFrame:
    """Without the rows that k others with the same vector and smaller keys stand before, whichever key is left out."""
    once = pool.groupBy("v", "id").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("times"))
    place = F.row_number().over(Window.partitionBy("v").orderBy(F.col("id").asc_nulls_last()))
    return (once.withColumn("place", place).filter(F.col("place") <= k + 1)
            .select("id", "v", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("_copy")).drop("_copy"))


def nearest_neighbours(queries: DataFrame, pool: DataFrame, key: str, vector: str, k: int,
                       block_rows: int = 1_024, cells: int = 4_096) -> DataFrame:
    """(base_id, rank, neighbour_id, distance): the k nearest pool rows of each query.

    A row is not its own neighbour. Ties go to the smaller key. Rows without a vector take no part.
    """
    def plain(df: DataFrame) -> DataFrame:
        return df.select(F.col(key).alias("id"), F.col(vector).alias("v")).filter("v is not null")

    ready(pool.sparkSession)
    pool, queries = store(_worth_keeping(plain(pool), k), "pool"), store(plain(queries), "queries")
    n, id_type = pool.count(), dict(pool.dtypes)["id"]
    if not n:
        return queries.select(F.col("id").alias("base_id"), F.lit(1).alias("rank"), F.col("id").alias("neighbour_id"),
                              F.lit(0.0).alias("distance")).filter("false")
    leaves = min(cells, math.ceil(n / block_rows))
    drawn = _DRAWN * leaves  # bounded by the arguments
    some = pool if n <= drawn else pool.filter(F.pmod(F.xxhash64("id", "v"), F.lit(n)) < drawn)
    sample = [r["v"] for r in some.select("v").limit(2 * drawn).collect()]
    tree = _Tree.grow(np.nan_to_num(np.array(sample or [pool.first()["v"]], dtype=np.float64)), leaves)

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                yield rows.assign(cell=tree.settle(np.vstack(rows["v"].to_numpy()).astype(np.float64)))

    kind = f"id {id_type}, v array<double>, cell int"
    settled = store(pool.mapInPandas(settle, kind), "cells")
    asking = store(queries.mapInPandas(settle, kind), "cells")

    def span(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
        for rows in batches:
            for cell, part in rows.groupby("cell"):
                v = np.vstack(part["v"].to_numpy()).astype(np.float64)
                low, high, m = np.fmin.reduce(v), np.fmax.reduce(v), len(v)
                if cell in own:
                    low, high, m = np.fmin(low, own[cell][0]), np.fmax(high, own[cell][1]), m + own[cell][2]
                own[cell] = low, high, m
        yield pd.DataFrame([(c, list(low), list(high), m) for c, (low, high, m) in own.items()], columns=["cell", "low", "high", "n"])

    def merge(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(parts["cell"].iloc[0], list(np.fmin.reduce(np.vstack(parts["low"].to_numpy()))),
                              list(np.fmax.reduce(np.vstack(parts["high"].to_numpy()))), parts["n"].sum())],
                            columns=["cell", "low", "high", "n"])

    box = "cell int, low array<double>, high array<double>, n long"
    size = len(sample[0]) if sample else len(pool.first()["v"])
    low, high, blocks = np.full((tree.leaves, size), np.inf), np.full((tree.leaves, size), -np.inf), [0] * tree.leaves
    for row in settled.select("cell", "v").mapInPandas(span, box).groupBy("cell").applyInPandas(merge, box).collect():
        low[row["cell"]], high[row["cell"]], blocks[row["cell"]] = row["low"], row["high"], math.ceil(row["n"] / block_rows)
    lows, highs = tree.boxes(low, high)
    per_cell = _by_cell(settled.sparkSession, list(enumerate(blocks)), "blocks")

    def dealt(rows: DataFrame, salt: str, count: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "id", "v"), F.greatest(F.col(count), F.lit(1))).cast("int")

    held = settled.join(F.broadcast(per_cell), "cell")
    held = held.select("id", "v", "cell", dealt(held, "block", "blocks").alias("block"))

    def search(visits: DataFrame) -> DataFrame:
        """The k best of every visited block, and of these the k best per query; large crowds of queries are dealt out."""
        shares = _by_cell(visits.sparkSession, [(r["cell"], math.ceil(r["count"] / _SHARE)) for r in visits.groupBy("cell").count().collect()], "shares")
        each = visits.join(F.broadcast(shares), "cell").join(F.broadcast(per_cell), "cell")
        each = (each.withColumn("share", dealt(each, "share", "shares")).filter("blocks > 0")
                .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks", "shares"))
        copies = (held.join(F.broadcast(shares), "cell").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
                  .groupBy("cell", "block", "share"))
        found = (each.groupBy("cell", "block", "share").cogroup(copies)
                 .applyInPandas(lambda q, p: _best_of_block(q, p, k),
                                f"base_id {id_type}, neighbour_id {id_type}, distance double"))
        return _best(found, k)

    own = store(search(asking.withColumn("bound", F.lit(None).cast("double"))), "near")
    bound = own.groupBy(F.col("base_id").alias("id")).agg(
        F.when(F.count(F.lit(1)) == k, F.max("distance")).alias("bound"))

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for start in range(0, len(rows), 128):
                part = rows.iloc[start:start + 128]
                limit = part["bound"].to_numpy(dtype=np.float64)
                row, cell = tree.within(np.vstack(part["v"].to_numpy()).astype(np.float64), np.where(np.isnan(limit), np.inf, limit),
                                        lows, highs)
                other = cell != part["cell"].to_numpy()[row]
                row, cell = row[other], cell[other]
                if len(row):
                    yield pd.DataFrame({"id": part["id"].to_numpy()[row], "v": part["v"].to_numpy()[row], "cell": cell, "bound": limit[row]})

    further = store(asking.join(bound, "id", "left").select("id", "v", "cell", "bound").mapInPandas(visit, f"{kind}, bound double"), "visits")
    return _best(own.select("base_id", "neighbour_id", "distance").union(
        search(further).select("base_id", "neighbour_id", "distance")), k)


def _by_cell(spark, rows: list[tuple[int, int]], name: str) -> DataFrame:
    """A small table: a number a leaf."""
    return spark.createDataFrame(rows, f"cell int, {name} int")


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("base_id").orderBy("distance", "neighbour_id"))
    return (found.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("base_id", "rank", "neighbour_id", "distance"))


def _best_of_block(q: pd.DataFrame, p: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest rows of a block for every query, by (distance, key).

    A product of centred vectors gives distances to rounding; every row that could be among the k nearest within that
    error, ties included, is then measured by exact differences. What lies beyond a query's bound is left out.
    """
    found: list[tuple] = []
    if len(q) and len(p):
        qv, pv = np.vstack(q["v"].to_numpy()).astype(np.float64), np.vstack(p["v"].to_numpy()).astype(np.float64)
        q_ids, p_ids = q["id"].to_numpy(), p["id"].to_numpy()
        far = q["bound"].to_numpy(dtype=np.float64)
        far = np.where(np.isnan(far), np.inf, far)
        middle = pv.mean(axis=0)
        pc = pv - middle
        p_norm = (pc * pc).sum(axis=1)
        for start in range(0, len(q), 256):
            part, ids = qv[start:start + 256], q_ids[start:start + 256]
            qc = part - middle
            q_norm = (qc * qc).sum(axis=1)
            fast = q_norm[:, None] + p_norm[None, :] - 2.0 * qc @ pc.T
            slack = 8 * _EPSILON * (pv.shape[1] + 4) * (q_norm + p_norm.max())
            # Differences to the middle are rounded too, relative to the original values.
            slack += 8 * _EPSILON * np.abs(pv).max() * (np.sqrt(q_norm) + math.sqrt(p_norm.max())) * pv.shape[1]
            keep = min(len(p), k + 1)  # one more, as the query itself may be among them
            edge = np.partition(fast, keep - 1, axis=1)[:, keep - 1]
            reach = far[start:start + 256]
            with np.errstate(invalid="ignore"):
                hopeless = fast.min(axis=1) > reach * reach * (1.0 + 1e-9) + 2 * slack
            for row, base in enumerate(ids):
                if hopeless[row]:
                    continue
                near = np.flatnonzero(fast[row] <= edge[row] + 2 * slack[row])
                near = near[p_ids[near] != base]
                if len(near) < min(k, len(p)):  # several rows bear the query's key
                    near = np.flatnonzero(p_ids != base)
                exact = np.sqrt(((pv[near] - part[row]) ** 2).sum(axis=1))
                if reach[row] < np.inf:
                    near, exact = near[exact <= reach[row]], exact[exact <= reach[row]]
                order = np.lexsort((p_ids[near], exact))[:k]
                found += [(base, p_ids[near[i]], float(exact[i])) for i in order]
    return pd.DataFrame(found, columns=["base_id", "neighbour_id", "distance"])
