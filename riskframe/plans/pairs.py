"""Sums over all pairs of columns in one pass.

Each task folds its rows into small matrices (counts, sums, products and ranges over the rows where both columns of a
pair are present) and emits one row per pair; the pairs' rows are then added. No row of the data is multiplied.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from riskframe.functions.names import named
from riskframe.plans.workers import ready

_SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, j, n, mean_x, mean_y, sxx, syy, sxy, flat) for i <= j: centred sums over the rows where both are present.

    ``flat``: one of the two has a single value there. Values are shifted by the column's mean before they are squared.
    """
    ready(df.sparkSession)
    values = df.select(*[named(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    means = values.agg(*[F.avg(F.when(~F.isnan(v), F.col(v))).alias(v) for v in values.columns]).first()
    shift = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in means])
    k = len(columns)
    upper = np.triu_indices(k)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {s: np.zeros((k, k)) for s in _SUMS}
        low, high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        for rows in batches:
            for at in range(0, len(rows), 20_000):
                x = rows.iloc[at:at + 20_000].to_numpy(dtype=np.float64)
                there = ~np.isnan(x)
                y, m = np.where(there, x - shift, 0.0), there.astype(np.float64)
                sums["n"] += m.T @ m
                sums["sx"] += y.T @ m
                sums["sy"] += m.T @ y
                sums["sxx"] += (y * y).T @ m
                sums["syy"] += m.T @ (y * y)
                sums["sxy"] += y.T @ y
                for j in range(k):
                    if there[:, j].any():
                        seen = x[there[:, j]]
                        low[:, j] = np.fmin(low[:, j], np.fmin.reduce(seen, axis=0, initial=np.inf))
                        high[:, j] = np.fmax(high[:, j], np.fmax.reduce(seen, axis=0, initial=-np.inf))
        yield pd.DataFrame({"i": upper[0], "j": upper[1], **{s: v[upper] for s, v in sums.items()},
                            "lx": low[upper], "hx": high[upper], "ly": low.T[upper], "hy": high.T[upper]})

    kind = "i int, j int, " + ", ".join(f"{s} double" for s in [*_SUMS, "lx", "hx", "ly", "hy"])
    total = values.mapInPandas(fold, kind).groupBy("i", "j").agg(
        *[F.sum(s).alias(s) for s in _SUMS], *[F.min(s).alias(s) for s in ("lx", "ly")], *[F.max(s).alias(s) for s in ("hx", "hy")])

    def centred(product: str, a: str, b: str):
        return F.col(product) - F.try_divide(F.col(a) * F.col(b), F.col("n"))
    return total.select("i", "j", F.col("n").cast("long").alias("n"), centred("sxx", "sx", "sx").alias("sxx"),
                        centred("syy", "sy", "sy").alias("syy"), centred("sxy", "sx", "sy").alias("sxy"),
                        ((F.col("lx") >= F.col("hx")) | (F.col("ly") >= F.col("hy"))).alias("flat"))
