"""Global order without a single-task window.

``running_totals``  cumulative sums along a value, two-level when large.
``exact_quantiles`` linear-interpolated quantiles from value counts.
``rank_cutoffs``    the row holding a wanted rank in keyed-hash order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.plans.storage import store

ROWS_PER_TASK = 1_000_000
MAX_RANGES = 10_000
SKETCH_ACCURACY = 10_000
NARROW_ABOVE_BYTES = 256 * 1024 * 1024
_SHIFT = 16  # a 32-bit hash falls into 2 ** 16 cells


def running_totals(counts: DataFrame, by: Sequence[str], order: str, sums: Sequence[str],
                   rows_per_task: int = ROWS_PER_TASK, stored: bool = False) -> DataFrame:
    """Add ``<s>_upto`` (inclusive, ascending ``order``), ``<s>_prev`` and ``<s>_all`` per group.

    ``counts`` holds one row per (group, value), i.e. ties and hot values are
    already folded together. It is stored once (unless ``stored``) and counted.
    Up to ``rows_per_task`` rows an ordinary window does it. Beyond that,
    quantiles of the stored values cut the axis into ranges of about that many
    rows each; totals of the ranges give offsets, and windows run inside the
    ranges only. ``<s>_prev`` is the value in the row before, null in the first.
    """
    by = list(by)
    if not stored:
        counts = store(counts, "counts")
    n = counts.count()
    ahead = (Window.unboundedPreceding, Window.currentRow)
    if n <= rows_per_task:
        line = Window.partitionBy(*by).orderBy(order)
        run = line.rowsBetween(*ahead)
        whole = Window.partitionBy(*by)
        return counts.select("*", *[F.sum(s).over(run).alias(f"{s}_upto") for s in sums],
                             *[F.lag(s).over(line).alias(f"{s}_prev") for s in sums],
                             *[F.sum(s).over(whole).alias(f"{s}_all") for s in sums])

    ranges = min(MAX_RANGES, math.ceil(n / rows_per_task))
    axis = counts.withColumn("_axis", F.col(order).cast("double"))
    cuts = axis.approxQuantile("_axis", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges))
    splits = [-math.inf, *sorted({c for c in cuts if math.isfinite(c)}), math.inf]
    if len(splits) == 2:
        splits.insert(1, 0.0)
    ranged = Bucketizer(splits=splits, inputCol="_axis", outputCol="_range").transform(axis).drop("_axis")
    totals = ranged.groupBy(*by, "_range").agg(
        *[F.sum(s).alias(f"_{s}") for s in sums],
        F.max_by(F.struct(*sums), order).alias("_last"))
    ranges_line = Window.partitionBy(*by).orderBy("_range")
    before = ranges_line.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = totals.select(
        *by, "_range", F.lag("_last").over(ranges_line).alias("_last"),
        *[F.coalesce(F.sum(f"_{s}").over(before), F.lit(0)).alias(f"_{s}_off") for s in sums],
        *[F.sum(f"_{s}").over(whole).alias(f"{s}_all") for s in sums])
    line = Window.partitionBy(*by, "_range").orderBy(order)
    inside = line.rowsBetween(*ahead)
    return (ranged.join(offsets, [*by, "_range"])
            .select(*counts.columns,
                    *[(F.sum(s).over(inside) + F.col(f"_{s}_off")).alias(f"{s}_upto") for s in sums],
                    *[F.coalesce(F.lag(s).over(line), F.col(f"_last.{s}")).alias(f"{s}_prev")
                      for s in sums],
                    *[f"{s}_all" for s in sums]))


def planned_bytes(df: DataFrame) -> int:
    """The planner's size estimate; no job runs. Only ever used to choose between equal results."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float],
                    rows_per_task: int = ROWS_PER_TASK, narrow_above_bytes: int = NARROW_ABOVE_BYTES,
                    narrow_above_rows: int = ROWS_PER_TASK) -> DataFrame:
    """Exact linear-interpolated quantiles per group: (by..., n, one column per entry of ``probs``).

    Small inputs are folded to counts of distinct values. Above
    ``narrow_above_bytes`` groups of more than ``narrow_above_rows`` rows are
    narrowed first: a rank sketch with error 1e-4 gives, per quantile, an
    interval sure to hold the wanted ranks. The second pass then counts the rows
    below it and the distinct values inside it, about 4e-4 of the group.
    """
    by = list(by)
    if not by:
        raise ValueError("group by at least one column, such as the name of the measured one")
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).filter(
        F.col("_v").isNotNull() & ~F.isnan("_v"))
    narrowed = planned_bytes(df) > narrow_above_bytes
    if narrowed:
        counts = _narrowed_counts(rows, by, probs, narrow_above_rows)
    else:
        counts = rows.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n")).withColumn("_q", F.lit(_EVERY))
    runs = running_totals(counts, [*by, "_q"], "_v", ["_n"], rows_per_task)

    def at(name: str, rank: Column) -> Column:
        serves = F.col("_q").isin(name, _EVERY)
        holds = (F.col("_n_upto") > rank) & (F.col("_n_upto") - F.col("_n") <= rank)
        return F.max(F.when(serves & holds, F.col("_v")))

    found = []
    for name, q in probs.items():
        spot = _spot(F.col("n"), q)
        found += [at(name, F.floor(spot)).alias(f"_lo_{name}"), at(name, F.ceil(spot)).alias(f"_hi_{name}")]
    if "n" not in runs.columns:
        runs = runs.withColumn("n", F.col("_n_all"))
    ends = runs.groupBy(*by, "n").agg(*found)
    if narrowed:
        ends = store(ends, "ranks")
        missed = F.lit(False)
        for c in ends.columns[len(by) + 1:]:
            missed = missed | F.col(c).isNull() | (F.col(c) == -math.inf)
        if not ends.filter(missed).isEmpty():  # an interval missed its rank: keep all values instead
            return exact_quantiles(df, by, value, probs, rows_per_task, narrow_above_bytes=planned_bytes(df))
    return ends.select(*by, "n", *[
        (F.col(f"_lo_{name}") + (_spot(F.col("n"), q) - F.floor(_spot(F.col("n"), q)))
         * (F.col(f"_hi_{name}") - F.col(f"_lo_{name}"))).alias(name) for name, q in probs.items()])


_EVERY = "*"  # marks counts that hold all values of a group and so serve every quantile


def _spot(n: Column, q: float) -> Column:
    return (n - 1) * F.lit(float(q))


def _narrowed_counts(rows: DataFrame, by: list[str], probs: dict[str, float], above: int) -> DataFrame:
    """(by..., n, _q, _v, _n): value counts inside the interval of each quantile, rows below at -infinity."""
    slack = 2 / SKETCH_ACCURACY
    edges = [p for q in probs.values() for p in (max(0.0, q - slack), min(1.0, q + slack))]
    sketch = F.percentile_approx("_v", F.array(*[F.lit(p) for p in edges]), F.lit(SKETCH_ACCURACY))
    whole = F.array(F.struct(F.lit(_EVERY).alias("q"), F.lit(-math.inf).alias("low"), F.lit(math.inf).alias("high")))
    parts = F.array(*[F.struct(F.lit(name).alias("q"), F.get("_edges", F.lit(2 * i)).alias("low"),
                               F.get("_edges", F.lit(2 * i + 1)).alias("high"))
                      for i, name in enumerate(probs)])
    brackets = store(
        rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), sketch.alias("_edges"))
        .select(*by, "n", F.when(F.col("n") > above, parts).otherwise(whole).alias("_brackets")), "brackets")
    v = F.col("_v")
    return (rows.join(brackets, by).withColumn("_b", F.explode(F.filter("_brackets", lambda b: v <= b["high"])))
            .select(*by, "n", F.col("_b.q").alias("_q"),
                    F.when(v >= F.col("_b.low"), v).otherwise(F.lit(-math.inf)).alias("_v"))
            .groupBy(*by, "n", "_q", "_v").agg(F.count(F.lit(1)).alias("_n")))


def join_null_safe(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``by``, where a null key equals a null key; the columns of ``by`` are the left ones."""
    names = {c: f"_by{i}" for i, c in enumerate(by)}
    other = right.withColumnsRenamed(names)
    return left.join(other, [left[c].eqNullSafe(other[n]) for c, n in names.items()], how).drop(*names.values())


def class_sizes(df: DataFrame, by: Sequence[str], hash_col: str) -> tuple[DataFrame, DataFrame]:
    """(hash cells per class, rows per class). A null class is a class; there may be any number of them."""
    by = list(by)
    cells = store(df.groupBy(*by, F.shiftright(hash_col, _SHIFT).alias("_cell")).agg(
        F.count(F.lit(1)).alias("_n")), "cells")
    return cells, cells.groupBy(*by).agg(F.sum("_n").alias("n_class"))


def rank_cutoffs(df: DataFrame, by: Sequence[str], hash_col: str, key: str,
                 cells: DataFrame, wants: DataFrame) -> DataFrame:
    """For each row (by..., cut, want) of ``wants``: hash and key of the want-th row.

    The data is counted into 2**16 hash cells per class; only the one cell in
    which a cut falls is ranked, so no sort ever sees more than 1/65536 of a
    class. The cells that hold a cut are stored, so the planner knows their size:
    it broadcasts them if they are few, and joins by shuffle if classes are many.
    Callers store the cut points, so they are looked up once.
    """
    by = list(by)
    run = Window.partitionBy(*by).orderBy("_cell").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumn("_upto", F.sum("_n").over(run))
    edges = store(join_null_safe(cells, wants, by)
                  .filter((F.col("want") <= F.col("_upto"))
                          & (F.col("want") > F.col("_upto") - F.col("_n")))
                  .select(*by, "_cell", "cut", (F.col("want") - F.col("_upto") + F.col("_n")).alias("_need")), "edges")
    inside = join_null_safe(df.select(*by, hash_col, key).withColumn("_cell", F.shiftright(hash_col, _SHIFT)),
                            edges, [*by, "_cell"])
    rank = F.row_number().over(Window.partitionBy(*by, "cut").orderBy(hash_col, key))
    return (inside.withColumn("_rank", rank).filter(F.col("_rank") == F.col("_need"))
            .select(*by, "cut", F.col(hash_col).alias("cut_hash"), F.col(key).alias("cut_key")))


def at_or_before(hash_col: Column, key: Column, cut_hash: Column, cut_key: Column) -> Column:
    """(hash, key) <= (cut_hash, cut_key) in lexicographic order."""
    return (hash_col < cut_hash) | ((hash_col == cut_hash) & (key <= cut_key))
