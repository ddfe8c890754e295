"""Distribution and association tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.functions.bands import equal_width_bin
from riskframe.functions.names import named
from riskframe.plans.ordered import exact_quantiles
from riskframe.plans.pairs import pair_moments
from riskframe.plans.storage import store


def numeric_long(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value double), missing cells left out."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), named(c).cast("double").alias("value"))
                      for c in columns])
    return df.select(*by, F.inline(cells)).filter(F.col("value").isNotNull() & ~F.isnan("value"))


def numeric_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows per (column, by..., value): the stored base of quantiles, box statistics and densities."""
    return store(numeric_long(df, columns, by).groupBy("column", *by, "value")
                 .agg(F.count(F.lit(1)).alias("n")), "values")


def category_frequencies(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Count and percent per category of each column, most frequent first."""
    from riskframe.operators.quality import value_counts

    counts = store(value_counts(df, columns), "categories")
    totals = counts.groupBy("column").agg(F.sum("n").alias("_all"))  # a row per listed column
    return (counts.join(F.broadcast(totals), "column")
            .select("column", "value", "n", F.round(F.col("n") * 100.0 / F.col("_all"), digits).alias("pct"))
            .orderBy("column", F.col("n").desc(), "value"))


def category_by_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Rows per category and class."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), named(c).cast("string").alias("value"))
                      for c in columns])
    return (df.select(named(target).alias("_t"), F.inline(cells)).filter(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count_if(F.col("_t") == 0).alias("n_neg"),
                                            F.count_if(F.col("_t") == 1).alias("n_pos")))


def box_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: float = 1.5,
              digits: int | None = 6) -> DataFrame:
    """Quartiles, fences, whiskers (extreme data inside the fences), outlier count.

    Three column-pruned passes with small aggregates; no pass shuffles the rows.
    """
    keys = ["column", *by]
    long = numeric_long(df, columns, by)
    quarts = exact_quantiles(long, keys, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    spread = F.col("q3") - F.col("q1")
    fences = store(quarts.withColumn("fence_low", F.col("q1") - k * spread)
                   .withColumn("fence_high", F.col("q3") + k * spread), "fences")
    value = F.col("value")
    inside = (value >= F.col("fence_low")) & (value <= F.col("fence_high"))
    names = ["q1", "median", "q3", "fence_low", "fence_high"]
    stats = long.join(fences, keys).groupBy(*keys, "n", *names).agg(
        F.min(F.when(inside, value)).alias("whisker_low"), F.max(F.when(inside, value)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))
    shown = [*names, "whisker_low", "whisker_high"]
    return stats.select(*keys, "n", *[F.col(c) if digits is None else F.round(c, digits).alias(c)
                                      for c in shown], "outliers")


def value_ranges(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored (keys..., _lo, _hi, _all) of (keys..., value) rows."""
    return store(long.groupBy(*keys).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"),
                                         F.count(F.lit(1)).alias("_all")), "ranges")


def histogram(df: DataFrame, columns: Sequence[str], bins: int, by: Sequence[str] = (),
              digits: int = 9) -> DataFrame:
    """Equal-width bins over each group's own [min, max], last bin closed (C4).

    ``density`` is n / (N * width). Empty bins are left out. ``df`` is read
    twice: for the ranges, then for the bins.
    """
    keys = ["column", *by]
    long = numeric_long(df, columns, by)
    lo, hi = F.col("_lo"), F.col("_hi")
    width = (hi - lo) / F.lit(float(bins))
    return (long.join(value_ranges(long, keys), keys)
            .groupBy(*keys, equal_width_bin(F.col("value"), lo, hi, bins).alias("bin"), "_lo", "_hi", "_all")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(*keys, "bin", F.round(lo + F.col("bin") * width, 6).alias("bin_low"), "n",
                    F.round(F.try_divide(F.col("n").cast("double"), F.col("_all") * width),
                            digits).alias("density")))


def kernel_density(df: DataFrame, columns: Sequence[str], by: Sequence[str], points: int = 300,
                   pad: float = 0.04, factor: float = 0.35, few_factor: float = 0.65, few: int = 10,
                   digits: int = 9) -> DataFrame:
    """Gaussian density per group on an evenly spaced grid over the column's padded range.

    Bandwidth = factor * sample standard deviation of the group; the wider
    factor applies to columns with at most ``few`` distinct values. Values are
    folded into counts; every task adds up one array of grid points per group.
    """
    keys = ["column", *by]
    counts = numeric_counts(df, columns, by)
    overall = (counts.groupBy("column", "value").agg(F.sum("n").alias("n"))
               .groupBy("column").agg(F.min("value").alias("_min"), F.max("value").alias("_max"),
                                      F.count(F.lit(1)).alias("_distinct")))
    pads = (F.col("_max") - F.col("_min")) * pad
    overall = overall.select(
        "column", (F.col("_min") - pads).alias("_start"),
        ((F.col("_max") - F.col("_min") + 2 * pads) / F.lit(float(points - 1))).alias("_step"),
        F.when(F.col("_distinct") <= few, few_factor).otherwise(factor).alias("_factor"))
    n, v = F.col("n"), F.col("value")
    centre = counts.groupBy(*keys).agg(F.sum("n").alias("_all"), (F.sum(n * v) / F.sum(n)).alias("_mean"))
    spread = (counts.join(centre, keys).groupBy(*keys, "_all")
              .agg(F.sum(n * F.pow(v - F.col("_mean"), F.lit(2.0))).alias("_ss")))
    bands = (spread.join(F.broadcast(overall), "column")  # a row per listed column
             .withColumn("_h", F.sqrt(F.try_divide(F.col("_ss"), F.col("_all") - 1)) * F.col("_factor"))
             .filter("_h > 0").drop("_ss", "_factor"))
    names, shapes = [*keys, "_all"], dict(counts.dtypes)

    def curves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One array of sums per group and task."""
        sums: dict[tuple, np.ndarray] = {}
        for rows in batches:
            for key, own in rows.groupby(names + ["_start", "_step", "_h"], dropna=False, sort=False):
                start, step, h = key[-3:]
                x = start + np.arange(points) * step
                held = sums.setdefault(key, np.zeros(points))
                values, weights = own["value"].to_numpy(), own["n"].to_numpy()
                for at in range(0, len(values), 4_096):
                    u = (x[:, None] - values[None, at:at + 4_096]) / h
                    held += np.exp(-0.5 * u * u) @ weights[at:at + 4_096]
        yield pd.DataFrame([(*key, held) for key, held in sums.items()], columns=[*names, "_start", "_step", "_h", "_sums"])

    kind = ", ".join([*[f"`{k}` {shapes[k]}" for k in keys], "_all long", "_start double", "_step double", "_h double",
                      "_sums array<double>"])
    made = (counts.join(bands, keys).select(*names, "_start", "_step", "_h", "value", "n").mapInPandas(curves, kind)
            .select(*names, "_start", "_step", "_h", F.posexplode("_sums").alias("point", "_term")))
    x = F.col("_start") + F.col("point") * F.col("_step")
    return (made.groupBy(*keys, "point", "_start", "_step", "_h", "_all").agg(F.sum("_term").alias("_sum"))
            .select(*keys, "point", F.round(x, 6).alias("x"),
                    F.round(F.col("_sum") / (F.col("_all") * F.col("_h") * F.sqrt(F.lit(2.0) * F.pi())),
                            digits).alias("density")))


def mean_by_class(df: DataFrame, columns: Sequence[str], target: str, classes: Sequence = (0, 1),
                  digits: int = 6) -> DataFrame:
    """Mean of each column per class, columns as rows."""
    means = df.agg(*[F.avg(F.when(named(target) == k, named(c))).alias(f"m{i}_{j}")
                     for i, c in enumerate(columns) for j, k in enumerate(classes)])
    return means.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 *[F.round(F.col(f"m{i}_{j}"), digits).alias(f"class_{k}") for j, k in enumerate(classes)])
        for i, c in enumerate(columns)])))


def encode_for_correlation(df: DataFrame, numeric: Sequence[str], ordinal: Mapping[str, Sequence[str]],
                           binary: Mapping[str, Sequence[str]], one_hot: Mapping[str, Sequence[str]],
                           keep: Sequence[str] = ()) -> DataFrame:
    """Numeric view of mixed columns (C7): ordered labels -> 1.., two-valued -> 0/1 by sorted value,
    other categories one column per value but the first."""
    out = [named(c).cast("double").alias(c) for c in [*keep, *numeric]]
    for c, labels in ordinal.items():
        place = F.create_map(*[F.lit(x) for i, label in enumerate(labels, 1) for x in (label, float(i))])
        out.append(F.try_element_at(place, named(c)).alias(c))
    for c, pair in binary.items():
        low, high = sorted(pair)
        out.append(F.when(named(c) == high, 1.0).when(named(c) == low, 0.0).alias(c))
    for c, values in one_hot.items():
        for value in sorted(values)[1:]:
            out.append(F.when(named(c).isNotNull(), (named(c) == value).cast("double")).alias(f"{c}_{value}"))
    return df.select(*out)


def _pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(pair, r) for every pair, on rows where both are present; r is null if either is constant there."""
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    place = {c: i for i, c in enumerate(columns)}
    wanted = F.array(*[F.struct(F.lit(n).alias("pair"), F.lit(min(place[a], place[b])).alias("i"),
                                F.lit(max(place[a], place[b])).alias("j")) for n, (a, b) in enumerate(pairs)])
    listed = df.sparkSession.range(1).select(F.inline(wanted))  # a row per pair
    r = F.try_divide(F.col("sxy"), F.sqrt(F.col("sxx")) * F.sqrt(F.col("syy")))
    found = pair_moments(df, columns).select("i", "j", F.when(~F.col("flat"), r).alias("r"))
    return listed.join(found, ["i", "j"], "left").select("pair", "r")


def guarded_corr(df: DataFrame, columns: Sequence[str], pairs: Sequence[tuple[str, str]] | None = None,
                 digits: int = 6) -> DataFrame:
    """Pairwise-complete correlations in long form (a, b, r)."""
    pairs = [(min(p), max(p)) for p in (pairs if pairs is not None else combinations(columns, 2))]
    names = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])
    return (_pair_correlations(df, pairs).withColumn("_p", F.get(names, F.col("pair")))
            .select("_p.a", "_p.b", F.round("r", digits).alias("r")))


def point_biserial(df: DataFrame, features: Sequence[str], target: str, digits: int = 6) -> DataFrame:
    """|r(feature, target)|, strongest first, constant features left out."""
    names = F.array(*[F.lit(f) for f in features])
    rows = (_pair_correlations(df, [(f, target) for f in features])
            .select(F.get(names, F.col("pair")).alias("feature"), F.round(F.abs("r"), digits).alias("abs_r"))
            .filter(F.col("abs_r").isNotNull()))
    place = F.row_number().over(Window.orderBy(F.col("abs_r").desc(), "feature"))  # a row per feature
    return rows.withColumn("place", place)


def target_rates(df: DataFrame, columns: Sequence[str], target: str, digits: int = 6) -> DataFrame:
    """Target rate per category, beside the median rate of the column."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), named(c).cast("string").alias("value"))
                      for c in columns])
    rates = store(df.select(named(target).alias("_t"), F.inline(cells)).filter(F.col("value").isNotNull())
                  .groupBy("column", "value")
                  .agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("_t").cast("double")).alias("rate")), "rates")
    middle = exact_quantiles(rates, ["column"], "rate", {"median": 0.5}).drop("n")
    return (rates.join(F.broadcast(middle), "column")  # a row per listed column
            .select("column", "value", "n", F.round("rate", digits).alias("rate"),
                    F.round("median", digits).alias("median_rate"),
                    (F.col("rate") > F.col("median")).alias("above")))


def flow_links(df: DataFrame, first: str, second: str, target: str) -> DataFrame:
    """Counts of full paths and of both kinds of links between three stages, by grouping sets (C11)."""
    a, b, t = F.col("a"), F.col("b"), F.col("t")
    rows = df.select(F.col(first).cast("string").alias("a"), F.col(second).cast("string").alias("b"),
                     F.col(target).cast("string").alias("t")).filter(a.isNotNull() & b.isNotNull())
    return (rows.groupingSets([[a, b], [b, t], [a, b, t]], a, b, t)
            .agg(F.grouping("a").cast("int").alias("_no_a"), F.grouping("t").cast("int").alias("_no_t"),
                 F.count(F.lit(1)).alias("n"))
            .select(F.when(F.col("_no_t") == 1, "first-second").when(F.col("_no_a") == 1, "second-target")
                    .otherwise("path").alias("link"), "a", "b", "t", "n"))


def group_means(df: DataFrame, keys: Sequence[str], columns: Sequence[str], digits: int = 2,
                totals: str | None = None) -> DataFrame:
    """Rounded means per key combination (C12); ``totals`` may be 'rollup' or 'cube'."""
    grouped = {"rollup": df.rollup, "cube": df.cube}.get(totals, df.groupBy)(*keys)
    return grouped.agg(*[F.round(F.avg(c), digits).alias(c) for c in columns])


def split_compare(df: DataFrame, columns: Sequence[str], split: str = "split", bins: int = 10,
                  digits: int = 6) -> DataFrame:
    """Train beside test per column: size, mean, deviation, median, and a stability index (C14).

    The index is sum((p - q) * ln(p / q)) over equal-width bins of the joint
    range in which both sides have rows.
    """
    long = numeric_long(df, columns, [split])
    v = F.col("value")
    sides = ("train", "test")

    def on(side: str, col: Column) -> Column:
        return F.when(F.col(split) == side, col)

    moments = store(long.groupBy("column").agg(
        F.min("value").alias("_lo"), F.max("value").alias("_hi"),
        *[F.count(on(s, v)).alias(f"n_{s}") for s in sides],
        *[F.avg(on(s, v)).alias(f"mean_{s}") for s in sides],
        *[F.stddev_samp(on(s, v)).alias(f"std_{s}") for s in sides]), "moments")
    middle = exact_quantiles(long, ["column", split], "value", {"median": 0.5})
    middle = middle.groupBy("column").agg(*[F.max(on(s, F.col("median"))).alias(f"median_{s}") for s in sides])
    p, q = (F.count(on(s, v)) / F.max(f"n_{s}") for s in sides)
    binned = (long.join(moments, "column")
              .groupBy("column", equal_width_bin(v, F.col("_lo"), F.col("_hi"), bins).alias("bin"))
              .agg(p.alias("p"), q.alias("q")).filter("p > 0 and q > 0"))
    shift = binned.groupBy("column").agg(
        F.sum((F.col("p") - F.col("q")) * F.ln(F.col("p") / F.col("q"))).alias("stability_index"))
    shown = [f"{m}_{s}" for m in ("mean", "std", "median") for s in sides] + ["stability_index"]
    return (moments.join(middle, "column").join(shift, "column")
            .select("column", "n_train", "n_test", *[F.round(c, digits).alias(c) for c in shown]))


def pair_bins(df: DataFrame, x: str, y: str, target: str, bins: int = 10) -> DataFrame:
    """Two-dimensional bin counts per class: the data behind one pair-plot panel.

    ``df`` is read twice: the four range ends come back as constants of the second pass.
    """
    both = df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"),
                     F.col(target).alias("class")).filter("_x is not null and _y is not null")
    lo_x, hi_x, lo_y, hi_y = (F.lit(end) for end in both.agg(
        F.min("_x"), F.max("_x"), F.min("_y"), F.max("_y")).first())
    return (both.groupBy(equal_width_bin(F.col("_x"), lo_x, hi_x, bins).alias("bin_x"),
                         equal_width_bin(F.col("_y"), lo_y, hi_y, bins).alias("bin_y"), "class")
            .agg(F.count(F.lit(1)).alias("n")))


def labelled_projection(df: DataFrame, features: Sequence[str], target: str,
                        labels: Mapping[int, str]) -> DataFrame:
    """The named features the table has, plus a text label of the class."""
    present = [f for f in features if f in df.columns]
    label = F.lit(None).cast("string")
    for value, text in labels.items():
        label = F.when(F.col(target) == value, F.lit(text)).otherwise(label)
    return df.select(*present, label.alias("label"))
