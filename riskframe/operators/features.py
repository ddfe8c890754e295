"""Feature preparation, ranking and projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.functions.names import named, quoted as _quote
from riskframe.plans.pairs import pair_moments


# --- column encoders -------------------------------------------------------------------------

def cardinality_guard(df: DataFrame, columns: Sequence[str], max_levels: int = 20,
                      approx: bool = False) -> DataFrame:
    """Distinct values per column and whether it is kept."""
    if approx:
        wide = df.agg(*[F.approx_count_distinct(named(c)).alias(f"_d{i}") for i, c in enumerate(columns)])
        rows = wide.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"_d{i}").alias("levels"))
            for i, c in enumerate(columns)])))
    else:
        from riskframe.operators.quality import value_counts

        rows = value_counts(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("levels"))
    return rows.withColumn("kept", F.col("levels") <= max_levels)


def drop_columns(df: DataFrame, listed: Sequence[str], guarded: Sequence[str] = (),
                 max_levels: int = 20) -> DataFrame:
    """Drop the listed columns the table has, and guarded ones with too many levels."""
    present = [c for c in guarded if c in df.columns and c not in listed]
    wide = [r["column"] for r in cardinality_guard(df, present, max_levels).filter("not kept").collect()] \
        if present else []
    return df.drop(*listed, *wide)


def value_map(col: Column, mapping: Mapping[str, float]) -> Column:
    """Mapped value, null where the value is not in the map."""
    out = F.lit(None).cast("double")
    for key, value in mapping.items():
        out = F.when(col == key, F.lit(float(value))).otherwise(out)
    return out


def ordinal(col: Column, labels: Sequence[str], default: float = 3) -> Column:
    """1.. by place in ``labels``; anything else, or nothing, gives ``default`` (D3)."""
    return F.coalesce(value_map(col, {label: i for i, label in enumerate(labels, 1)}), F.lit(float(default)))


def interaction(a: Column, b: Column) -> Column:
    """Product of two columns, before any scaling."""
    return a * b


def levels_of(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted categories per column, in one pass. Each of them becomes a column or slot, so the driver has to name them."""
    from riskframe.operators.quality import value_counts

    levels: dict[str, list[str]] = {c: [] for c in columns}
    if columns:
        for row in value_counts(df, columns).select("column", "value").collect():
            levels[row["column"]].append(row["value"])
    return {c: sorted(values) for c, values in levels.items()}


def one_hot(df: DataFrame, column: str, levels: Sequence[str], prefix: str | None = None) -> DataFrame:
    """One 0/1 column per fitted category; a category not seen at fit gives zeros."""
    name = prefix or column
    return df.withColumns({
        f"{name}_{v}": F.coalesce((named(column) == v).cast("int"), F.lit(0)) for v in levels})


# --- scaling: fitted on training rows, applied as column arithmetic ---------------------------------

def fit_min_max(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    row = train.agg(*[f(named(c).cast("double")).alias(f"{p}{i}") for i, c in enumerate(columns)
                      for p, f in (("lo", F.min), ("hi", F.max))]).first()
    return {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(columns)}


def min_max(col: Column, low: float | None, high: float | None) -> Column:
    """(x - low) / (high - low), not clipped; a constant column gives 0."""
    if low is None:
        return F.lit(None).cast("double")
    if low == high:
        return F.when(col.isNotNull(), F.lit(0.0))
    return (col - F.lit(low)) / F.lit(high - low)


def fit_standard(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    row = train.agg(*[f(named(c).cast("double")).alias(f"{p}{i}") for i, c in enumerate(columns)
                      for p, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def standard(col: Column, mean: float, deviation: float) -> Column:
    """(x - mean) / population deviation, 1 for a constant column."""
    return (col - F.lit(mean)) / F.lit(deviation)


# --- the whole preparation ----------------------------------------------------------------------

@dataclass(frozen=True)
class FeatureSpec:
    """Which columns play which part. Names are configuration; no operator knows them."""

    numeric: Sequence[str] = ()
    ordinal: Mapping[str, Sequence[str]] = field(default_factory=dict)
    binary: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    one_hot: Sequence[str] = ()
    passthrough: Sequence[str] = ()
    interactions: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    fill: Mapping[str, float] = field(default_factory=dict)
    ordinal_default: float = 3


@dataclass(frozen=True)
class FittedFeatures:
    """A fitted preparation: an ordinary ``PipelineModel`` and the names of its vector slots."""

    model: PipelineModel
    names: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


def _text(value: str) -> str:
    """A SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _case(column: str, mapping: Mapping[str, float], otherwise: str) -> str:
    arms = " ".join(f"WHEN {_text(k)} THEN {float(v)!r}D" for k, v in mapping.items())
    return f"CASE {_quote(column)} {arms} ELSE {otherwise} END"


def fit_features(train: DataFrame, spec: FeatureSpec, output: str = "features") -> FittedFeatures:
    """Fit encoders and scalers on training rows only.

    The result is one SQL projection plus a ``VectorAssembler``, so scoring is a
    single generated projection and the model saves and loads like any pipeline.
    """
    stages, encoded = [], {}
    for c, labels in spec.ordinal.items():
        encoded[c] = _case(c, {v: i for i, v in enumerate(labels, 1)}, f"{float(spec.ordinal_default)!r}D")
    for c, mapping in spec.binary.items():
        encoded[c] = _case(c, mapping, "0.0D")
    for c in [*spec.numeric, *spec.passthrough]:
        fill = spec.fill.get(c)
        base = f"CAST({_quote(c)} AS DOUBLE)"
        encoded[c] = base if fill is None else f"COALESCE({base}, {float(fill)!r}D)"
    # Neutral names inside: a name may hold a dot, which an assembler would read as a field.
    inner = {c: f"_x{i}" for i, c in enumerate([*encoded, *spec.interactions])}
    raw = ", ".join(f"{text} AS {inner[c]}" for c, text in encoded.items())
    crossed = ", ".join(f"{inner[a]} * {inner[b]} AS {inner[name]}" for name, (a, b) in spec.interactions.items())
    levels = levels_of(train, spec.one_hot)
    scaled, kept = [*spec.numeric, *spec.interactions], [*spec.ordinal, *spec.binary, *spec.passthrough]
    names = [*scaled, *[f"{c}_{v}" for c, values in levels.items() for v in values], *kept]
    slots = [f"_f{i}" for i in range(len(names))]
    hot_slots = iter(slots[len(scaled):])
    hot = ", ".join(
        f"CASE WHEN CAST({_quote(c)} AS STRING) = {_text(v)} THEN 1.0D ELSE 0.0D END AS {next(hot_slots)}"
        for c, values in levels.items() for v in values)
    for extra in (raw, crossed, hot):
        if extra:
            stages.append(SQLTransformer(statement=f"SELECT *, {extra} FROM __THIS__"))
    prepared = PipelineModel(stages).transform(train)
    bounds = fit_min_max(prepared, [inner[c] for c in scaled]) if scaled else {}
    parts = []
    for slot, c in zip(slots, scaled):
        low, high = bounds[inner[c]]
        flat = low is None or low == high
        body = "0.0D" if flat else f"({inner[c]} - {low!r}D) / {high - low!r}D"
        parts.append(f"{body} AS {slot}")
    parts += [f"{inner[c]} AS {slot}" for slot, c in zip(slots[len(slots) - len(kept):], kept)]
    if parts:
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__"))
    stages.append(VectorAssembler(inputCols=slots, outputCol=output, handleInvalid="error"))
    stages.append(SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join([*inner.values(), *slots])}) FROM __THIS__"))
    return FittedFeatures(PipelineModel(stages), names)


def slot_means(df: DataFrame, names: Sequence[str], vector: str = "features", digits: int = 6) -> DataFrame:
    """Position, name and mean of every vector slot."""
    means = df.select(Summarizer.mean(F.col(vector)).alias("m"))
    table = F.array(*[F.lit(n) for n in names])
    return (means.select(F.posexplode(vector_to_array("m")).alias("position", "mean"))
            .select("position", F.get(table, F.col("position")).alias("name"),
                    F.round("mean", digits).alias("mean")))


# --- ranking and projection -------------------------------------------------------------------------

def chi2_ranking(df: DataFrame, features: Sequence[str], target: str, classes: Sequence[int] = (0, 1),
                 k: int = 10, digits: int = 6) -> DataFrame:
    """Chi-square of observed against expected feature mass per class, best ``k`` marked."""
    sums = df.agg(*[F.count_if(named(target) == c).alias(f"_n{c}") for c in classes],
                  *[F.coalesce(F.sum(F.when(named(target) == c, named(f).cast("double"))), F.lit(0.0))
                    .alias(f"_o{i}_{c}") for i, f in enumerate(features) for c in classes])
    n = sum((F.col(f"_n{c}") for c in classes), F.lit(0))
    rows = []
    for i, f in enumerate(features):
        mass = sum((F.col(f"_o{i}_{c}") for c in classes), F.lit(0.0))
        stat = F.lit(0.0)
        for c in classes:
            expected = mass * F.col(f"_n{c}") / n
            gap = F.col(f"_o{i}_{c}") - expected
            stat = stat + F.coalesce(F.try_divide(gap * gap, expected), F.lit(0.0))
        rows.append(F.struct(F.lit(f).alias("feature"), F.round(stat, digits).alias("chi2")))
    place = F.row_number().over(Window.orderBy(F.col("chi2").desc(), "feature"))  # a row per feature
    return (sums.select(F.inline(F.array(*rows))).withColumn("place", place)
            .withColumn("kept", F.col("place") <= k))


def covariance_matrix(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Sample covariances in long form, a <= b in list order (D12); rows where both are present."""
    table = F.array(*[F.lit(c) for c in columns])
    return pair_moments(df, columns).select(
        F.get(table, F.col("i")).alias("a"), F.get(table, F.col("j")).alias("b"),
        F.round(F.try_divide(F.col("sxy"), F.col("n") - 1), digits).alias("cov"))


def pca_variance(df: DataFrame, vector: str = "features", goal: float = 0.95) -> DataFrame:
    """Explained-variance ratio and running total per component; the first to reach ``goal``."""
    size = len(df.select(vector).first()[0])
    model = PCA(k=size, inputCol=vector, outputCol="_pca").fit(df)
    ratios = [float(x) for x in model.explainedVariance]
    rows = df.sparkSession.createDataFrame(
        [(i + 1, r) for i, r in enumerate(ratios)], "component int, ratio double")
    run = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("ratio").over(run)
    return rows.withColumn("cumulative", total).withColumn(
        "enough", F.min(F.when(F.col("cumulative") >= goal, F.col("component"))).over(Window.partitionBy()))


def pca_project(df: DataFrame, k: int = 2, vector: str = "features", output: str = "projected") -> DataFrame:
    """Rows projected on the first ``k`` principal axes."""
    return PCA(k=k, inputCol=vector, outputCol=output).fit(df).transform(df)


def gram_matrix(df: DataFrame, vector: str = "features") -> np.ndarray:
    """Sum of x x' over the rows, features x features, summed on the executors.

    Put together from the mean, variance and correlation of the slots; a
    constant slot has no covariance.
    """
    n, mean, var = (df.select(F.count(vector).alias("n"),
                              Summarizer.metrics("mean", "variance").summary(F.col(vector)).alias("s"))
                    .select("n", "s.mean", "s.variance").first())
    mean, deviation = mean.toArray(), np.sqrt(var.toArray())
    corr = np.nan_to_num(Correlation.corr(df, vector).first()[0].toArray())
    return (n - 1) * corr * np.outer(deviation, deviation) + n * np.outer(mean, mean)


def truncated_svd(df: DataFrame, vector: str = "features", k: int | None = None,
                  output: str = "projected") -> tuple[DataFrame, list[float], np.ndarray]:
    """Uncentred rank-k projection (D13): (projected rows, singular values, V).

    Only features x features numbers reach the driver, whatever the row count.
    """
    gram = gram_matrix(df, vector)
    size = gram.shape[0]
    k = min(10, size - 1) if k is None else k
    squares, axes = np.linalg.eigh(gram)
    top = np.argsort(squares)[::-1][:k]
    v = axes[:, top]
    return project(df, v, vector, output), [float(s) for s in np.sqrt(np.maximum(squares[top], 0.0))], v


def project(df: DataFrame, v: np.ndarray, vector: str = "features", output: str = "projected") -> DataFrame:
    """``vector`` times the features x k matrix ``v``, inside the JVM."""
    values = vector_to_array(vector)
    slots = []
    for j in range(v.shape[1]):
        axis = F.array(*[F.lit(float(x)) for x in v[:, j]])
        products = F.zip_with(values, axis, lambda a, b: a * b)
        slots.append(F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x))
    return df.withColumn(output, F.array(*slots))


def svd_variance(projected: DataFrame, total_of: str, column: str = "projected") -> DataFrame:
    """Variance of each projected slot over the total variance of the input slots."""
    total = projected.select(Summarizer.variance(F.col(total_of)).alias("v")).select(
        F.aggregate(vector_to_array("v"), F.lit(0.0), lambda acc, x: acc + x).alias("t")).first()["t"]
    size = len(projected.select(column).first()[0])
    wide = projected.agg(*[F.var_samp(F.get(F.col(column), F.lit(j))).alias(f"_v{j}") for j in range(size)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(j + 1).alias("component"), (F.col(f"_v{j}") / F.lit(total)).alias("ratio"))
        for j in range(size)])))


def recursive_elimination(train: DataFrame, names: Sequence[str], keep: int, target: str = "y",
                          vector: str = "features", weight: str | None = None) -> DataFrame:
    """Drop the weakest coefficient of a logistic regression until ``keep`` features are left.

    Returns (feature, rank, kept): rank 1 for survivors, 2 for the last dropped, and so on. The rows are stored as blocks
    once; a round starts from the coefficients of the last one, so it takes a few passes over them.
    """
    from riskframe.operators import linear

    left, dropped = list(range(len(names))), []
    blocks = linear.member_blocks(train, F.array(F.lit(0)), vector, target, weight)
    start = None
    while len(left) > keep:
        fits = linear.fit_many(blocks, [linear.Spec(1.0)], balanced=False, slots=left, start=start)
        own = fits.coefficients[0]
        weakest = min(range(len(left)), key=lambda i: (own[i] ** 2, i))
        dropped.append(left.pop(weakest))
        start = np.append(np.delete(own, weakest), fits.intercepts[0])[None, :]
    rows = [(names[i], 1, True) for i in left]
    rows += [(names[i], place + 2, False) for place, i in enumerate(reversed(dropped))]
    return train.sparkSession.createDataFrame(rows, "feature string, rank int, kept boolean")


def keep_slots(df: DataFrame, names: Sequence[str], wanted: Sequence[str], vector: str = "features",
               output: str = "selected") -> DataFrame:
    """The vector cut down to the wanted names, in their original order."""
    indices = [i for i, n in enumerate(names) if n in set(wanted)]
    return VectorSlicer(inputCol=vector, outputCol=output, indices=indices).transform(df)

