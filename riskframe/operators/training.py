"""Training, cross-validation, tuning and scoring as Spark jobs."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from itertools import product

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskframe.functions.bands import risk_band
from riskframe.functions.rates import CELLS, confusion_counts, with_metrics
from riskframe.operators import linear, network as nets, sampling, surrogate, trees
from riskframe.operators.evaluation import grouped_metrics
from riskframe.plans.blocks import Blocks
from riskframe.plans.storage import store

FOLD_METRICS = ["f1_macro", "accuracy", "precision_macro", "recall_macro"]
SEED = 42


# --- class weights ------------------------------------------------------------------------------------

def class_weights(df: DataFrame, target: str, digits: int = 6) -> DataFrame:
    """Balanced weight n / (K * n_c) per class, and n_neg / n_pos for the positive one (F1)."""
    counts = df.filter(F.col(target).isNotNull()).groupBy(F.col(target).alias("class")).agg(
        F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()  # one row per class
    whole, classes = F.sum("n").over(every), F.count(F.lit(1)).over(every)
    negatives = F.sum(F.when(F.col("class") == 0, F.col("n"))).over(every)
    return counts.select("class", "n", F.round(whole / (classes * F.col("n")), digits).alias("balanced_weight"),
                         F.when(F.col("class") == 1, F.round(F.try_divide(negatives.cast("double"), F.col("n")), digits))
                         .alias("positive_weight"))


def class_counts(train: DataFrame, target: str = "y") -> dict[int, int]:
    """Rows of class 0 and of class 1, from one aggregate."""
    neg, pos = train.agg(F.count_if(F.col(target) == 0), F.count_if(F.col(target) == 1)).first()
    return {0: neg, 1: pos}


def with_balanced_weights(train: DataFrame, target: str = "y", column: str = "weight",
                          counts: Mapping[int, int] | None = None) -> DataFrame:
    """Balanced weights of these training rows, and of no others; ``counts`` if they are known already."""
    counts = class_counts(train, target) if counts is None else counts
    n = sum(counts.values())
    weight = F.when(F.col(target) == 1, F.lit(n / (2 * counts[1]) if counts[1] else 0.0)).otherwise(
        F.lit(n / (2 * counts[0]) if counts[0] else 0.0))
    return train.withColumn(column, weight)


# --- learners ---------------------------------------------------------------------------------------

def logistic_regression(train: DataFrame, C: float = 1.0, features: str = "features", target: str = "y",
                        weight: str | None = None, max_iter: int = 1000, total: float | None = None) -> LogisticRegression:
    """L2 logistic regression with inverse strength ``C`` (F2).

    The loss here is a weighted mean rather than a sum, hence regParam = 1 / (C * total weight); ``total`` if it is known.
    """
    if total is None:
        total = train.agg(F.sum(weight) if weight else F.count(F.lit(1))).first()[0]
    estimator = LogisticRegression(featuresCol=features, labelCol=target, regParam=1.0 / (C * float(total)),
                                   elasticNetParam=0.0, standardization=False, maxIter=max_iter)
    return estimator.setWeightCol(weight) if weight else estimator


@dataclass(frozen=True)
class Learner:
    """How to make an estimator for given training rows.

    ``build(train, features, target, weight, rows)``; balanced weights add up to the number of rows.
    """

    name: str
    build: Callable[[DataFrame, str, str, str | None, int], Estimator] | None = None
    weighted: bool = True
    params: Mapping[str, object] | None = None
    #: Loss and inverse strength of a linear model: many of those are fitted from one scan.
    linear: tuple[str, float] | None = None
    #: A forest or boosted model; those of several folds grow together.
    trees: trees.Spec | None = None
    #: A network; those of several folds are trained together.
    net: nets.Spec | None = None


def lr(C: float = 1.0, max_iter: int = 1000, name: str = "LogisticRegression") -> Learner:
    return Learner(name, lambda t, f, y, w, n: logistic_regression(t, C, f, y, w, max_iter, n),
                   params={"C": C, "max_iter": max_iter, "class_weight": "balanced"}, linear=("logistic", C))


def tree(depth: int = 5, name: str = "DecisionTree") -> Learner:
    """Decision tree."""
    return Learner(name, lambda t, f, y, w, n: DecisionTreeClassifier(
        featuresCol=f, labelCol=y, weightCol=w, maxDepth=depth, seed=SEED), params={"max_depth": depth})


def forest(n_trees: int = 200, depth: int | None = None, min_split: int = 2, name: str = "RandomForest") -> Learner:
    """Random forest (F4); without a depth it grows until leaves are pure or can't be split."""
    return Learner(name, trees=trees.Spec("forest", n_trees, depth or 0, min_split=min_split, seed=SEED),
                   params={"n_estimators": n_trees, "max_depth": depth, "min_samples_split": min_split})


def boosted(rounds: int = 200, rate: float = 0.3, depth: int = 6, subsample: float = 1.0,
            name: str = "GradientBoosting") -> Learner:
    """Second-order boosted trees that grow level by level."""
    return Learner(name, trees=trees.Spec("boosted", rounds, depth, rate=rate, subsample=subsample, seed=SEED),
                   params={"n_estimators": rounds, "learning_rate": rate, "max_depth": depth, "subsample": subsample})


def leafwise(rounds: int = 200, rate: float = 0.1, depth: int | None = None, subsample: float = 1.0, leaves: int = 31,
             name: str = "LeafwiseBoosting") -> Learner:
    """Second-order boosted trees that grow the leaf with the highest gain first."""
    return Learner(name, trees=trees.Spec("boosted", rounds, depth or 0, leaves, 20, rate=rate, subsample=subsample, l2=0.0,
                                          min_weight=1e-3, seed=SEED),
                   params={"n_estimators": rounds, "learning_rate": rate, "max_depth": depth, "subsample": subsample,
                           "num_leaves": leaves})


def linear_svm(C: float = 1.0, max_iter: int = 200, name: str = "LinearSVM") -> Learner:
    """Max-margin classifier (F6); on Fourier features it approximates the radial kernel.

    Cross-validation and searches fit it by ``linear`` with the hinge's corner rounded, a single fit by MLlib.
    """
    def build(t: DataFrame, f: str, y: str, w: str | None, n: int) -> Estimator:
        return LinearSVC(featuresCol=f, labelCol=y, weightCol=w, regParam=1.0 / (C * n),
                         maxIter=max_iter, standardization=False)
    return Learner(name, build, params={"C": C}, linear=("hinge", C))


def network(hidden: Sequence[int] = (128, 64, 32), max_iter: int = 300, name: str = "NeuralNetwork") -> Learner:
    """Feed-forward net in mini-batches with early stopping (F7), unweighted."""
    return Learner(name, weighted=False, net=nets.Spec(tuple(hidden), max_iter, seed=SEED),
                   params={"hidden": list(hidden), "max_iter": max_iter, "early_stopping": True})


def fourier_features(df: DataFrame, gamma: float, size: int = 128, vector: str = "features",
                     output: str = "fourier", seed: int = SEED) -> DataFrame:
    """Random Fourier features of the radial kernel exp(-gamma * |a - b|^2) (Rahimi & Recht 2007).

    The random directions depend on ``seed`` and the vector length only.
    """
    length = len(df.select(vector).first()[0])
    draw = np.random.default_rng(seed)
    directions = draw.normal(0.0, np.sqrt(2.0 * gamma), (length, size))
    shifts = draw.uniform(0.0, 2.0 * np.pi, size)

    @F.pandas_udf("array<double>")
    def waves(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return pd.Series([], dtype=object)
        return pd.Series(list(np.sqrt(2.0 / size) * np.cos(np.vstack(rows.to_numpy()) @ directions + shifts)))

    return df.withColumn(output, array_to_vector(waves(vector_to_array(vector))))


def fit(learner: Learner, train: DataFrame, features: str = "features", target: str = "y",
        counts: Mapping[int, int] | None = None) -> Model | trees.Ensemble | nets.Network:
    """Fit on these rows; balanced weights come from them too. ``counts`` of their classes save a pass."""
    if learner.trees:
        return fit_ensembles(train, [learner], features, target)[0]
    if learner.net:
        return fit_networks(train, [learner], features, target)[0]
    counts = class_counts(train, target) if counts is None else counts
    rows = with_balanced_weights(train, target, counts=counts) if learner.weighted else train
    return learner.build(rows, features, target, "weight" if learner.weighted else None, sum(counts.values())).fit(rows)


def fit_ensembles(train: DataFrame, learners: Sequence[Learner], features: str = "features", target: str = "y",
                  fold: str | None = None, folds: int = 1, key: str | None = "id",
                  held: Sequence[tuple[int, ...]] | None = None) -> list[trees.Ensemble]:
    """Forests and boosted models on one binned matrix; with ``fold``, every learner without each fold (or set) in turn."""
    edges = trees.bin_edges(train, features)
    member = F.array(F.col(fold).cast("int") if fold else F.lit(0))
    rows = trees.binned_blocks(train, edges, member, features, target, key)
    held = held or (range(folds) if fold else [-1])
    return trees.fit_many(rows, [replace(m.trees, value=i) for m in learners for i in held], edges)


def fit_networks(train: DataFrame, learners: Sequence[Learner], features: str = "features", target: str = "y",
                 fold: str | None = None, folds: int = 1, key: str | None = "id",
                 held: Sequence[tuple[int, ...]] | None = None) -> list[nets.Network]:
    """Networks on the same blocks; with ``fold``, every learner without each fold (or set) in turn."""
    rows = nets.network_blocks(train, F.array(F.col(fold).cast("int") if fold else F.lit(0)), features, target, key)
    held = held or (range(folds) if fold else [-1])
    return nets.fit_many(rows, [replace(m.net, value=i) for m in learners for i in held])


def score(model: Model | trees.Ensemble | nets.Network, df: DataFrame, features: str = "features") -> DataFrame:
    """Add ``pred`` (0/1) and ``score``: the positive probability, or the margin if there is none."""
    if isinstance(model, (trees.Ensemble, nets.Network, LinearModel)):
        return model.score_rows(df, features).select(*df.columns, "pred", "score")
    out = model.transform(df)
    column = "probability" if "probability" in out.columns else "rawPrediction"
    positive = F.get(vector_to_array(column), F.lit(1))
    return (out.withColumn("pred", F.col("prediction").cast("int")).withColumn("score", positive)
            .select(*df.columns, "pred", "score"))


# --- cross-validation -------------------------------------------------------------------------------

def _in_parallel(tasks: Sequence[Callable], parallelism: int) -> list:
    """Run driver-side fits side by side: each is a Spark job of its own."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return [f.result() for f in [pool.submit(inherit(task)) for task in tasks]]


def fold_counts(table: DataFrame, target: str = "y", fold: str = "fold") -> dict[int, dict[int, int]]:
    """Classes of the training rows of every fold, all from one aggregate (a row per fold and class)."""
    rows = table.filter(F.col(target).isin(0, 1)).groupBy(fold, target).count().collect()
    whole = {c: sum(r["count"] for r in rows if r[target] == c) for c in (0, 1)}
    held = {(r[fold], r[target]): r["count"] for r in rows}
    return {f: {c: whole[c] - held.get((f, c), 0) for c in (0, 1)} for f in {r[fold] for r in rows}}


def out_of_fold(table: DataFrame, learners: Sequence[Learner], key: str = "id", features: str = "features",
                target: str = "y", fold: str = "fold", folds: int = 5, parallelism: int = 4,
                cut: Column | None = None) -> DataFrame:
    """(model, key, fold, target, pred, score): every row scored by the model that did not see it.

    ``table`` should be stored, best partitioned by ``fold``: every part then reads its folds' files only. ``cut`` may
    restrict the training rows. Weights are those of each training part, from one count of all of them.
    """
    lines = [m for m in learners if m.linear and cut is None]
    grown = [m for m in learners if (m.trees or m.net) and cut is None]
    others = [m for m in learners if m not in lines and m not in grown]
    out = linear_out_of_fold(table, lines, key, features, target, fold, folds) if lines else None
    for fits, own in ((fit_ensembles, [m for m in grown if m.trees]), (fit_networks, [m for m in grown if m.net])):
        if own:
            models = fits(table, own, features, target, fold, folds, key)
            more = trees.score_held_out(table, models, [m.name for m in own for _ in range(folds)], key, features, target, fold)
            out = more if out is None else out.unionByName(more)
    if others:
        counts = fold_counts(table if cut is None else table.filter(cut), target, fold)

        def part(learner: Learner, i: int) -> Callable[[], DataFrame]:
            def run() -> DataFrame:
                train = table.filter(F.col(fold) != i)
                model = fit(learner, train if cut is None else train.filter(cut), features, target, counts.get(i))
                held = score(model, table.filter(F.col(fold) == i))
                return held.select(F.lit(learner.name).alias("model"), key, fold, target, "pred", "score")
            return run

        for more in _in_parallel([part(m, i) for m in others for i in range(folds)], parallelism):
            out = more if out is None else out.unionByName(more)
    return store(out, "oof")


def fold_fits(table: DataFrame, learners: Sequence[Learner], features: str = "features", target: str = "y",
              fold: str = "fold", folds: int = 5) -> tuple[linear.Fits, list[str], Blocks]:
    """Linear learners fitted without each fold, all from one scan: (fits, their learners' names, the blocks)."""
    specs = [linear.Spec(m.linear[1], m.linear[0], 0, "not", i) for m in learners for i in range(folds)]
    rows = linear.member_blocks(table, F.array(F.col(fold).cast("int")), features, target)
    return linear.fit_many(rows, specs), [m.name for m in learners for _ in range(folds)], rows


def linear_out_of_fold(table: DataFrame, learners: Sequence[Learner], key: str = "id", features: str = "features",
                       target: str = "y", fold: str = "fold", folds: int = 5) -> DataFrame:
    """``out_of_fold`` of linear learners."""
    fits, names, _ = fold_fits(table, learners, features, target, fold, folds)
    return linear.score_held_out(table, fits, names, key, features, target, fold)


def _cells(spark: SparkSession, rows: Sequence[tuple], kind: str) -> DataFrame:
    """A small table of counts: a row per model."""
    return spark.createDataFrame(rows, f"{kind}, tp long, fp long, fn long, tn long")


def fold_metrics(scored: DataFrame, by: Sequence[str] = ("model",), target: str = "y", fold: str = "fold",
                 with_auc: bool = True) -> DataFrame:
    """The five fold metrics per (by..., fold), unrounded."""
    return grouped_metrics(scored, [*by, fold], FOLD_METRICS, target, "pred",
                           "score" if with_auc else None, digits=None)


def summarise_folds(folds: DataFrame, by: Sequence[str] = ("model",), metrics: Sequence[str] | None = None,
                    digits: int | None = 6) -> DataFrame:
    """Mean and population deviation over folds."""
    metrics = metrics or [*FOLD_METRICS, "roc_auc"]

    def shown(col: Column, name: str) -> Column:
        return (col if digits is None else F.round(col, digits)).alias(name)

    return folds.groupBy(*by).agg(*[a for m in metrics for a in (
        shown(F.avg(m), f"{m}_mean"), shown(F.stddev_pop(m), f"{m}_std"))])


def compare_models(summary: DataFrame, by: str = "f1_macro_mean") -> DataFrame:
    """Models in order of ``by``, the top row marked best."""
    place = F.row_number().over(Window.orderBy(F.col(by).desc(), "model"))  # a row per model
    return summary.withColumn("place", place).withColumn("best", F.col("place") == 1)


def melt_comparison(summary: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """(model, metric, value) rows."""
    return summary.unpivot(["model"], [f"{m}_mean" for m in metrics], "metric", "value")


# --- tuning ------------------------------------------------------------------------------------------

# The tuning grids.
GRIDS = {
    "LogisticRegression": {"C": [0.01, 0.1, 1.0, 10.0]},
    "RandomForest": {"n_trees": [100, 200], "depth": [None, 10, 20], "min_split": [2, 5]},
    "GradientBoosting": {"rate": [0.05, 0.1], "depth": [4, 6], "rounds": [100, 200], "subsample": [0.8, 1.0]},
    "LeafwiseBoosting": {"rate": [0.05, 0.1], "depth": [4, 6], "rounds": [100, 200], "subsample": [0.8, 1.0]},
    "LinearSVM": {"C": [0.1, 1.0, 10.0]},
}
MAKERS = {"LogisticRegression": lr, "RandomForest": forest, "GradientBoosting": boosted, "LeafwiseBoosting": leafwise,
          "LinearSVM": linear_svm}


def grid(family: str, space: Mapping[str, Sequence] | None = None) -> list[dict]:
    space = space or GRIDS[family]
    return [dict(zip(space, values)) for values in product(*space.values())]


def log_uniform(count: int = 30, low: float = 0.001, high: float = 100.0, salt: str = "search") -> list[dict]:
    """``count`` strengths spread log-uniformly by keyed hash."""
    def u(i: int) -> float:
        return int(hashlib.md5(f"{salt}:{i}".encode()).hexdigest()[:8], 16) / 2 ** 32
    return [{"C": low * (high / low) ** u(i)} for i in range(count)]


def linear_fold_counts(table: DataFrame, learners: Sequence[Learner], features: str = "features", target: str = "y",
                       fold: str = "fold", folds: int = 5) -> DataFrame:
    """(model, fold, counts, f1_macro) of linear learners on their held-out folds: no scored row is written."""
    fits, names, rows = fold_fits(table, learners, features, target, fold, folds)
    cells = linear.confusion_of(rows, fits)
    made = [(name, spec.value, *map(int, cells[i, 1])) for i, (name, spec) in enumerate(zip(names, fits.specs))]
    return with_metrics(_cells(table.sparkSession, made, "model string, fold int"), ["f1_macro"])


def search(table: DataFrame, family: str, candidates: Sequence[dict], folds: int = 5, parallelism: int = 4,
           features: str = "features", target: str = "y", fold: str = "fold", key: str = "id") -> DataFrame:
    """Cross-validated F1 of every candidate, best first (F10, F11): (candidate, params, mean, std, place)."""
    learners = [MAKERS[family](**c, name=json.dumps(c, sort_keys=True)) for c in candidates]
    if all(m.linear for m in learners):
        per_fold = linear_fold_counts(table, learners, features, target, fold, folds)
    else:
        per_fold = fold_metrics(out_of_fold(table, learners, key, features, target, fold, folds, parallelism),
                                with_auc=False, target=target, fold=fold)
    means = summarise_folds(per_fold, metrics=["f1_macro"], digits=None)
    place = F.row_number().over(Window.orderBy(F.col("f1_macro_mean").desc(), "params"))
    return (means.withColumnRenamed("model", "params").withColumn("family", F.lit(family))
            .withColumn("place", place)
            .select("family", "params", "f1_macro_mean", "f1_macro_std", "place"))


def sequential_search(table: DataFrame, family: str = "LogisticRegression", count: int = 30, low: float = 0.001,
                      high: float = 100.0, first: int = 6, batch: int = 4, folds: int = 5, features: str = "features",
                      target: str = "y", fold: str = "fold") -> DataFrame:
    """Cross-validated F1 of ``count`` strengths of a linear learner, each round proposed from the ones before.

    The axis is the logarithm of the strength. The rows are stored as blocks once; a round's strengths and folds are fitted
    together, each from the coefficients of the nearest strength measured, and only counts reach the driver.
    Returns (family, params, round, f1_macro_mean, f1_macro_std, place), best first; ``refit_best`` takes it. Rows of a
    class other than 0 or 1 play no part; a table without rows of both classes gives every strength the same value.
    """
    maker = MAKERS[family]
    if not maker(1.0).linear:
        raise ValueError("the sequential search is over the strength of a linear learner")
    rows = linear.member_blocks(table, F.array(F.col(fold).cast("int")), features, target)
    names: dict[float, str] = {}
    cells: list[tuple] = []
    known: dict[float, np.ndarray] = {}

    def measure(points: list[float]) -> list[float]:
        made = {p: maker(low * (high / low) ** p).linear for p in points}
        specs = [linear.Spec(C, loss, 0, "not", i) for loss, C in made.values() for i in range(folds)]
        start = None
        if known:
            start = np.concatenate([known[min(known, key=lambda k: (abs(k - p), k))] for p in points])
        fits = linear.fit_many(rows, specs, start=start)
        held = linear.confusion_of(rows, fits)[:, 1]
        whole = np.column_stack([fits.coefficients, fits.intercepts])
        for j, p in enumerate(points):
            own = slice(j * folds, (j + 1) * folds)
            known[p] = whole[own]
            names[p] = json.dumps({"C": made[p][1]}, sort_keys=True)
            cells.extend((names[p], i, *map(int, c)) for i, c in enumerate(held[own]))
        wanted = [names[p] for p in points]
        got = per_strength([c for c in cells if c[0] in set(wanted)])
        value = {r["params"]: r["f1_macro_mean"] for r in got.select("params", "f1_macro_mean").collect()}
        return [value[name] for name in wanted]

    def per_strength(counts: list[tuple]) -> DataFrame:
        per_fold = with_metrics(_cells(table.sparkSession, counts, "params string, fold int"), ["f1_macro"])
        return summarise_folds(per_fold, ["params"], ["f1_macro"], None)

    found = surrogate.maximise(measure, count, first, batch)
    rounds = table.sparkSession.createDataFrame([(names[p], n) for p, _, n in found], "params string, round int")
    place = F.row_number().over(Window.orderBy(F.col("f1_macro_mean").desc(), "params"))  # a row per strength
    return (per_strength(cells).join(rounds, "params").withColumn("family", F.lit(family)).withColumn("place", place)
            .select("family", "params", "round", "f1_macro_mean", "f1_macro_std", "place"))


def radial_width(table: DataFrame, kind: str | float, vector: str = "features") -> float:
    """Kernel width: a number, "auto" (1 / slots) or "scale" (1 / (slots * variance of all cells))."""
    if kind not in ("auto", "scale"):
        return float(kind)
    mean, var, n = table.select(Summarizer.metrics("mean", "variance", "count").summary(F.col(vector)).alias("s")).select(
        "s.mean", "s.variance", "s.count").first()
    mean, var = mean.toArray(), var.toArray() * (n - 1) / n
    spread = float((var + mean ** 2).mean() - mean.mean() ** 2)
    return 1.0 / len(mean) if kind == "auto" else 1.0 / (len(mean) * spread)


def radial_search(table: DataFrame, Cs: Sequence[float], gammas: Sequence[str | float], folds: int = 5, parallelism: int = 4,
                  features: str = "features", target: str = "y", fold: str = "fold", key: str = "id") -> DataFrame:
    """Cross-validated F1 of max-margin classifiers over strength and kernel width, best first."""
    counts = None
    for gamma in gammas:
        waves = fourier_features(table, radial_width(table, gamma, features), vector=features)
        learners = [linear_svm(C, name=json.dumps({"C": C, "gamma": gamma})) for C in Cs]
        part = linear_fold_counts(waves.select(key, target, "fourier", fold), learners, "fourier", target, fold, folds)
        counts = part if counts is None else counts.unionByName(part)
    means = summarise_folds(counts, metrics=["f1_macro"], digits=None)
    place = F.row_number().over(Window.orderBy(F.col("f1_macro_mean").desc(), "params"))
    return (means.withColumnRenamed("model", "params").withColumn("place", place)
            .select("params", "f1_macro_mean", "f1_macro_std", "place"))


def refit_best(table: DataFrame, results: DataFrame, features: str = "features", target: str = "y") -> Model:
    """The best candidate of ``search`` fitted on the whole table."""
    best = results.filter("place = 1").first()
    return fit(MAKERS[best["family"]](**json.loads(best["params"])), table, features, target)


# --- compositions -----------------------------------------------------------------------------------

def held_out(models: Mapping[str, Model], test: DataFrame, target: str = "y") -> DataFrame:
    """F1-macro, positive recall and AUC of fitted models on the same held-out rows."""
    scored = None
    for name, model in models.items():
        rows = score(model, test).select(F.lit(name).alias("model"), target, "pred", "score")
        scored = rows if scored is None else scored.unionByName(rows)
    return grouped_metrics(scored, ["model"], ["n", "accuracy", "f1_macro", "recall_pos"], target, "pred",
                           "score", digits=None)


def scores_without(table: DataFrame, learners: Sequence[Learner], held: Sequence[tuple[int, ...]], key: str = "id",
                   features: str = "features", target: str = "y", fold: str = "fold") -> DataFrame:
    """(model, key, fold, outer, target, pred, score): every learner fitted without each set of folds, all together.

    A row of a held-out fold is scored once per set; ``outer`` is the set's other fold, or the fold itself where the set
    has one. Learners must be linear, trees or networks.
    """
    sets = [tuple(sorted(h)) for h in held]
    out = None

    def both(rows: DataFrame, hold: tuple[int, ...], models: list, names: list[str]) -> DataFrame:
        parts = None
        for i in hold:
            outer = next((j for j in hold if j != i), i)
            own = rows.filter(F.col(fold) == i).select(key, fold, target, features)
            for name, model in zip(names, models):
                one = score(model, own, features).select(F.lit(name).alias("model"), key, fold, F.lit(outer).alias("outer"), target, "pred", "score")
                parts = one if parts is None else parts.unionByName(one)
        return parts

    lines = [m for m in learners if m.linear]
    if lines:
        rows = linear.member_blocks(table, F.array(F.col(fold).cast("int")), features, target)
        fits = linear.fit_many(rows, [linear.Spec(m.linear[1], m.linear[0], 0, "not", h) for m in lines for h in sets])
        for k, hold in enumerate(sets):
            own = [LinearModel(fits.coefficients[j * len(sets) + k], fits.intercepts[j * len(sets) + k], m.linear[0])
                   for j, m in enumerate(lines)]
            part = both(table, hold, own, [m.name for m in lines])
            out = part if out is None else out.unionByName(part)
    grown = [m for m in learners if m.trees or m.net]
    for own in ([m for m in grown if m.trees], [m for m in grown if m.net]):
        if not own:
            continue
        fits = fit_ensembles if own[0].trees else fit_networks
        models = fits(table, own, features, target, fold, key=key, held=sets)
        for k, hold in enumerate(sets):
            part = both(table, hold, [models[j * len(sets) + k] for j in range(len(own))], [m.name for m in own])
            out = part if out is None else out.unionByName(part)
    return store(out, "without")


@dataclass(frozen=True)
class LinearModel:
    """One model of ``linear.fit_many`` that scores rows."""

    coefficients: np.ndarray
    intercept: float
    loss: str = "logistic"

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        margin = x @ self.coefficients + self.intercept
        return margin if self.loss == "hinge" else 1.0 / (1.0 + np.exp(-margin))

    def binned(self, x: np.ndarray) -> np.ndarray:  # as tree ensembles are scored
        return x

    def score_rows(self, df: DataFrame, vector: str = "features") -> DataFrame:
        products = F.zip_with(vector_to_array(vector), F.array(*[F.lit(float(c)) for c in self.coefficients]), lambda a, b: a * b)
        margin = F.aggregate(products, F.lit(float(self.intercept)), lambda a, b: a + b)
        shown = margin if self.loss == "hinge" else 1 / (1 + F.exp(-margin))
        return df.withColumn("pred", (margin > 0).cast("int")).withColumn("score", shown)


def _stacked_rows(table: DataFrame, scores: DataFrame, names: Sequence[str], on: Sequence[str], features: str,
                  keep: Sequence[str]) -> DataFrame:
    """(keep..., _stacked): base scores beside the original features."""
    inner = {n: f"_s{i}" for i, n in enumerate(names)}
    wide = scores.groupBy(*on).pivot("model", list(names)).agg(F.max("score")).withColumnsRenamed(inner)
    joined = table.join(wide, [c for c in on if c in table.columns])
    return VectorAssembler(inputCols=[*inner.values(), features], outputCol="_stacked").transform(joined).select(*keep, "_stacked")


def nested_stack(table: DataFrame, learners: Sequence[Learner], key: str = "id", features: str = "features",
                 target: str = "y", fold: str = "fold", folds: int = 5, name: str = "Stacking") -> DataFrame:
    """Out-of-fold rows of the whole stack (F8): nothing that scores a fold has seen its labels.

    For an outer fold, the final model's inputs on another fold come from base learners fitted without both, and on the
    outer fold from those fitted without it. A pair of folds serves both of its outer folds.
    """
    pairs = [(i, j) for i in range(folds) for j in range(i + 1, folds)]
    scores = scores_without(table, learners, [*pairs, *((i,) for i in range(folds))], key, features, target, fold)
    rows = store(_stacked_rows(table.select(key, target, fold, features), scores.drop(fold, target), [m.name for m in learners],
                               [key, "outer"], features, [key, target, fold, "outer"]), "stacked")
    code = (F.col("outer") * folds + F.col(fold)).cast("int")
    blocks = linear.member_blocks(rows, F.array(code), "_stacked", target)
    fits = linear.fit_many(blocks, [linear.Spec(1.0, "logistic", 0, "in", tuple(i * folds + j for j in range(folds) if j != i))
                                    for i in range(folds)])
    by_fold = linear.Fits([linear.Spec(1.0, value=i) for i in range(folds)], fits.coefficients, fits.intercepts, fits.class_rows, fits.passes)
    return store(linear.score_held_out(rows.filter(F.col(fold) == F.col("outer")), by_fold, [name] * folds, key, "_stacked", target, fold), "oof")


def stack(table: DataFrame, test: DataFrame, learners: Sequence[Learner], key: str = "id",
          features: str = "features", target: str = "y", fold: str = "fold", folds: int = 5,
          parallelism: int = 4) -> DataFrame:
    """Stacked ensemble on held-out rows beside its base learners (F8): (model, metrics, delta to best base).

    Base learners score the training rows out of fold; their scores join the
    original features in the input of a logistic regression.
    """
    names = [m.name for m in learners]
    oof = out_of_fold(table, learners, key, features, target, fold, folds, parallelism)

    def widened(rows: DataFrame, scores: DataFrame) -> DataFrame:
        wide = scores.groupBy(key).pivot("model", names).agg(F.max("score"))
        joined = rows.join(wide, key)
        return VectorAssembler(inputCols=[*names, features], outputCol="_stacked").transform(joined)

    bases = dict(zip(names, _in_parallel([lambda m=m: fit(m, table, features, target) for m in learners],
                                         parallelism)))
    meta_train = store(widened(table, oof).select(key, target, "_stacked"), "stack")
    meta = fit(lr(1.0), meta_train, "_stacked", target)
    base_scores = None
    for name, model in bases.items():
        rows = score(model, test).select(key, target, F.lit(name).alias("model"), "pred", "score")
        base_scores = rows if base_scores is None else base_scores.unionByName(rows)
    base_scores = store(base_scores, "base")
    stacked = score(meta, widened(test.select(key, target, features), base_scores).select(key, target, "_stacked"))
    every = base_scores.unionByName(stacked.select(
        key, target, F.lit("Stacking").alias("model"), "pred", "score"))
    out = grouped_metrics(every, ["model"], ["n", "f1_macro"], target, "pred", "score", digits=None)
    best_base = F.max(F.when(F.col("model") != "Stacking", F.col("f1_macro"))).over(Window.partitionBy())
    return out.withColumn("delta", F.when(F.col("model") == "Stacking", F.col("f1_macro") - best_base))


def learning_curve(table: DataFrame, learner: Learner, sizes: Sequence[float], key: str = "id",
                   features: str = "features", target: str = "y", fold: str = "fold", folds: int = 5,
                   parallelism: int = 4) -> DataFrame:
    """Train and validation F1 by share of the training rows (E6): mean, deviation, gap per size.

    Each training part is cut to exactly floor(size * n) rows in hash order, so smaller samples nest in larger ones.
    """
    if learner.linear:
        counts = _linear_curve(table, learner, sizes, key, features, target, fold, folds)
    else:
        counts = _curve(table, learner, sizes, key, features, target, fold, folds, parallelism)
    rows = with_metrics(counts, ["f1_macro", "n"])
    side = {p: F.when(F.col("part") == p, F.col("f1_macro")) for p in ("train", "validation")}
    return rows.groupBy("size").agg(
        F.round(F.avg(F.when(F.col("part") == "train", F.col("n"))), 1).alias("train_rows"),
        *[a for p, c in side.items() for a in (F.avg(c).alias(f"{p}_mean"), F.stddev_pop(c).alias(f"{p}_std"))],
        (F.avg(side["train"]) - F.avg(side["validation"])).alias("gap"))


def _linear_curve(table: DataFrame, learner: Learner, sizes: Sequence[float], key: str, features: str, target: str,
                  fold: str, folds: int) -> DataFrame:
    """Counts by size, fold and part; every row bears, per fold, the first size whose sample holds it (0: held out)."""
    ordered = sorted(set(map(float, sizes)))
    levels = sampling.nested_levels(table.filter(F.col(target).isin(0, 1)), key, fold, folds, ordered, "curve")
    specs = [linear.Spec(learner.linear[1], learner.linear[0], i, "upto", k + 1) for k in range(len(ordered)) for i in range(folds)]
    rows = linear.member_blocks(levels, F.col("levels"), features, target)
    fits = linear.fit_many(rows, specs)
    trained = linear.confusion_of(rows, fits)[:, 0]
    held = linear.confusion_of(rows, linear.Fits([linear.Spec(s.C, s.loss, s.group, "not", 0) for s in specs], fits.coefficients,
                                                 fits.intercepts, fits.class_rows, 0))[:, 1]
    made = [(ordered[s.value - 1], s.group, part, *map(int, cells[i]))
            for part, cells in (("train", trained), ("validation", held)) for i, s in enumerate(specs)]
    return _cells(table.sparkSession, made, "size double, fold int, part string")


def _curve(table: DataFrame, learner: Learner, sizes: Sequence[float], key: str, features: str, target: str, fold: str,
           folds: int, parallelism: int) -> DataFrame:
    places = store(table.select(key, fold, target, features), "curve", [fold])
    nested = {i: store(sampling.progressive_samples(places.filter(F.col(fold) != i).select(key, target, features), key,
                                                    sizes, salt=f"curve-{i}"), "curve", ["fraction"]) for i in range(folds)}

    def part(size: float, i: int) -> Callable[[], DataFrame]:
        def run() -> DataFrame:
            train = nested[i].filter(F.col("fraction") == F.lit(float(size))).select(key, target, features)
            model = fit(learner, train, features, target)
            both = score(model, train).withColumn("part", F.lit("train")).unionByName(
                score(model, places.filter(F.col(fold) == i).select(key, target, features)).withColumn("part", F.lit("validation")))
            return both.groupBy("part").agg(*confusion_counts(target, "pred")).select(
                F.lit(float(size)).alias("size"), F.lit(i).alias("fold"), "part", *CELLS)
        return run

    parts = _in_parallel([part(s, i) for s in sizes for i in range(folds)], parallelism)
    counts = parts[0]
    for more in parts[1:]:
        counts = counts.unionByName(more)
    return counts


def progressive_fit(train: DataFrame, test: DataFrame, learner: Learner, fractions: Sequence[float],
                    key: str = "id", features: str = "features", target: str = "y") -> DataFrame:
    """Held-out F1 of models fitted on nested samples of growing size (E5)."""
    nested = store(sampling.progressive_samples(train, key, fractions), "progressive")
    models = {str(f): fit(learner, nested.filter(F.col("fraction") == F.lit(float(f))), features, target)
              for f in fractions}
    return (held_out(models, test, target).withColumn("fraction", F.col("model").cast("double"))
            .select("fraction", "n", "f1_macro", "roc_auc"))


def compare_resampling(train: DataFrame, test: DataFrame, learner: Learner, key: str = "id",
                       features: str = "features", target: str = "y") -> DataFrame:
    """Held-out F1 and positive recall by resampling strategy, with the size it trained on."""
    sides = train.groupBy(target).agg(F.count(F.lit(1)).alias("n")).orderBy("n", target).collect()
    minority = sides[0][target]
    as_array = train.withColumn("_v", vector_to_array(features))
    made = sampling.smote(as_array.select(key, target, "_v"), key, target, "_v", minority)
    synthetic = made.select(F.lit(minority).alias(target), array_to_vector("_v").alias(features))
    sets = {
        "none": train.select(target, features),
        "under": sampling.under_sample(train, key, target).select(target, features),
        "over": sampling.over_sample(train, key, target).select(target, features),
        "smote": train.select(target, features).unionByName(synthetic),
    }
    sets = {name: store(rows, name) for name, rows in sets.items()}
    sizes = {name: rows.count() for name, rows in sets.items()}
    models = {name: fit(learner, rows, features, target) for name, rows in sets.items()}
    trained = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, n)])
    return held_out(models, test, target).select(
        F.col("model").alias("method"), F.try_element_at(trained, F.col("model")).alias("train_rows"),
        "f1_macro", "recall_pos")


def seed_summary(per_fold: DataFrame, digits: int = 6) -> DataFrame:
    """Per seed and over all, from (seed, fold, f1_macro) rows."""
    per_seed = per_fold.groupBy("seed").agg(
        F.avg("f1_macro").alias("f1_mean"), F.stddev_pop("f1_macro").alias("f1_std"),
        F.min("f1_macro").alias("f1_min"), F.max("f1_macro").alias("f1_max"))
    every = Window.partitionBy()  # a row per seed
    return per_seed.select("seed", *[F.round(c, digits).alias(c) for c in ("f1_mean", "f1_std", "f1_min", "f1_max")],
                           F.round(F.avg("f1_mean").over(every), digits).alias("overall_mean"),
                           F.round(F.stddev_samp("f1_mean").over(every), digits).alias("overall_std"),
                           F.round(F.max("f1_mean").over(every) - F.min("f1_mean").over(every), digits)
                           .alias("overall_range"))


def _seeded(rows: DataFrame, seeds: Sequence[int], key: str, target: str, folds: int) -> DataFrame:
    """Every row once per seed with its fold; all assignments are drawn in one pass, with the seed as the hash salt."""
    seeded = rows.withColumn("seed", F.explode(F.array(*[F.lit(int(s)) for s in seeds])))
    return sampling.stratified_folds(seeded, key, ["seed", target], folds, salt=F.col("seed"))


def seed_sensitivity(scored: DataFrame, seeds: Sequence[int], key: str = "id", target: str = "y",
                     pred: str = "pred", folds: int = 5, digits: int = 6) -> DataFrame:
    """Fold F1 of a fixed prediction column under several fold seeds: how much the cut alone moves it."""
    assigned = _seeded(scored.select(key, target, pred), seeds, key, target, folds)
    counts = assigned.groupBy("seed", "fold").agg(*confusion_counts(target, pred))
    return seed_summary(with_metrics(counts, ["f1_macro"]), digits)


def seed_refits(table: DataFrame, learner: Learner, seeds: Sequence[int], key: str = "id", features: str = "features",
                target: str = "y", folds: int = 5, parallelism: int = 4, digits: int = 6) -> DataFrame:
    """Fold F1 of a learner fitted anew for every seed and fold (F13): per seed and over all."""
    if learner.linear:
        return _linear_refits(table, learner, seeds, key, features, target, folds, digits)
    cuts = store(_seeded(table.select(key, target, features), seeds, key, target, folds), "seeds", ["seed", "fold"])
    rows = cuts.groupBy("seed", "fold", target).count().collect()  # a row per seed, fold and class

    def part(seed: int, i: int) -> Callable[[], DataFrame]:
        def run() -> DataFrame:
            own = cuts.filter(F.col("seed") == seed)
            counts = {c: sum(r["count"] for r in rows if r["seed"] == seed and r["fold"] != i and r[target] == c) for c in (0, 1)}
            model = fit(learner, own.filter(F.col("fold") != i), features, target, counts)
            return score(model, own.filter(F.col("fold") == i)).select("seed", "fold", target, "pred")
        return run

    parts = _in_parallel([part(s, i) for s in seeds for i in range(folds)], parallelism)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    counts = out.groupBy("seed", "fold").agg(*confusion_counts(target, "pred"))
    return seed_summary(with_metrics(counts, ["f1_macro"]), digits)


def _linear_refits(table: DataFrame, learner: Learner, seeds: Sequence[int], key: str, features: str, target: str,
                   folds: int, digits: int) -> DataFrame:
    """All seeds and folds from one scan: every row bears its fold under each seed."""
    rows = table.filter(F.col(target).isin(0, 1)).select(key, target, features)
    drawn = sampling.fold_arrays(rows, key, target, [0, 1], folds, [int(s) for s in seeds])
    blocks = linear.member_blocks(drawn, F.col("folds"), features, target)
    fits = linear.fit_many(blocks, [linear.Spec(learner.linear[1], learner.linear[0], j, "not", i)
                                    for j in range(len(seeds)) for i in range(folds)])
    cells = linear.confusion_of(blocks, fits)[:, 1]
    made = [(int(seeds[s.group]), s.value, *map(int, c)) for s, c in zip(fits.specs, cells)]
    return seed_summary(with_metrics(_cells(table.sparkSession, made, "seed int, fold int"), ["f1_macro"]), digits)


# --- batch scoring -----------------------------------------------------------------------------------

def fill_profile(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Missing cells, and missing columns, take their default."""
    out = {}
    for column, value in defaults.items():
        out[column] = F.coalesce(F.col(column), F.lit(value)) if column in df.columns else F.lit(value)
    return df.withColumns(out)


def band_scores(df: DataFrame, column: str = "score") -> DataFrame:
    """Label at one half, and the risk band, of every scored row."""
    # The two labels.
    return (df.withColumn("label", F.when(F.col(column) >= 0.5, "High Risk").otherwise("Low Risk"))
            .withColumn("band", risk_band(F.col(column))))


def score_profiles(prepared, model: Model, df: DataFrame, defaults: Mapping[str, object],
                   keep: Sequence[str]) -> DataFrame:
    """Raw profiles to (keep..., score, label, band) through a fitted preparation and model."""
    rows = prepared.transform(fill_profile(df, defaults))
    return band_scores(score(model, rows)).select(*keep, "score", "label", "band")
