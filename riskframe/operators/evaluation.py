"""Evaluation of scored tables (G1-G18): ``y``, ``pred`` and ``score`` columns in, metric tables out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.functions.names import named
from riskframe.functions.rates import CELLS, confusion_counts, metric_columns, ratio, with_metrics
from riskframe.plans.ordered import exact_quantiles, running_totals
from riskframe.plans.storage import store

SUMMARY = ["n", "accuracy", "f1_macro", "precision_macro", "recall_macro",
           "precision_pos", "recall_pos", "f1_pos", "sensitivity", "specificity"]


def _rounded(col: Column, digits: int | None) -> Column:
    return col if digits is None else F.round(col, digits)


def confusion_matrix(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Four rows (y, pred, n), zeros included (G1)."""
    counts = df.agg(*confusion_counts(y, pred))
    cells = F.array(*[F.struct(F.lit(a).alias("y"), F.lit(b).alias("pred"), F.col(c).alias("n"))
                      for a, b, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))])
    return counts.select(F.inline(cells))


def class_report(df: DataFrame, y: str = "y", pred: str = "pred", digits: int | None = 6) -> DataFrame:
    """Rows 0, 1, accuracy, macro avg, weighted avg with precision, recall, F1, support."""
    m = metric_columns()
    n, neg, pos = m["n"], m["support_neg"], m["support_pos"]

    def weighted(kind: str) -> Column:
        return ratio(m[f"{kind}_neg"] * neg + m[f"{kind}_pos"] * pos, n)

    def row(label: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(F.lit(label).alias("label"), _rounded(precision, digits).alias("precision"),
                        _rounded(recall, digits).alias("recall"), _rounded(f1, digits).alias("f1"),
                        support.alias("support"))

    rows = F.array(
        row("0", m["precision_neg"], m["recall_neg"], m["f1_neg"], neg),
        row("1", m["precision_pos"], m["recall_pos"], m["f1_pos"], pos),
        row("accuracy", m["accuracy"], m["accuracy"], m["accuracy"], n),
        row("macro avg", m["precision_macro"], m["recall_macro"], m["f1_macro"], n),
        row("weighted avg", weighted("precision"), weighted("recall"), weighted("f1"), n))
    return df.agg(*confusion_counts(y, pred)).select(F.inline(rows))


def summary_metrics(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = (),
                    names: Sequence[str] = SUMMARY, digits: int | None = 6) -> DataFrame:
    """One row of metrics per group."""
    return with_metrics(df.groupBy(*by).agg(*confusion_counts(y, pred)), list(names), digits).drop(*CELLS)


def score_counts(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score: the input of every ranking metric."""
    return (df.filter(F.col(score).isNotNull()).groupBy(*by, score)
            .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")))


def roc_auc_from_counts(counts: DataFrame, score: str, by: Sequence[str] = (),
                        digits: int | None = 6, stored: bool = False) -> DataFrame:
    runs = running_totals(counts, by, score, ["pos", "neg"], stored=stored)
    below = (F.col("neg_upto") - F.col("neg")).cast("double") + F.col("neg") * 0.5
    pairs = F.max("pos_all").cast("double") * F.max("neg_all")
    auc = F.try_divide(F.sum(F.col("pos") * below), pairs)
    return runs.groupBy(*by).agg(_rounded(auc, digits).alias("roc_auc"))


def grouped_metrics(df: DataFrame, by: Sequence[str], names: Sequence[str], y: str = "y", pred: str = "pred",
                    score: str | None = None, digits: int | None = 6, weight: str | None = None) -> DataFrame:
    """Metrics per group, with AUC if there is a score, from one reading of ``df``.

    ``weight`` names a column of counts if rows stand for several. With a score the confusion counts are kept per distinct score and stored;
    the rates are sums of that table and the AUC a running total over it.
    """
    by, counts = list(by), confusion_counts(y, pred, F.col(weight) if weight else None)
    if not score:
        return with_metrics(df.groupBy(*by).agg(*counts), list(names), digits).drop(*CELLS)
    cells = store(df.groupBy(*by, score).agg(*counts), "cells")
    sums = cells.groupBy(*by).agg(*[F.sum(c).alias(c) for c in CELLS])
    rates = with_metrics(sums, list(names), digits).drop(*CELLS)
    classes = cells.filter(F.col(score).isNotNull()).select(
        *by, score, (F.col("tp") + F.col("fn")).alias("pos"), (F.col("fp") + F.col("tn")).alias("neg"))
    return rates.join(roc_auc_from_counts(classes, score, by, digits, stored=True), by, "left")


def roc_auc(df: DataFrame, y: str = "y", score: str = "score", by: Sequence[str] = (),
            digits: int | None = 6) -> DataFrame:
    """Area under the ROC curve with exact tie handling; null if one class is absent."""
    return roc_auc_from_counts(score_counts(df, y, score, by), score, by, digits)


def average_precision(df: DataFrame, y: str = "y", score: str = "score", by: Sequence[str] = (),
                      digits: int | None = 6) -> DataFrame:
    """Sum of (recall step x precision) over descending thresholds."""
    runs = running_totals(score_counts(df, y, score, by), by, score, ["pos", "neg"])
    return runs.groupBy(*by).agg(
        _rounded(_precision_step_sum(), digits).alias("average_precision"))


def ranking_metrics(df: DataFrame, y: str = "y", score: str = "score", by: Sequence[str] = (),
                    digits: int | None = 6) -> DataFrame:
    """AUC and average precision from one pass."""
    runs = running_totals(score_counts(df, y, score, by), by, score, ["pos", "neg"])
    below = (F.col("neg_upto") - F.col("neg")).cast("double") + F.col("neg") * 0.5
    auc = F.try_divide(F.sum(F.col("pos") * below), F.max("pos_all").cast("double") * F.max("neg_all"))
    return runs.groupBy(*by).agg(
        _rounded(auc, digits).alias("roc_auc"),
        _rounded(_precision_step_sum(), digits).alias("average_precision"))


def _tp() -> Column:
    return F.col("pos_all") - F.col("pos_upto") + F.col("pos")


def _fp() -> Column:
    return F.col("neg_all") - F.col("neg_upto") + F.col("neg")


def _precision_step_sum() -> Column:
    return F.try_divide(F.sum(F.col("pos") * ratio(_tp(), _tp() + _fp())), F.max("pos_all"))


def roc_points(df: DataFrame, y: str = "y", score: str = "score", digits: int | None = 6) -> DataFrame:
    """ROC points (threshold, fpr, tpr) with the leading (0, 0); collinear points left out.

    Going down the scores, a point is on a straight line when the next lower
    score adds the same numbers of positives and negatives as this one does.
    """
    runs = running_totals(score_counts(df, y, score), [], score, ["pos", "neg"])
    lowest = F.col("pos_prev").isNull()
    highest = (F.col("pos_upto") == F.col("pos_all")) & (F.col("neg_upto") == F.col("neg_all"))
    bends = (F.col("pos_prev") != F.col("pos")) | (F.col("neg_prev") != F.col("neg"))
    points = runs.filter(lowest | highest | bends).select(
        F.col(score).alias("threshold"),
        _rounded(ratio(_fp(), F.col("neg_all")), digits).alias("fpr"),
        _rounded(ratio(_tp(), F.col("pos_all")), digits).alias("tpr"))
    origin = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(origin)


def pr_points(df: DataFrame, y: str = "y", score: str = "score", digits: int | None = 6) -> DataFrame:
    """Precision-recall points per distinct threshold, the final (1, 0), and the prevalence."""
    runs = running_totals(score_counts(df, y, score), [], score, ["pos", "neg"])
    prevalence = _rounded(ratio(F.col("pos_all"), F.col("pos_all") + F.col("neg_all")), digits)
    highest = (F.col("pos_upto") == F.col("pos_all")) & (F.col("neg_upto") == F.col("neg_all"))
    point = F.struct(F.col(score).alias("threshold"),
                     _rounded(ratio(_tp(), _tp() + _fp()), digits).alias("precision"),
                     _rounded(ratio(_tp(), F.col("pos_all")), digits).alias("recall"),
                     prevalence.alias("prevalence"))
    end = F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                   F.lit(0.0).alias("recall"), prevalence.alias("prevalence"))
    # The row of the highest score also emits the end point.
    return runs.select(F.inline(F.when(highest, F.array(point, end)).otherwise(F.array(point))))


def calibration(df: DataFrame, y: str = "y", score: str = "score", bins: int = 10,
                digits: int | None = 6) -> DataFrame:
    """Mean score and positive share per right-closed uniform bin; empty bins left out."""
    bin_no = F.greatest(F.ceil(F.col(score) * bins) - 1, F.lit(0).cast("long"))
    return (df.filter(F.col(score).isNotNull()).groupBy(bin_no.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"),
                 _rounded(F.avg(score), digits).alias("mean_score"),
                 _rounded(F.avg(F.col(y).cast("double")), digits).alias("positive_share")))


def threshold_grid(start: float = 0.05, stop: float = 0.95, count: int = 80) -> list[float]:
    step = (stop - start) / (count - 1)
    return [start + i * step for i in range(count - 1)] + [stop]


def threshold_sweep(df: DataFrame, y: str = "y", score: str = "score", start: float = 0.05,
                    stop: float = 0.95, count: int = 80, digits: int | None = 6) -> DataFrame:
    """Precision, recall, F1 at evenly spaced thresholds, best one flagged.

    Each score is put once in the slot of the highest threshold it passes (an
    arithmetic guess, corrected by one against the stored thresholds); suffix
    sums over the ``count`` slots give the counts. Best = highest F1, lowest
    threshold on ties.
    """
    grid = threshold_grid(start, stop, count)
    points = F.array(*[F.lit(t) for t in grid])
    s = F.col(score)
    guess = F.least(F.greatest(F.floor((s - start) / ((stop - start) / (count - 1))).cast("int"),
                               F.lit(-1)), F.lit(count - 1))
    slot = (F.when(F.get(points, guess + 1) <= s, guess + 1)
            .when((guess >= 0) & (F.get(points, guess) > s), guess - 1).otherwise(guess))
    tallies = (df.filter(s.isNotNull()).groupBy(slot.alias("slot"))
               .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")))
    slots = df.sparkSession.range(-1, count).select(F.col("id").cast("int").alias("slot"))
    filled = slots.join(tallies, "slot", "left").fillna(0, ["pos", "neg"])
    above = Window.orderBy(F.col("slot").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    counted = filled.select("slot", F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"),
                            F.sum("pos").over(everything).alias("_pos"),
                            F.sum("neg").over(everything).alias("_neg"))
    counted = (counted.filter("slot >= 0").withColumn("fn", F.col("_pos") - F.col("tp"))
               .withColumn("tn", F.col("_neg") - F.col("fp")))
    m = metric_columns()
    best = F.row_number().over(Window.orderBy(m["f1_pos"].desc(), "slot")) == 1
    return counted.select(_rounded(F.get(points, F.col("slot")), digits).alias("threshold"),
                          _rounded(m["precision_pos"], digits).alias("precision"),
                          _rounded(m["recall_pos"], digits).alias("recall"),
                          _rounded(m["f1_pos"], digits).alias("f1"), best.alias("best"))


def outcome(y: Column, pred: Column) -> Column:
    """TP, TN, FP or FN of a row."""
    return (F.when((y == 1) & (pred == 1), "TP").when((y == 0) & (pred == 0), "TN")
            .when((y == 0) & (pred == 1), "FP").when((y == 1) & (pred == 0), "FN"))


def with_outcome(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    return df.withColumn("outcome", outcome(F.col(y), F.col(pred)))


def outcome_shares(df: DataFrame, y: str = "y", pred: str = "pred", digits: int | None = 6) -> DataFrame:
    """Count and share of each outcome."""
    counts = with_outcome(df, y, pred).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(Window.partitionBy())  # over at most four rows
    return counts.withColumn("share", _rounded(F.col("n") / whole, digits))


def outcome_profile(df: DataFrame, features: Sequence[str], y: str = "y", pred: str = "pred",
                    digits: int = 2) -> DataFrame:
    """Mean of each feature per outcome, features as rows."""
    kinds = ["TP", "TN", "FP", "FN"]
    marked = with_outcome(df, y, pred)
    means = marked.agg(*[F.avg(F.when(F.col("outcome") == k, named(f))).alias(f"m{i}_{k}")
                         for i, f in enumerate(features) for k in kinds])
    rows = F.array(*[F.struct(F.lit(f).alias("feature"),
                              *[F.round(F.col(f"m{i}_{k}"), digits).alias(k) for k in kinds])
                     for i, f in enumerate(features)])
    return means.select(F.inline(rows))


def error_rates(df: DataFrame, segments: Sequence[str], y: str = "y", pred: str = "pred",
                digits: int = 3) -> DataFrame:
    """Share of correct, false-negative and false-positive rows per segment value."""
    cells = F.array(*[F.struct(F.lit(s).alias("segment"), named(s).cast("string").alias("value")) for s in segments])
    long = with_outcome(df, y, pred).select("outcome", F.inline(cells)).filter(F.col("value").isNotNull())

    def share(*kinds: str) -> Column:
        return F.round(F.avg(F.col("outcome").isin(*kinds).cast("int")), digits)

    return long.groupBy("segment", "value").agg(
        F.count(F.lit(1)).alias("n"), share("TP", "TN").alias("correct"),
        share("FN").alias("false_negative"), share("FP").alias("false_positive"))


def error_examples(df: DataFrame, key: str, columns: Sequence[str], y: str = "y", pred: str = "pred",
                   n: int = 10) -> DataFrame:
    """The first ``n`` false positives and false negatives by key (G16): a top-k report.

    Spark keeps only ``n`` rows per outcome in each task before the shuffle.
    """
    wrong = with_outcome(df, y, pred).filter(F.col("outcome").isin("FP", "FN"))
    place = F.row_number().over(Window.partitionBy("outcome").orderBy(key))
    return (wrong.withColumn("place", place).filter(F.col("place") <= n)
            .select("outcome", "place", key, *columns))


def outcome_quartiles(df: DataFrame, features: Sequence[str], y: str = "y", pred: str = "pred",
                      digits: int | None = 6) -> DataFrame:
    """Quartiles of each feature per outcome."""
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), named(f).cast("double").alias("value")) for f in features])
    long = with_outcome(df, y, pred).select("outcome", F.inline(cells))
    rows = exact_quantiles(long, ["feature", "outcome"], "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return rows.select("feature", "outcome", "n", *[_rounded(F.col(c), digits).alias(c)
                                                   for c in ("q1", "median", "q3")])


def final_summary(df: DataFrame, y: str = "y", pred: str = "pred", score: str = "score",
                  split: str = "split", fold: str = "fold", digits: int | None = 6) -> DataFrame:
    """One row: held-out metrics, fold mean and spread, best threshold, sizes."""
    test = df.filter(F.col(split) == "test")
    held = summary_metrics(test, y, pred, names=["n", "accuracy", "f1_macro"], digits=digits)
    ranked = ranking_metrics(test, y, score, digits=digits)
    best = (threshold_sweep(test, y, score, digits=digits).filter("best")
            .select(F.col("threshold").alias("best_threshold"), F.col("f1").alias("best_f1")))
    folds = summary_metrics(df.filter(F.col(split) == "train"), y, pred, [fold], ["f1_macro", "n"], None)
    cv = folds.agg(_rounded(F.avg("f1_macro"), digits).alias("cv_f1_mean"),
                   _rounded(F.stddev_pop("f1_macro"), digits).alias("cv_f1_std"),
                   F.sum("n").alias("n_train"))
    # Every part is one row: stack them and keep the one value of each column.
    out = held.withColumnRenamed("n", "n_test")
    for part in (ranked, best, cv):
        out = out.unionByName(part, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])
