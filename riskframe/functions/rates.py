"""Classification metrics as expressions over the four confusion counts.

Every metric is a function of columns ``tp, fp, fn, tn``, so one aggregate
grouped by anything (fold, model, subgroup, replicate) serves all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CELLS = ("tp", "fp", "fn", "tn")


def confusion_counts(y: str | Column = "y", pred: str | Column = "pred",
                     weight: Column | None = None) -> list[Column]:
    """Aggregates for the four cells; with ``weight`` they are weighted sums."""
    y = F.col(y) if isinstance(y, str) else y
    pred = F.col(pred) if isinstance(pred, str) else pred
    cells = {
        "tp": (y == 1) & (pred == 1),
        "fp": (y == 0) & (pred == 1),
        "fn": (y == 1) & (pred == 0),
        "tn": (y == 0) & (pred == 0),
    }
    if weight is None:
        return [F.count_if(cells[c]).alias(c) for c in CELLS]
    return [F.coalesce(F.sum(F.when(cells[c], weight)), F.lit(0)).alias(c) for c in CELLS]


def ratio(num: Column, den: Column) -> Column:
    """num / den, 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def metric_columns(tp="tp", fp="fp", fn="fn", tn="tn") -> dict[str, Column]:
    """All metrics by name. Macro averages run over labels seen in truth or prediction."""
    tp, fp, fn, tn = (F.col(c) if isinstance(c, str) else c for c in (tp, fp, fn, tn))
    n = tp + fp + fn + tn
    precision1, recall1 = ratio(tp, tp + fp), ratio(tp, tp + fn)
    precision0, recall0 = ratio(tn, tn + fn), ratio(tn, tn + fp)
    f1, f0 = ratio(2 * tp, 2 * tp + fp + fn), ratio(2 * tn, 2 * tn + fp + fn)
    has1 = (tp + fp + fn > 0).cast("int")
    has0 = (tn + fp + fn > 0).cast("int")

    def macro(zero: Column, one: Column) -> Column:
        return ratio(zero * has0 + one * has1, has0 + has1)

    return {
        "n": n,
        "support_neg": tn + fp,
        "support_pos": tp + fn,
        "prevalence": ratio(tp + fn, n),
        "accuracy": ratio(tp + tn, n),
        "f1_macro": macro(f0, f1),
        "precision_macro": macro(precision0, precision1),
        "recall_macro": macro(recall0, recall1),
        "precision_pos": precision1,
        "recall_pos": recall1,
        "f1_pos": f1,
        "precision_neg": precision0,
        "recall_neg": recall0,
        "f1_neg": f0,
        "sensitivity": recall1,
        "specificity": recall0,
    }


def with_metrics(counts: DataFrame, names: list[str], digits: int | None = None) -> DataFrame:
    """Append the named metrics to a table holding ``tp, fp, fn, tn``."""
    columns = metric_columns()

    def shaped(name: str) -> Column:
        col = columns[name]
        is_count = name in ("n", "support_neg", "support_pos")
        return col if digits is None or is_count else F.round(col, digits)

    return counts.withColumns({name: shaped(name) for name in names})
