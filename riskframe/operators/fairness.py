"""Subgroup metrics and gaps (H1-H7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.operators.evaluation import grouped_metrics

OVERALL = ("Overall", "All")
METRICS = ["n", "prevalence", "accuracy", "f1_macro", "f1_pos", "precision_pos", "recall_pos"]


def _in_groups(df: DataFrame, dimensions: dict[str, Column], keep: list[str]) -> DataFrame:
    """One row per (row, dimension) it belongs to, plus Overall; missing groups left out."""
    members = F.array(
        F.struct(F.lit(OVERALL[0]).alias("subgroup"), F.lit(OVERALL[1]).alias("group")),
        *[F.struct(F.lit(name).alias("subgroup"), col.cast("string").alias("group"))
          for name, col in dimensions.items()])
    return (df.select(*keep, F.explode(members).alias("_m"))
            .select(*keep, "_m.subgroup", "_m.group").filter(F.col("group").isNotNull()))


def subgroup_metrics(df: DataFrame, dimensions: dict[str, Column], y: str = "y", pred: str = "pred",
                     score: str | None = None, min_n: int = 30, digits: int | None = 6) -> DataFrame:
    """Metrics of every group of every dimension and overall; groups under ``min_n`` rows left out (H3).

    The counting aggregate combines map-side, so a dimension value holding most
    of the rows is no hot spot. With ``score`` the counts are kept per distinct
    score and stored; rates and AUC both come from that table, so the input is
    read once. Without a score the rows are first folded to counts of all
    dimensions together, and only those are dealt to the dimensions.
    """
    weight = None
    if not score:
        weight, named = "_w", {name: f"_d{i}" for i, name in enumerate(dimensions)}
        df = (df.select(y, pred, *[col.cast("string").alias(named[name]) for name, col in dimensions.items()])
              .groupBy(y, pred, *named.values()).agg(F.count(F.lit(1)).alias(weight)))
        dimensions = {name: F.col(inner) for name, inner in named.items()}
    members = _in_groups(df, dimensions, [y, pred, *filter(None, (score, weight))])
    return (grouped_metrics(members, ["subgroup", "group"], METRICS, y, pred, score, digits, weight)
            .filter(F.col("n") >= min_n))


def predicate_metrics(df: DataFrame, predicates: dict[str, Column], y: str = "y", pred: str = "pred",
                      min_n: int = 30, digits: int | None = 6) -> DataFrame:
    """Metrics of named, possibly overlapping row sets (H7)."""
    sets = F.filter(F.array(*[F.when(p, F.lit(name)) for name, p in predicates.items()]),
                    lambda s: s.isNotNull())
    members = df.select(y, pred, F.explode(sets).alias("subgroup"))
    return (grouped_metrics(members, ["subgroup"], ["n", "f1_macro", "recall_pos"], y, pred, digits=digits)
            .filter(F.col("n") >= min_n))


def gap_report(metrics: DataFrame, digits: int = 4) -> DataFrame:
    """Largest minus smallest F1 and recall per dimension (H4)."""
    groups = metrics.filter(F.col("subgroup") != OVERALL[0])
    return groups.groupBy("subgroup").agg(
        F.round(F.max("f1_macro") - F.min("f1_macro"), digits).alias("f1_gap"),
        F.round(F.max("recall_pos") - F.min("recall_pos"), digits).alias("recall_gap"))


def flagged_groups(metrics: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Per dimension, groups whose recall is more than ``tolerance`` below overall (H5)."""
    # ``metrics`` has a row per group, so a window over all of it is small.
    overall = F.max(F.when(F.col("subgroup") == OVERALL[0], F.col("recall_pos"))).over(Window.partitionBy())
    groups = metrics.withColumn("_overall", overall).filter(F.col("subgroup") != OVERALL[0])
    low = F.col("recall_pos") < F.col("_overall") - tolerance
    return groups.groupBy("subgroup").agg(
        F.concat_ws(", ", F.array_sort(F.collect_list(F.when(low, F.col("group"))))).alias("flagged"),
        F.count_if(low).alias("n_flagged"))


def metric_matrix(metrics: DataFrame, names: list[str]) -> DataFrame:
    """Long (label, metric, value) rows with the overall value beside each (H6)."""
    long = metrics.select(
        "subgroup", "group", F.concat_ws(" | ", "subgroup", "group").alias("label"),
        *names).unpivot(["subgroup", "group", "label"], names, "metric", "value")
    overall = (long.filter(F.col("subgroup") == OVERALL[0])
               .select("metric", F.col("value").alias("overall")))
    return long.join(F.broadcast(overall), "metric").select("label", "metric", "value", "overall")
