"""Views of the driver tables that play the part of a surveyed, scored table.

``order_survey``  one row per order: nominal, ordinal and numeric columns, natural
                  nulls (orders without line items), a planted 0/1 label.
``scored_orders`` the same plus two score columns and predictions.
``sampled_orders``the same plus ``fold`` (0-4) and ``split`` (train/test), stored once.
``doc_labels``    documents with their labels where they have any.
``vectors``       embeddings as arrays of doubles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskframe.functions.hashing import keyed_uniform
from riskframe.plans.storage import ROW_GROUP, store
from riskframe.sources.tables import table

NUMERIC = ["acctbal", "totalprice", "n_lines", "qty_sum", "disc_sum", "priority_ord"]
CATEGORICAL = ["segment", "priority", "status", "region_name"]


def order_survey(spark: SparkSession, folder: str) -> DataFrame:
    lines = (table(spark, folder, "lineitem")
             .groupBy(F.col("l_orderkey").alias("id"))
             .agg(F.count(F.lit(1)).alias("n_lines"),
                  F.sum(F.round("l_quantity").cast("long")).alias("qty_sum"),
                  F.sum(F.round(F.col("l_discount") * 100).cast("long")).alias("disc_sum")))
    nation = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, folder, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region_name"))
    customer = (table(spark, folder, "customer")
                .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
                .join(region, "n_regionkey")
                .select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"),
                        "region_name", F.col("c_acctbal").alias("acctbal")))
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), "o_custkey", F.col("o_orderpriority").alias("priority"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority_ord"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("totalprice"))
    # The lines are aggregated by order. The explicit repartition is the exchange
    # a sort-merge join with them needs anyway; where the lines are small enough
    # to be broadcast it keeps the orders, not the customers, spread over the tasks.
    joined = orders.join(customer, "o_custkey").repartition("id").join(lines, "id", "left")
    return (joined.withColumn("_z", _signal())
            .withColumn("y", (keyed_uniform("y", F.col("id")) < _logistic(F.col("_z"))).cast("int"))
            .select("id", "segment", "priority", "priority_ord", "status", "region_name",
                    "acctbal", "totalprice", "n_lines", "qty_sum", "disc_sum", "y", "_z"))


def scored_orders(spark: SparkSession, folder: str) -> DataFrame:
    def score(salt: str, noise: float) -> Column:
        return F.round(_logistic(F.col("_z") + F.lit(noise) * (keyed_uniform(salt, F.col("id")) - 0.5)), 4)

    return (order_survey(spark, folder)
            .withColumn("score_a", score("a", 2.0)).withColumn("score_b", score("b", 4.0))
            .withColumn("pred_a", (F.col("score_a") >= 0.5).cast("int"))
            .withColumn("pred_b", (F.col("score_b") >= 0.5).cast("int"))
            .drop("_z"))


def sampled_orders(spark: SparkSession, folder: str, folds: bool = True, split: bool = True,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """``columns``: those a query needs beside the key and the class; only they are stored."""
    from riskframe.operators.sampling import stratified_folds, stratified_split

    scored = scored_orders(spark, folder)
    rows = store(scored if columns is None else scored.select(*dict.fromkeys(["id", "y", *columns])), "scored")
    if folds:
        rows = stratified_folds(rows, "id", ["y"], folds=5, salt="fold")
    return stratified_split(rows, "id", ["y"], test_fraction=0.2, salt="split") if split else rows


def doc_labels(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    emb = table(spark, folder, "embeddings")
    return emb.withColumn("embedding", F.col("embedding").cast("array<double>"))


def stored_survey(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Columns of the scored survey, written once for operators that read their input more than once."""
    return store(scored_orders(spark, folder).select(*columns), "survey")


def _signal() -> Column:
    return (0.9 * (F.col("priority_ord") - 3) + 0.02 * (F.coalesce("qty_sum", F.lit(100)) - 100)
            - 0.0002 * F.col("acctbal") + F.when(F.col("status") == "F", 0.8).otherwise(0.0))


def _logistic(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def feature_spec():
    """Roles of the survey columns in the modelling table."""
    from riskframe.operators.features import FeatureSpec

    return FeatureSpec(
        numeric=["acctbal", "totalprice", "n_lines", "qty_sum", "disc_sum"],
        ordinal={"priority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]},
        one_hot=["segment", "status", "region_name"],
        interactions={"qty_x_priority": ("qty_sum", "priority")},
        fill={"n_lines": 0, "qty_sum": 100, "disc_sum": 0})


FEATURE_COLUMNS = ["priority", "acctbal", "totalprice", "n_lines", "qty_sum", "disc_sum", "segment", "status", "region_name"]


def modelling_table(spark: SparkSession, folder: str, folds: bool = True):
    """(stored table with a ``features`` vector, fitted preparation); a folder per split and, if drawn, per fold."""
    from riskframe.operators.features import fit_features

    rows = store(sampled_orders(spark, folder, folds=folds, columns=FEATURE_COLUMNS), "split", ["split"], ROW_GROUP)
    fitted = fit_features(rows.filter("split = 'train'"), feature_spec())
    parts = ["split", "fold"] if folds else ["split"]
    prepared = fitted.transform(rows).select("id", "y", "features", *parts)
    return store(prepared, "model", parts, ROW_GROUP), fitted


def fold_scores(spark: SparkSession, folder: str) -> DataFrame:
    """(model, id, fold, y, pred, score) of three scored models over the five folds."""
    rows = sampled_orders(spark, folder, split=False, columns=["score_a", "score_b", "pred_a", "pred_b"])
    both = F.round((F.col("score_a") + F.col("score_b")) / 2, 6)
    models = F.array(
        F.struct(F.lit("model_a").alias("model"), F.col("pred_a").alias("pred"), F.col("score_a").alias("score")),
        F.struct(F.lit("model_b").alias("model"), F.col("pred_b").alias("pred"), F.col("score_b").alias("score")),
        F.struct(F.lit("model_c").alias("model"), (both >= 0.5).cast("int").alias("pred"), both.alias("score")))
    return rows.select("id", "fold", "y", F.inline(models))
