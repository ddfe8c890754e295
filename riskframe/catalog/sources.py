"""Source and sink queries (A1-A5)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from riskframe.catalog.base import SAMPLED, chain, sampled, survey
from riskframe.catalog.training import FOLDS
from riskframe.operators import training as tr
from riskframe.plans.bindings import FEATURE_COLUMNS, feature_spec, fold_scores, order_survey, sampled_orders
from riskframe.plans.storage import fresh_path, store
from riskframe.sources import delimited, models, runs

COLUMNS = ["id", "segment", "priority", "status", "acctbal", "n_lines", "qty_sum", "y"]
DDL = ("id bigint, segment string, priority string, status string, acctbal double, n_lines bigint, "
       "qty_sum bigint, y int")


def scan_roundtrip(spark, sf):
    path = fresh_path(spark, "survey-csv")
    delimited.write_delimited(order_survey(spark, sf).select(*COLUMNS), path)
    back = delimited.read_delimited(spark, path, DDL)
    return back.groupBy("segment", "status").agg(
        F.count(F.lit(1)).alias("n"), F.count("qty_sum").alias("with_quantity"),
        F.sum("qty_sum").alias("quantity"), F.sum(F.round(F.col("acctbal") * 100).cast("long")).alias("cents"),
        F.sum("y").alias("positives"))


def scan_inferred(spark, sf):
    """Types are found although the numeric columns hold texts for missing cells."""
    path = fresh_path(spark, "survey-csv")
    rows = order_survey(spark, sf).withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(t))
                                                for c, t in (("n_lines", "NA"), ("qty_sum", "NaN"))})
    delimited.write_delimited(rows.select(*COLUMNS), path)
    back = delimited.read_delimited(spark, path)
    return back.groupBy("priority").agg(F.count("n_lines").alias("with_lines"),
                                        F.sum("n_lines").cast("long").alias("lines"))


def run_log(spark, sf):
    path = fresh_path(spark, "runs")
    folds = store(tr.fold_metrics(fold_scores(spark, sf), with_auc=False), "folds")
    for day in (1, 2):
        summary = tr.summarise_folds(folds.filter(F.col("fold") < 3 + day), metrics=tr.FOLD_METRICS)
        runs.log_summary(summary, path, datetime(2024, 1, day, tzinfo=timezone.utc),
                         {m: {"day": day} for m in ("model_a", "model_b", "model_c")}, {"model_a": 1.5 * day})
    latest = runs.latest_runs(runs.read_runs(spark, path))
    return latest.select("run_name", F.date_format("ts", "yyyy-MM-dd").alias("day"),
                         F.col("params")["day"].alias("day_param"), "train_time_s", F.explode("metrics").alias("metric", "value"))


def model_reload(spark, sf):
    from riskframe.operators.features import fit_features

    rows = store(sampled_orders(spark, sf, folds=False, columns=FEATURE_COLUMNS), "split", ["split"])
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    prepared = fit_features(train, feature_spec())
    model = tr.fit(tr.lr(), store(prepared.transform(train).select("y", "features"), "train"))
    path = fresh_path(spark, "model")
    models.save_model(spark, path, prepared, model)
    prepared2, model2 = models.load_model(spark, path)
    before = tr.score(model, prepared.transform(test)).select("id", F.col("score").alias("before"))
    after = tr.score(model2, prepared2.transform(test)).select("id", F.col("score").alias("after"))
    return before.join(after, "id").agg(F.count(F.lit(1)).alias("n"),
                                        F.max(F.abs(F.col("before") - F.col("after"))).alias("largest_gap"))


QUERIES = {f.__name__: f for f in (scan_roundtrip, scan_inferred, run_log, model_reload)}

ORACLE = {
    "run_log": chain(SAMPLED, FOLDS, " union all ".join(
        f"select model as run_name, '2024-01-02' as day, '2' as day_param, "
        f"case model when 'model_a' then 3::DOUBLE end as train_time_s, '{m}_{kind}' as metric, round({fn}({m}),6) as \"value\" "
        "from fm group by model" for m in tr.FOLD_METRICS
        for kind, fn in (("mean", "avg"), ("std", "stddev_pop")))),
    "model_reload": sampled("select count(*) as n, 0::DOUBLE as largest_gap from sampled where split='test'"),
    "scan_roundtrip": survey("""select segment, status, count(*) as n, count(qty_sum) as with_quantity,
        sum(qty_sum)::BIGINT as quantity, sum(cast(round(acctbal*100) as bigint))::BIGINT as cents,
        sum(y)::BIGINT as positives from survey group by segment, status"""),
    "scan_inferred": survey("""select priority, count(n_lines) as with_lines, sum(n_lines)::BIGINT as lines
        from survey group by priority"""),
}
