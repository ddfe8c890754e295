"""Learners and explanations on the planted model."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.operators import explanation as ex, features as fe, significance as sg, training as tr
from riskframe.plans.bindings import modelling_table
from riskframe.plans.storage import fresh_path
from riskframe.sources import delimited, models, runs


@pytest.fixture(scope="module")
def table(spark, sf):
    return modelling_table(spark, sf)


@pytest.fixture(scope="module")
def parts(table):
    rows, _ = table
    return rows.filter("split = 'train'"), rows.filter("split = 'test'")


@pytest.fixture(scope="module")
def fitted(parts):
    return tr.fit(tr.lr(), parts[0])


def test_preparation_is_fitted_on_training_rows_only(spark):
    spec = fe.FeatureSpec(numeric=["x"], one_hot=["c"], ordinal={"o": ["lo", "hi"]}, fill={"x": 0.0})
    train = spark.createDataFrame([(0.0, "a", "lo"), (10.0, "b", "hi")], "x double, c string, o string")
    other = spark.createDataFrame([(20.0, "z", "odd"), (None, "a'", "hi")], "x double, c string, o string")
    prepared = fe.fit_features(train, spec)
    assert prepared.names == ["x", "c_a", "c_b", "o"]
    got = [list(r[0]) for r in prepared.transform(other).select("features").collect()]
    assert got == [[2.0, 0.0, 0.0, 3.0], [0.0, 0.0, 0.0, 2.0]]


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert fe.fit_min_max(df, ["x"]) == {"x": (5.0, 5.0)}
    assert {r[0] for r in df.select(fe.min_max(F.col("x"), 5.0, 5.0)).collect()} == {0.0}


def test_logistic_regression_probability_is_the_logistic_of_the_margin(parts, fitted):
    beta, bias = fitted.coefficients.toArray(), fitted.intercept
    for r in tr.score(fitted, parts[1]).limit(20).collect():
        margin = float(np.dot(beta, r["features"].toArray())) + bias
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-9)


def test_weights_balance_the_classes(parts):
    sums = tr.with_balanced_weights(parts[0]).groupBy("y").agg(F.sum("weight").alias("w")).collect()
    assert sums[0]["w"] == pytest.approx(sums[1]["w"])


def test_out_of_fold_scores_every_row_once(parts):
    scored = tr.out_of_fold(parts[0], [tr.tree()])
    assert scored.count() == parts[0].count() == scored.select("id").distinct().count()
    summary = tr.summarise_folds(tr.fold_metrics(scored)).first()
    assert 0.6 < summary["roc_auc_mean"] < 1 and summary["f1_macro_std"] < 0.1


def test_search_orders_candidates(parts):
    results = tr.search(parts[0], "LogisticRegression", [{"C": 1e-6}, {"C": 1.0}])
    assert results.filter("place = 1").first()["params"] == '{"C": 1.0}'
    assert tr.refit_best(parts[0], results).coefficients.size == 20


def test_candidates_are_spread_and_fixed():
    first = tr.log_uniform(30)
    assert first == tr.log_uniform(30) and len(first) == 30
    assert all(0.001 <= c["C"] <= 100 for c in first)


def test_elimination_keeps_the_planted_signal(table, parts):
    ranks = fe.recursive_elimination(tr.with_balanced_weights(parts[0]), table[1].names, 6, weight="weight").collect()
    kept = {r["feature"] for r in ranks if r["kept"]}
    assert len(kept) == 6 and "qty_sum" in kept and sorted({r["rank"] for r in ranks}) == list(range(1, 16))


def test_pca_and_svd_shares(parts):
    shares = [r["ratio"] for r in fe.pca_variance(parts[0]).orderBy("component").collect()]
    assert sum(shares) == pytest.approx(1) and shares == sorted(shares, reverse=True)
    x = np.array([r[0].toArray() for r in parts[0].select("features").collect()])
    _, singular, _ = fe.truncated_svd(parts[0])
    assert singular == pytest.approx(np.linalg.svd(x, compute_uv=False)[:10], rel=1e-6)


def test_linear_contributions_add_up(spark, parts, fitted, table):
    names = table[1].names
    values = vector_to_array("features")
    wide = parts[0].select("id", *[F.get(values, F.lit(i)).alias(n) for i, n in enumerate(names)])
    weights = dict(zip(names, fitted.coefficients.toArray()))
    means = ex.feature_means(wide, names)
    base = ex.base_value(fitted.intercept, weights, means)
    sums = ex.linear_contributions(wide, ["id"], weights, means).groupBy("id").agg(F.sum("phi").alias("s"))
    margin = tr.score(fitted, parts[0]).select("id", F.ln(F.col("score") / (1 - F.col("score"))).alias("m"))
    gap = sums.join(margin, "id").agg(F.max(F.abs(F.col("s") + F.lit(base) - F.col("m")))).first()[0]
    assert gap < 1e-6


def test_permutation_finds_signal_and_not_noise(table, parts, fitted):
    rows = {r["feature"]: r["importance"]
            for r in ex.permutation_importance(parts[0], fitted, table[1].names, repeats=3).collect()}
    assert rows["priority"] > 0.05 and abs(rows["region_name_ASIA"]) < 0.02


def test_surrogate_agrees_with_the_linear_model(table, parts, fitted):
    chosen = ex.first_of_outcomes(tr.score(fitted, parts[1]), "id", {"TP": 3, "FN": 2})
    assert {r["outcome"]: r["count"] for r in chosen.groupBy("outcome").count().collect()} == {"TP": 3, "FN": 2}
    bins = ex.quartile_bins(parts[0], table[1].names)
    got = ex.local_surrogates(chosen, fitted, bins, table[1].names, draws=400).collect()
    values = {r["id"]: r["features"].toArray() for r in chosen.select("id", "features").collect()}
    i = table[1].names.index("priority")
    beta = fitted.coefficients[i]
    for r in got:  # an extreme value pushes the way its contribution does
        if r["feature"] == "priority" and values[r["instance_id"]][i] in (1.0, 5.0):
            assert np.sign(r["weight"]) == np.sign(beta * (values[r["instance_id"]][i] - 3))


def test_counterfactual_against_brute_force(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(50, 2))
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    got = ex.nearest_counterfactuals(df.filter("id < 3"), df.filter("id >= 3"), "id", ["a", "b"])
    for i in range(3):
        want = 3 + int(np.argmin(((x[3:] - x[i]) ** 2).sum(axis=1)))
        assert got.filter(f"instance_id = {i}").first()["pool_id"] == want
    assert ex.meaningful_deltas(got, ["a", "b"]).filter("abs(delta) <= 0.01").count() == 0


def test_model_round_trip(spark, table, parts, fitted, sf):
    path = fresh_path(spark, "model")
    models.save_model(spark, path, table[1], fitted)
    prepared, model = models.load_model(spark, path)
    assert prepared.names == table[1].names
    assert list(model.coefficients) == list(fitted.coefficients)


def test_run_log(spark):
    path = fresh_path(spark, "runs")
    from datetime import datetime

    runs.log_run(spark, path, "a", {"C": 1}, {"f1": 0.5}, 1.0, datetime(2024, 1, 1))
    newest = runs.log_run(spark, path, "a", {"C": 2}, {"f1": 0.4}, 1.0, datetime(2024, 1, 2))
    log = runs.read_runs(spark, path)
    assert [r["run_id"] for r in runs.latest_runs(log).collect()] == [newest]
    assert runs.best_run(log, "f1").first()["params"] == {"C": "1"}


def test_delimited_missing_texts(spark):
    path = fresh_path(spark, "text")
    spark.createDataFrame([("a,1\nNA,2\nx,NaN\n\"q,\"\"r\",4",)], "value string").selectExpr(
        "explode(split(concat('c,n\\n', value), '\\n')) as value").coalesce(1).write.text(path)
    rows = delimited.read_delimited(spark, path, "c string, n double").collect()
    assert [tuple(r) for r in rows] == [("a", 1.0), (None, 2.0), ("x", None), ('q,"r', 4.0)]


def test_multinomial_bootstrap(spark):
    df = spark.range(400).select((F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 5 > 1).cast("int").alias("pred"))
    reps = sg.bootstrap_multinomial(df, "y", "pred", 200)
    assert {r["n"] for r in reps.collect()} == {400}
    ci = sg.confidence_interval(reps).first()
    assert ci["lower"] < ci["mean"] < ci["upper"] and ci["n_bootstrap"] == 200
    again = sg.confidence_interval(sg.bootstrap_multinomial(df.repartition(3), "y", "pred", 200)).first()
    assert ci == again


def written(spark, text):
    path = fresh_path(spark, "text")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    return path


def test_types_are_found_after_missing_texts_go(spark):
    path = written(spark, "n,x,b,s,e\n1,1.5,true,a,NA\nNA,NaN,False,1,\n3,2,,b,null")
    df = delimited.read_delimited(spark, path)
    assert dict(df.dtypes) == {"n": "bigint", "x": "double", "b": "boolean", "s": "string", "e": "string"}
    assert [tuple(r) for r in df.collect()] == [(1, 1.5, True, "a", None), (None, None, False, "1", None), (3, 2.0, None, "b", None)]


def test_line_breaks_in_cells(spark):
    df = spark.createDataFrame([(1, "two\nlines"), (2, 'a "quoted", cell')], "id long, t string")
    path = fresh_path(spark, "text")
    delimited.write_delimited(df, path)
    back = delimited.read_delimited(spark, path, "id long, t string", line_breaks=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(Exception):
        delimited.read_delimited(spark, path, "id long, t string").collect()


def test_logistic_regression_is_at_its_optimum(parts, fitted):
    """The gradient of the penalised, balanced loss vanishes."""
    rows = tr.with_balanced_weights(parts[0]).select("features", "y", "weight").collect()
    x = np.array([r["features"].toArray() for r in rows])
    y, w = np.array([r["y"] for r in rows]), np.array([r["weight"] for r in rows])
    beta = fitted.coefficients.toArray()
    error = w * (1 / (1 + np.exp(-(x @ beta + fitted.intercept))) - y)
    assert np.abs(x.T @ error + beta).max() / len(y) < 1e-4 and abs(error.sum()) / len(y) < 1e-4


@pytest.mark.parametrize("learner", [tr.tree(), tr.forest(10, 5), tr.boosted(5, depth=3), tr.linear_svm(max_iter=20),
                                     tr.network((8,), 30)], ids=lambda m: m.name)
def test_learners_beat_the_base_rate(parts, learner):
    scored = tr.score(tr.fit(learner, parts[0]), parts[1])
    right, base = scored.agg(F.avg((F.col("pred") == F.col("y")).cast("double")), F.avg(F.col("y").cast("double"))).first()
    assert right > max(base, 1 - base) + 0.03


def test_counts_of_training_parts(parts):
    counts = tr.fold_counts(parts[0])
    for i in (0, 3):
        assert counts[i] == tr.class_counts(parts[0].filter(F.col("fold") != i))


def test_learning_curve_sizes_are_exact(parts):
    rows = tr.learning_curve(parts[0], tr.tree(3), [0.25, 1.0], folds=2, parallelism=4).orderBy("size").collect()
    sizes = [parts[0].filter(F.col("fold") != i).count() for i in range(2)]
    assert rows[0]["train_rows"] == pytest.approx(sum(n // 4 for n in sizes) / 2, abs=0.1)
    assert rows[1]["train_rows"] == pytest.approx(sum(sizes) / 2, abs=0.1) and rows[0]["train_mean"] > 0.5


def test_seed_refits(parts):
    got = tr.seed_refits(parts[0].filter("id % 4 = 0"), tr.lr(0.1, max_iter=20), [0, 7], folds=2).orderBy("seed").collect()
    assert [r["seed"] for r in got] == [0, 7] and all(0.5 < r["f1_min"] <= r["f1_max"] < 1 for r in got)


def test_study(spark, table, parts):
    from datetime import datetime

    from riskframe.operators.study import run_study

    learners = [tr.lr(0.1, max_iter=30), tr.tree(4)]
    log = fresh_path(spark, "study")
    study = run_study(parts[0], table[1].names, learners, {"LogisticRegression": [{"C": 0.01}, {"C": 1.0}], "DecisionTree": []},
                      log, datetime(2024, 1, 1), keep=15)
    places = study.comparison.orderBy("place").collect()
    assert {r["model"] for r in places} == {"LogisticRegression", "DecisionTree", "Stacking"} and places[0]["best"]
    assert study.selected.filter("kept").count() == 15
    if places[0]["model"] == "LogisticRegression" or places[1]["model"] == "LogisticRegression":
        assert study.tuned.count() in (0, 2)
    assert {r["conclusion"] for r in study.significance.collect()} <= {"significant difference", "no significant difference"}
    logged = {r["run_name"]: r for r in runs.read_runs(spark, log).collect()}
    assert logged["DecisionTree"]["params"] == {"max_depth": "4"} and all(r["train_time_s"] > 0 for r in logged.values())
    assert {"f1_macro_mean", "roc_auc_std"} <= set(logged["Stacking"]["metrics"])


def test_radial_search(parts):
    x = np.array([r[0].toArray() for r in parts[0].select("features").collect()])
    assert tr.radial_width(parts[0], "scale") == pytest.approx(1 / (x.shape[1] * x.var()))
    assert tr.radial_width(parts[0], "auto") == 1 / x.shape[1] and tr.radial_width(parts[0], 0.5) == 0.5
    got = tr.radial_search(parts[0].filter("id % 4 = 0"), [1.0], ["scale", "auto"], folds=2).collect()
    assert sorted(r["place"] for r in got) == [1, 2] and all(0.5 < r["f1_macro_mean"] < 1 for r in got)


def test_registered_study_has_every_learner(monkeypatch):
    from types import SimpleNamespace

    from riskframe.catalog import training as catalog

    seen = []
    monkeypatch.setattr(catalog, "_parts", lambda *a, **b: (None, None, SimpleNamespace(names=["x"])))
    monkeypatch.setattr(catalog, "fresh_path", lambda *a: "log")
    monkeypatch.setattr(catalog, "run_study", lambda table, names, learners, *a, **b: seen.append(learners))
    monkeypatch.setattr(catalog.tr, "out_of_fold", lambda table, learners: seen.append(learners))
    for name in ("fold_metrics", "summarise_folds", "compare_models"):
        monkeypatch.setattr(catalog.tr, name, lambda rows: rows)
    catalog._study(None, None)
    catalog.model_cross_validated(None, None)
    every = {"LogisticRegression", "DecisionTree", "RandomForest", "GradientBoosting", "LeafwiseBoosting", "LinearSVM", "NeuralNetwork"}
    assert [{m.name for m in learners} for learners in seen] == [every, every]
