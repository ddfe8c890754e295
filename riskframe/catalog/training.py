"""Training, tuning and scoring queries."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from riskframe.catalog.base import SAMPLED, chain, counts, rates, scored
from riskframe.operators import sampling, training as tr
from riskframe.operators.study import run_study
from riskframe.plans.bindings import (FEATURE_COLUMNS, feature_spec, fold_scores, modelling_table, order_survey, sampled_orders,
                                      scored_orders)
from riskframe.plans.storage import ROW_GROUP, fresh_path, store
from riskframe.sources import runs

# The fold seeds of the sensitivity check.
SEEDS = [0, 7, 21, 42, 99, 123, 256, 512, 1337, 2024]
FOREST, BOOSTED, LEAFWISE = tr.forest(), tr.boosted(), tr.leafwise()


def learners(C: float = 1.0) -> list[tr.Learner]:
    """Every learner of the operators; ``C`` is the logistic regression's."""
    return [tr.lr(C), tr.tree(), FOREST, BOOSTED, LEAFWISE, tr.linear_svm(), tr.network()]


DEFAULTS = {"segment": "BUILDING", "status": "O", "priority": "3-MEDIUM", "region_name": "ASIA",
            "acctbal": 4500.0, "totalprice": 150000.0, "n_lines": 4, "qty_sum": 100, "disc_sum": 20}


def _parts(spark, sf, folds=True):
    table, fitted = modelling_table(spark, sf, folds)
    return table.filter("split = 'train'"), table.filter("split = 'test'"), fitted


def model_class_weights(spark, sf):
    return tr.class_weights(order_survey(spark, sf), "y")


def _fold_summary(spark, sf):
    return tr.summarise_folds(tr.fold_metrics(fold_scores(spark, sf)))


def cv_fold_metrics(spark, sf):
    return _fold_summary(spark, sf)


def model_comparison(spark, sf):
    best = tr.compare_models(tr.summarise_folds(tr.fold_metrics(fold_scores(spark, sf), with_auc=False),
                                                metrics=tr.FOLD_METRICS))
    return best.select("model", "f1_macro_mean", "accuracy_mean", "place", "best")


def model_comparison_long(spark, sf):
    summary = tr.summarise_folds(tr.fold_metrics(fold_scores(spark, sf), with_auc=False), metrics=tr.FOLD_METRICS)
    return tr.melt_comparison(summary, ["f1_macro", "accuracy"])


def cv_seed_sensitivity(spark, sf):
    rows = store(scored_orders(spark, sf).select("id", "y", "pred_a"), "rows")
    return tr.seed_sensitivity(rows, SEEDS, pred="pred_a")


def cv_seed_refits(spark, sf):
    """A logistic regression fitted anew for every seed and fold."""
    train, _, _ = _parts(spark, sf, folds=False)
    return tr.seed_refits(train, tr.lr(0.1), SEEDS, parallelism=8)


def score_risk_bands(spark, sf):
    banded = tr.band_scores(scored_orders(spark, sf), "score_a")
    return banded.groupBy("label", "band").agg(F.count(F.lit(1)).alias("n"),
                                               F.round(F.avg("score_a"), 6).alias("mean_score"))


def score_profile_batch(spark, sf):
    from riskframe.operators.features import fit_features

    rows = store(sampled_orders(spark, sf, folds=False, columns=FEATURE_COLUMNS), "split", ["split"])
    prepared = fit_features(rows.filter("split = 'train'"), feature_spec())
    train = store(prepared.transform(rows.filter("split = 'train'")).select("y", "features"), "train")
    model = tr.fit(tr.lr(), train)
    profiles = rows.filter("split = 'test'").select("id", "segment", "status", "priority", "acctbal", "qty_sum")
    return tr.score_profiles(prepared, model, profiles, DEFAULTS, ["id"])


def model_logistic(spark, sf):
    train, _, _ = _parts(spark, sf)
    return tr.summarise_folds(tr.fold_metrics(tr.out_of_fold(train, [tr.lr()])))


def _held(spark, sf, learner):
    train, test, _ = _parts(spark, sf, folds=False)
    return tr.held_out({learner.name: tr.fit(learner, train)}, test)


def model_tree(spark, sf):
    return _held(spark, sf, tr.tree())


def model_forest(spark, sf):
    return _held(spark, sf, FOREST)


def model_boosted(spark, sf):
    return _held(spark, sf, BOOSTED)


def model_leafwise(spark, sf):
    return _held(spark, sf, LEAFWISE)


def model_svm(spark, sf):
    train, test, fitted = _parts(spark, sf, folds=False)
    gamma = 1.0 / len(fitted.names)
    waves = store(tr.fourier_features(train, gamma).select("y", "fourier"), "fourier", row_group=ROW_GROUP)
    model = tr.fit(tr.linear_svm(name="RadialSVM"), waves, "fourier")
    return tr.held_out({"RadialSVM": model}, tr.fourier_features(test, gamma))


def model_network(spark, sf):
    return _held(spark, sf, tr.network())


def model_cross_validated(spark, sf):
    train, _, _ = _parts(spark, sf)
    scored_rows = tr.out_of_fold(train, learners())
    return tr.compare_models(tr.summarise_folds(tr.fold_metrics(scored_rows)))


def model_grid_search(spark, sf):
    train, _, _ = _parts(spark, sf)
    return tr.search(train, "LogisticRegression", tr.grid("LogisticRegression"))


def model_radial_search(spark, sf):
    train, _, _ = _parts(spark, sf)
    return tr.radial_search(train, tr.GRIDS["LinearSVM"]["C"], ["scale", "auto"], parallelism=8)


def model_log_uniform_search(spark, sf):
    train, _, _ = _parts(spark, sf)
    return tr.search(train, "LogisticRegression", tr.log_uniform(30), parallelism=8)


def model_sequential_search(spark, sf):
    """30 strengths, each round proposed from what the rounds before have shown."""
    train, _, _ = _parts(spark, sf)
    return tr.sequential_search(train)


def bases() -> list[tr.Learner]:
    """The learners that are stacked."""
    return [tr.lr(0.1), FOREST, BOOSTED, LEAFWISE]


def model_stacking(spark, sf):
    train, test, _ = _parts(spark, sf)
    return tr.stack(train, test, bases())


def _study(spark, sf):
    train, _, fitted = _parts(spark, sf)
    grids = {family: tr.grid(family) for family in tr.GRIDS}
    return run_study(train, fitted.names, learners(0.1), grids, fresh_path(spark, "study"),
                     datetime(2024, 1, 1, tzinfo=timezone.utc), parallelism=8, bases=bases())


def model_study(spark, sf):
    """Learners on the selected features and their stack, cross-validated, best first."""
    return _study(spark, sf).comparison


def model_study_log(spark, sf):
    """The run log of a study: settings, seconds and metrics of every model."""
    return runs.latest_runs(runs.read_runs(spark, _study(spark, sf).log)).select(
        "run_name", "params", "metrics", "train_time_s")


def sig_trained_models(spark, sf):
    """The best trained model against every other."""
    return _study(spark, sf).significance


def model_capped_cv(spark, sf):
    """Cross-validated radial classifier on a bounded sample: max(5000, half the training rows), in three folds."""
    train, _, fitted = _parts(spark, sf, folds=False)
    sample = sampling.capped_folds(train.select("id", "y", "features"), "id", ["y"], floor_rows=5000, fraction=0.5, folds=3)
    waves = tr.fourier_features(sample, 1.0 / len(fitted.names))
    rows = store(waves.select("id", "y", "fourier", "fold"), "capped", ["fold"], ROW_GROUP)
    return tr.summarise_folds(tr.fold_metrics(tr.out_of_fold(rows, [tr.linear_svm(name="RadialSVM")], features="fourier", folds=3)))


def score_profile_linear(spark, sf):
    """Profiles with missing cells through fixed weights, with label and band."""
    profiles = order_survey(spark, sf).select("id", "priority_ord", F.when(F.col("n_lines") > 2, F.col("qty_sum")).alias("qty_sum"))
    filled = tr.fill_profile(profiles, {"qty_sum": 100, "acctbal": 4500.0})
    margin = 0.9 * (F.col("priority_ord") - 3) + 0.02 * (F.col("qty_sum") - 100) - 0.0002 * F.col("acctbal")
    return tr.band_scores(filled.withColumn("score", F.round(1 / (1 + F.exp(-margin)), 6))).select("id", "score", "label", "band")


def sample_learning_curve(spark, sf):
    train, _, _ = _parts(spark, sf)
    return tr.learning_curve(train, tr.lr(), [i / 10 for i in range(1, 11)], parallelism=8)


def sample_progressive_fit(spark, sf):
    train, test, _ = _parts(spark, sf, folds=False)
    return tr.progressive_fit(train, test, tr.lr(), [0.2, 0.4, 0.6, 0.8, 1.0])


def sample_strategies(spark, sf):
    train, test, _ = _parts(spark, sf, folds=False)
    return tr.compare_resampling(train, test, tr.lr())


QUERIES = {f.__name__: f for f in (
    model_class_weights, cv_fold_metrics, model_comparison, model_comparison_long, cv_seed_sensitivity,
    cv_seed_refits, score_risk_bands, score_profile_batch, model_logistic, model_tree, model_forest, model_boosted, model_leafwise, model_svm,
    model_network, model_study, model_study_log, sig_trained_models, model_capped_cv, score_profile_linear,
    model_cross_validated, model_grid_search, model_radial_search, model_log_uniform_search, model_sequential_search, model_stacking,
    sample_learning_curve, sample_progressive_fit, sample_strategies)}

_R = rates()
_LONG = """
long as (select 'model_a' as model, id, fold, y, pred_a as pred, score_a as score from sampled
  union all select 'model_b', id, fold, y, pred_b, score_b from sampled
  union all select 'model_c', id, fold, y, cast(case when round((score_a+score_b)/2,6)>=0.5::DOUBLE then 1 else 0 end as int),
    round((score_a+score_b)/2,6) from sampled)"""
FOLDS = _LONG + f""",
fc as (select model, fold, {counts('y', 'pred')} from long group by model, fold),
fr as (select model, fold, y, rank() over (partition by model, fold order by score)
    + (count(*) over (partition by model, fold, score)-1)/2.0::DOUBLE as r from long),
fa as (select model, fold, (sum(r) filter (where y=1) - count(*) filter (where y=1)*(count(*) filter (where y=1)+1)/2.0::DOUBLE)
    / ((count(*) filter (where y=1))::DOUBLE*count(*) filter (where y=0)) as roc_auc from fr group by model, fold),
fm as (select fc.model, fc.fold, {', '.join(f'{_R[m]} as {m}' for m in tr.FOLD_METRICS)}, roc_auc
  from fc join fa on fa.model=fc.model and fa.fold=fc.fold)"""
_MEANS = ", ".join(f"round(avg({m}),6) as {m}_mean, round(stddev_pop({m}),6) as {m}_std"
                   for m in [*tr.FOLD_METRICS, "roc_auc"])

ORACLE = {
    "score_profile_linear": scored("""
        select id, s as score, case when s>=0.5::DOUBLE then 'High Risk' else 'Low Risk' end as label,
          case when s>=0.75::DOUBLE then 'High risk' when s>=0.5::DOUBLE then 'Elevated risk'
               when s>=0.25::DOUBLE then 'Moderate-low risk' else 'Low risk' end as band
        from (select id, round(1/(1+exp(-(0.9::DOUBLE*(priority_ord-3)
          + 0.02::DOUBLE*(coalesce(case when n_lines>2 then qty_sum end,100)-100) - 0.0002::DOUBLE*4500))),6) as s from scored)"""),
    "model_class_weights": scored("""
        select y as class, count(*) as n, round((select count(*) from scored)/(2.0::DOUBLE*count(*)),6) as balanced_weight,
          case when y=1 then round((select count(*) from scored where y=0)/count(*)::DOUBLE,6) end as positive_weight
        from scored group by y"""),
    "cv_fold_metrics": chain(SAMPLED, FOLDS, f"select model, {_MEANS} from fm group by model"),
    "model_comparison": chain(SAMPLED, FOLDS, """
        select model, round(avg(f1_macro),6) as f1_macro_mean, round(avg(accuracy),6) as accuracy_mean,
          cast(row_number() over (order by round(avg(f1_macro),6) desc, model) as int) as place,
          row_number() over (order by round(avg(f1_macro),6) desc, model) = 1 as best from fm group by model"""),
    "model_comparison_long": chain(SAMPLED, FOLDS, """
        select model, 'f1_macro_mean' as metric, round(avg(f1_macro),6) as "value" from fm group by model
        union all select model, 'accuracy_mean', round(avg(accuracy),6) from fm group by model"""),
    "cv_seed_sensitivity": chain(SAMPLED, f"""
        seeds as (select unnest([{','.join(map(str, SEEDS))}]) as seed),
        af as (select seed, y, pred_a, floor((row_number() over (partition by seed, y order by
            ('0x'||substr(md5(concat(seed,':',id)),1,8))::BIGINT, id)-1)*5.0::DOUBLE/count(*) over (partition by seed, y)) as fold
          from scored, seeds),
        cc as (select seed, fold, {counts()} from af group by seed, fold),
        ff as (select seed, {_R['f1_macro']} as f from cc),
        ss as (select seed, avg(f) as m, stddev_pop(f) as s, min(f) as lo, max(f) as hi from ff group by seed)""", """
        select seed, round(m,6) as f1_mean, round(s,6) as f1_std, round(lo,6) as f1_min, round(hi,6) as f1_max,
          round(avg(m) over (),6) as overall_mean, round(stddev_samp(m) over (),6) as overall_std,
          round(max(m) over () - min(m) over (),6) as overall_range from ss"""),
    "score_risk_bands": scored("""
        select case when score_a>=0.5::DOUBLE then 'High Risk' else 'Low Risk' end as label,
          case when score_a>=0.75::DOUBLE then 'High risk' when score_a>=0.5::DOUBLE then 'Elevated risk'
               when score_a>=0.25::DOUBLE then 'Moderate-low risk' else 'Low risk' end as band,
          count(*) as n, round(avg(score_a),6) as mean_score from scored group by 1,2"""),
}

