"""Model-comparison queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.catalog.base import SAMPLED, SCORED, chain, rates
from riskframe.catalog.training import FOLDS
from riskframe.operators import profile as pr, significance as sg, training as tr
from riskframe.plans.bindings import fold_scores, scored_orders, stored_survey
from riskframe.plans.storage import store


REPLICATES = 1_000


def _folds(spark, sf):
    """A row per (model, fold)."""
    return store(tr.fold_metrics(fold_scores(spark, sf), with_auc=False).select("model", "fold", "f1_macro"), "folds")


def sig_mcnemar(spark, sf):
    rows = sg.mcnemar(scored_orders(spark, sf), "y", "pred_a", "pred_b")
    return rows.withColumns({c: F.round(c, 6) for c in ("statistic", "p_value")})


def sig_model_rank(spark, sf):
    return sg.model_ranking(_folds(spark, sf))


def sig_paired_t(spark, sf):
    return sg.paired_t(sg.pair_with_best(_folds(spark, sf)), 5)


def sig_wilcoxon(spark, sf):
    return sg.wilcoxon(sg.pair_with_best(_folds(spark, sf)))


def sig_bootstrap(spark, sf):
    return sg.confidence_interval(sg.bootstrap_replicates(scored_orders(spark, sf), "y", "pred_a", REPLICATES, key="id"))


def sig_bootstrap_auc(spark, sf):
    """Interval of the ranking metric, tie-exact in every replicate."""
    df = stored_survey(spark, sf, "id", "y", "pred_a", "score_a")
    drawn = sg.bootstrap_replicates(df, "y", "pred_a", REPLICATES, metrics=["accuracy"], score="score_a", key="id")
    return sg.confidence_interval(drawn, "roc_auc")


def sig_bootstrap_multinomial(spark, sf):
    return sg.confidence_interval(sg.bootstrap_multinomial(scored_orders(spark, sf), "y", "pred_a", 1000))


def sig_fold_boxes(spark, sf):
    return pr.box_stats(_folds(spark, sf), ["f1_macro"], ["model"])


QUERIES = {f.__name__: f for f in (sig_mcnemar, sig_model_rank, sig_paired_t, sig_wilcoxon, sig_bootstrap, sig_bootstrap_auc,
                                   sig_bootstrap_multinomial, sig_fold_boxes)}

_PAIRS = FOLDS + """,
avgs as (select model, avg(f1_macro) as m from fm group by model),
top as (select model as name_a from avgs order by m desc, model limit 1),
pairs as (select name_a, o.model as name_b, o.fold, b.f1_macro as a, o.f1_macro as b
  from top join fm b on b.model=name_a join fm o on o.fold=b.fold and o.model<>name_a)"""


def _poisson(u: str) -> str:
    import math

    below, term, arms = 0.0, math.exp(-1.0), []
    for k in range(13):
        below += term
        arms.append(f"when {u}<{below!r}::DOUBLE then {k}")
        term /= k + 1
    return "case " + " ".join(arms) + " else 13 end"


def _weighted(y: int, p: int) -> str:
    return f"sum(w) filter (where y={y} and pred_a={p})"


ORACLE = {
    # The tail is integrated numerically, independent of the error function.
    "sig_mcnemar": chain(SCORED, """
        cells as (select count(*) filter (where pred_a=y and pred_b=y) as both_right, count(*) filter (where pred_a=y and pred_b<>y) as only_a,
          count(*) filter (where pred_a<>y and pred_b=y) as only_b, count(*) filter (where pred_a<>y and pred_b<>y) as both_wrong from scored),
        st as (select *, (abs(only_a-only_b)-1)*(abs(only_a-only_b)-1)/(only_a+only_b)::DOUBLE as s from cells)""", """
        select both_right, only_a, only_b, both_wrong, round(s,6) as statistic,
          round((select sum(2*exp(-0.5*pow(sqrt(s)+(i+0.5)*0.0005,2))/sqrt(2*pi())*0.0005) from range(0,24000) r(i)),6) as p_value from st"""),
    "sig_model_rank": chain(SAMPLED, FOLDS, """
        select model, round(avg(f1_macro),6) as "mean", cast(row_number() over (order by round(avg(f1_macro),6) desc, model) as int) as place
        from fm group by model"""),
    "sig_paired_t": chain(SAMPLED, _PAIRS + """,
        tt as (select name_a, name_b, avg(a) as ma, avg(b) as mb, avg(a-b)/(stddev_samp(a-b)/sqrt(5.0::DOUBLE)) as t
          from pairs group by name_a, name_b)""", """
        select name_a, name_b, round(ma,6) as mean_a, round(mb,6) as mean_b, round(t,6) as t_stat,
          round(1 - 2*(0.375::DOUBLE*(abs(t)/sqrt(1+t*t/4))*(1-t*t/(12*(1+t*t/4)))),6) as p_value from tt"""),
    "sig_wilcoxon": chain(SAMPLED, _PAIRS + """,
        dd as (select name_a, name_b, round(a-b,12) as d from pairs where round(a-b,12)<>0),
        rr as (select *, rank() over (partition by name_a, name_b order by abs(d)) as r,
             row_number() over (partition by name_a, name_b order by abs(d)) as pos, count(*) over (partition by name_a, name_b) as n from dd),
        ws as (select name_a, name_b, max(n) as n, least(coalesce(sum(r) filter (where d>0),0), coalesce(sum(r) filter (where d<0),0))::DOUBLE as w
          from rr group by name_a, name_b),
        signs as (select name_a, name_b, s, sum(case when (s >> (pos-1)) & 1 = 1 then r else 0 end) as total
          from rr, range(0,32) q(s) where s < (1 << n) group by name_a, name_b, s)""", """
        select ws.name_a, ws.name_b, w, n, round(least(1.0::DOUBLE, 2*count(*) filter (where total<=w)/pow(2.0::DOUBLE,n)),6) as p_value,
          'exact' as p_method
        from ws join signs on signs.name_a=ws.name_a and signs.name_b=ws.name_b group by ws.name_a, ws.name_b, w, n"""),
    "sig_bootstrap": chain(SCORED, f"""
        drawn as (select i, y, pred_a, {_poisson("('0x'||substr(md5(concat('boot:',id,'/',i)),1,8))::BIGINT/4294967296.0::DOUBLE")} as w
          from scored, range(1,{REPLICATES + 1}) r(i)),
        bc as (select i, {_weighted(1, 1)} as tp, {_weighted(0, 1)} as fp, {_weighted(1, 0)} as fn, {_weighted(0, 0)} as tn from drawn group by i),
        bm as (select i, {rates()['f1_macro']} as f from bc)""", """
        select round(avg(f),6) as "mean", round(quantile_cont(f,0.025),6) as lower, round(quantile_cont(f,0.975),6) as upper,
          count(*) as n_bootstrap from bm"""),
    "sig_bootstrap_auc": chain(SCORED, f"""
        drawn as (select i, y, score_a as s, {_poisson("('0x'||substr(md5(concat('boot:',id,'/',i)),1,8))::BIGINT/4294967296.0::DOUBLE")} as w
          from scored, range(1,{REPLICATES + 1}) r(i)),
        sides as (select i, s, coalesce(sum(w) filter (where y=1),0) as pos, coalesce(sum(w) filter (where y=0),0) as neg from drawn group by i, s),
        run as (select *, sum(neg) over (partition by i order by s) - neg*0.5::DOUBLE as below from sides),
        auc as (select i, sum(pos*below)/(sum(pos)::DOUBLE*sum(neg)) as f from run group by i)""", """
        select round(avg(f),6) as "mean", round(quantile_cont(f,0.025),6) as lower, round(quantile_cont(f,0.975),6) as upper,
          count(*) as n_bootstrap from auc"""),
    "sig_fold_boxes": chain(SAMPLED, FOLDS, """
        select 'f1_macro' as "column", model, n, round(a,6) as q1, round(m,6) as median, round(b,6) as q3,
          round(a-1.5::DOUBLE*(b-a),6) as fence_low, round(b+1.5::DOUBLE*(b-a),6) as fence_high,
          round(min(f1_macro) filter (where f1_macro between a-1.5::DOUBLE*(b-a) and b+1.5::DOUBLE*(b-a)),6) as whisker_low,
          round(max(f1_macro) filter (where f1_macro between a-1.5::DOUBLE*(b-a) and b+1.5::DOUBLE*(b-a)),6) as whisker_high,
          count(*) filter (where f1_macro<a-1.5::DOUBLE*(b-a) or f1_macro>b+1.5::DOUBLE*(b-a)) as outliers
        from fm join (select model, count(*) as n, quantile_cont(f1_macro,0.25) as a, quantile_cont(f1_macro,0.5) as m,
          quantile_cont(f1_macro,0.75) as b from fm group by model) using (model) group by model, n, a, m, b"""),
}
