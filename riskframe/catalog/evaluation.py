"""Evaluation queries."""

from __future__ import annotations


from riskframe.catalog.base import SAMPLED, SCORED, chain, counts, metric_list, rates, scored
from riskframe.operators import evaluation as ev
from riskframe.plans.bindings import sampled_orders, scored_orders, stored_survey

FEATURES = ["acctbal", "totalprice", "n_lines", "qty_sum", "disc_sum"]
SEGMENTS = ["segment", "priority", "status"]


def eval_confusion(spark, sf):
    return ev.confusion_matrix(scored_orders(spark, sf), "y", "pred_a")


def eval_class_report(spark, sf):
    return ev.class_report(scored_orders(spark, sf), "y", "pred_a")


def eval_summary(spark, sf):
    return ev.summary_metrics(scored_orders(spark, sf), "y", "pred_a")


def eval_roc_points(spark, sf):
    return ev.roc_points(scored_orders(spark, sf), "y", "score_a")


def eval_roc_auc(spark, sf):
    long = (scored_orders(spark, sf).select("y", "score_a", "score_b")
            .unpivot(["y"], ["score_a", "score_b"], "model", "score"))
    return ev.roc_auc(long, "y", "score", ["model"])


def eval_pr_points(spark, sf):
    return ev.pr_points(scored_orders(spark, sf), "y", "score_a")


def eval_avg_precision(spark, sf):
    return ev.average_precision(scored_orders(spark, sf), "y", "score_a")


def eval_calibration(spark, sf):
    return ev.calibration(scored_orders(spark, sf), "y", "score_a")


def eval_threshold_sweep(spark, sf):
    return ev.threshold_sweep(scored_orders(spark, sf), "y", "score_a")


def eval_outcomes(spark, sf):
    return ev.outcome_shares(scored_orders(spark, sf), "y", "pred_a")


def eval_outcome_profile(spark, sf):
    return ev.outcome_profile(scored_orders(spark, sf), FEATURES, "y", "pred_a")


def eval_error_rates(spark, sf):
    return ev.error_rates(scored_orders(spark, sf), SEGMENTS, "y", "pred_a")


def eval_error_examples(spark, sf):
    return ev.error_examples(scored_orders(spark, sf), "id", ["segment", "priority", "qty_sum", "score_a"],
                             "y", "pred_a")


def eval_outcome_quartiles(spark, sf):
    return ev.outcome_quartiles(stored_survey(spark, sf, "y", "pred_a", *FEATURES), FEATURES, "y", "pred_a")


def eval_final_summary(spark, sf):
    return ev.final_summary(sampled_orders(spark, sf), "y", "pred_a", "score_a")


QUERIES = {f.__name__: f for f in (
    eval_confusion, eval_class_report, eval_summary, eval_roc_points, eval_roc_auc, eval_pr_points,
    eval_avg_precision, eval_calibration, eval_threshold_sweep, eval_outcomes, eval_outcome_profile,
    eval_error_rates, eval_error_examples, eval_outcome_quartiles, eval_final_summary)}

_R = rates()
_CELLS = f"cells as (select {counts()} from scored)"
_OUT = """outc as (select *, case when y=1 and pred_a=1 then 'TP' when y=0 and pred_a=0 then 'TN'
    when y=0 and pred_a=1 then 'FP' else 'FN' end as outcome from scored)"""
_CURVE = """
cnt as (select score_a as s, count(*) filter (where y=1) as pos, count(*) filter (where y=0) as neg from scored group by 1),
cur as (select s, pos, neg, sum(pos) over (order by s desc) as tp, sum(neg) over (order by s desc) as fp,
    sum(pos) over () as p, sum(neg) over () as n, row_number() over (order by s desc) as i, count(*) over () as k,
    lead(pos) over (order by s desc) as npos, lead(neg) over (order by s desc) as nneg from cnt)"""
_SWEEP = """
grid as (select i, case when i=79 then 0.95::DOUBLE else 0.05::DOUBLE+i*((0.95::DOUBLE-0.05::DOUBLE)/79) end as t
    from range(0,80) r(i)),
swept as (select i, t, count(*) filter (where y=1 and {score}>=t) as tp, count(*) filter (where y=0 and {score}>=t) as fp,
    count(*) filter (where y=1 and {score}<t) as fn, count(*) filter (where y=0 and {score}<t) as tn
    from grid, {table} group by i, t),
sweep as (select i, round(t,6) as threshold, round({p},6) as "precision", round({r},6) as recall, round({f},6) as f1,
    row_number() over (order by {f} desc, i) = 1 as best from swept)"""


def _weighted(kind: str) -> str:
    return f"({_R[kind + '_neg']}*(tn+fp) + {_R[kind + '_pos']}*(tp+fn))/(tp+fp+fn+tn)::DOUBLE"


def _report_row(label, p, r, f, support):
    return (f"select '{label}' as label, round({p},6) as \"precision\", round({r},6) as recall, "
            f"round({f},6) as f1, {support} as support from cells")


ORACLE = {
    "eval_confusion": scored("""
        select g.y, g.pred, count(s.id) as n from (select a.y, b.pred from (values (0),(1)) a(y), (values (0),(1)) b(pred)) g
        left join scored s on s.y=g.y and s.pred_a=g.pred group by g.y, g.pred"""),
    "eval_class_report": chain(SCORED, _CELLS, " union all ".join([
        _report_row("0", _R["precision_neg"], _R["recall_neg"], _R["f1_neg"], "tn+fp"),
        _report_row("1", _R["precision_pos"], _R["recall_pos"], _R["f1_pos"], "tp+fn"),
        _report_row("accuracy", _R["accuracy"], _R["accuracy"], _R["accuracy"], _R["n"]),
        _report_row("macro avg", _R["precision_macro"], _R["recall_macro"], _R["f1_macro"], _R["n"]),
        _report_row("weighted avg", _weighted("precision"), _weighted("recall"), _weighted("f1"), _R["n"])])),
    "eval_summary": chain(SCORED, _CELLS, f"select {metric_list(ev.SUMMARY)} from cells"),
    "eval_roc_points": chain(SCORED, _CURVE, """
        select s as threshold, round(fp/n::DOUBLE,6) as fpr, round(tp/p::DOUBLE,6) as tpr from cur
        where i=1 or i=k or npos<>pos or nneg<>neg
        union all select null, 0::DOUBLE, 0::DOUBLE"""),
    "eval_roc_auc": chain(SCORED, """
        long as (select 'score_a' as model, y, score_a as s from scored union all select 'score_b', y, score_b from scored),
        rk as (select model, y, rank() over (partition by model order by s)
              + (count(*) over (partition by model, s)-1)/2.0::DOUBLE as r from long)""", """
        select model, round((sum(r) filter (where y=1) - count(*) filter (where y=1)*(count(*) filter (where y=1)+1)/2.0::DOUBLE)
          / ((count(*) filter (where y=1))::DOUBLE*count(*) filter (where y=0)),6) as roc_auc from rk group by model"""),
    "eval_pr_points": chain(SCORED, _CURVE, """
        select s as threshold, round(tp/(tp+fp)::DOUBLE,6) as "precision", round(tp/p::DOUBLE,6) as recall,
               round(p/(p+n)::DOUBLE,6) as prevalence from cur
        union all select null, 1::DOUBLE, 0::DOUBLE, round(max(p)/(max(p)+max(n))::DOUBLE,6) from cur"""),
    "eval_avg_precision": chain(SCORED, _CURVE, """
        select round(sum((pos/p::DOUBLE)*(tp/(tp+fp)::DOUBLE)),6) as average_precision from cur"""),
    "eval_calibration": scored("""
        select cast(greatest(ceil(score_a*10)-1,0) as bigint) as bin, count(*) as n, round(avg(score_a),6) as mean_score,
               round(avg(y::DOUBLE),6) as positive_share from scored group by 1"""),
    "eval_threshold_sweep": chain(SCORED, _SWEEP.format(
        score="score_a", table="scored", p=_R["precision_pos"], r=_R["recall_pos"], f=_R["f1_pos"]),
        'select threshold, "precision", recall, f1, best from sweep'),
    "eval_outcomes": chain(SCORED, _OUT, """
        select outcome, count(*) as n, round(count(*)/(sum(count(*)) over ())::DOUBLE,6) as share from outc group by outcome"""),
    "eval_outcome_profile": chain(SCORED, _OUT, " union all ".join(f"""
        select '{f}' as feature, round(avg({f}) filter (where outcome='TP'),2) as "TP", round(avg({f}) filter (where outcome='TN'),2) as "TN",
          round(avg({f}) filter (where outcome='FP'),2) as "FP", round(avg({f}) filter (where outcome='FN'),2) as "FN" from outc"""
        for f in FEATURES)),
    "eval_error_rates": chain(SCORED, _OUT, " union all ".join(f"""
        select '{s}' as segment, {s} as "value", count(*) as n,
          round(avg(case when outcome in ('TP','TN') then 1::DOUBLE else 0 end),3) as correct,
          round(avg(case when outcome='FN' then 1::DOUBLE else 0 end),3) as false_negative,
          round(avg(case when outcome='FP' then 1::DOUBLE else 0 end),3) as false_positive
        from outc group by {s}""" for s in SEGMENTS)),
    "eval_error_examples": chain(SCORED, _OUT, """
        select outcome, cast(place as int) as place, id, segment, priority, qty_sum, score_a from (
          select *, row_number() over (partition by outcome order by id) as place from outc where outcome in ('FP','FN'))
        where place<=10"""),
    "eval_outcome_quartiles": chain(SCORED, _OUT, " union all ".join(f"""
        select '{f}' as feature, outcome, count({f}) as n, round(quantile_cont({f}::DOUBLE,0.25),6) as q1,
          round(quantile_cont({f}::DOUBLE,0.5),6) as median, round(quantile_cont({f}::DOUBLE,0.75),6) as q3
        from outc group by outcome""" for f in FEATURES)),
    "eval_final_summary": chain(SAMPLED, """
        test as (select * from sampled where split='test'),""" + _SWEEP.format(
            score="score_a", table="test", p=_R["precision_pos"], r=_R["recall_pos"], f=_R["f1_pos"]) + f""",
        held as (select {counts()} from test),
        hm as (select {metric_list(['n', 'accuracy', 'f1_macro'])} from held),
        rk as (select y, score_a, rank() over (order by score_a) + (count(*) over (partition by score_a)-1)/2.0::DOUBLE as r from test),
        auc as (select (sum(r) filter (where y=1) - count(*) filter (where y=1)*(count(*) filter (where y=1)+1)/2.0::DOUBLE)
              / ((count(*) filter (where y=1))::DOUBLE*count(*) filter (where y=0)) as a from rk),
        cnt as (select score_a as s, count(*) filter (where y=1) as pos, count(*) as k from test group by 1),
        cur as (select pos, sum(pos) over (order by s desc) as tp, sum(k) over (order by s desc) as seen, sum(pos) over () as p from cnt),
        ap as (select sum((pos/p::DOUBLE)*(tp/seen::DOUBLE)) as a from cur),
        fc as (select fold, {counts()} from sampled where split='train' group by fold),
        fm as (select {_R['f1_macro']} as f, {_R['n']} as n from fc),
        cv as (select round(avg(f),6) as cv_f1_mean, round(stddev_pop(f),6) as cv_f1_std, sum(n)::BIGINT as n_train from fm)""", """
        select hm.n as n_test, hm.accuracy, hm.f1_macro, round(auc.a,6) as roc_auc, round(ap.a,6) as average_precision,
               s.threshold as best_threshold, s.f1 as best_f1, cv_f1_mean, cv_f1_std, n_train
        from hm, auc, ap, cv, sweep s where s.best"""),
}
