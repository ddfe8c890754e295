"""Subgroup queries (H1-H7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.catalog.base import SCORED, chain, counts, metric_list
from riskframe.functions.bands import level_bands, right_closed_bands
from riskframe.operators import fairness as fair
from riskframe.plans.bindings import scored_orders

BAND_EDGES = [-1000, 0, 5000, 10000]
BAND_LABELS = ["<=0", "0-5000", "5000+"]
MATRIX = ["accuracy", "f1_macro", "f1_pos", "precision_pos", "recall_pos"]


def dimensions():
    return {
        "segment": F.col("segment"),
        "balance": right_closed_bands(F.col("acctbal"), BAND_EDGES, BAND_LABELS),
        "urgency": level_bands(F.col("priority_ord"), 2, 3),
        "quantity": level_bands(F.col("qty_sum"), 60, 140),
        "status": F.col("status"),
    }


def _metrics(spark, sf, score=None):
    return fair.subgroup_metrics(scored_orders(spark, sf), dimensions(), "y", "pred_a", score)


def fair_bands(spark, sf):
    dims = {k: v for k, v in dimensions().items() if k in ("balance", "urgency", "quantity")}
    df = scored_orders(spark, sf).select(*[v.alias(k) for k, v in dims.items()])
    return (df.unpivot([], list(dims), "band", "value").groupBy("band", "value")
            .agg(F.count(F.lit(1)).alias("n")))


def fair_subgroup_metrics(spark, sf):
    return _metrics(spark, sf, "score_a")


def fair_gap_report(spark, sf):
    return fair.gap_report(_metrics(spark, sf))


def fair_flags(spark, sf):
    return fair.flagged_groups(_metrics(spark, sf))


def fair_matrix(spark, sf):
    return fair.metric_matrix(_metrics(spark, sf), MATRIX)


def fair_predicates(spark, sf):
    return fair.predicate_metrics(scored_orders(spark, sf), {
        "urgency<=2": F.col("priority_ord") <= 2, "urgency>=4": F.col("priority_ord") >= 4,
        "quantity>140": F.col("qty_sum") > 140, "no lines": F.col("n_lines").isNull()}, "y", "pred_a")


QUERIES = {f.__name__: f for f in (fair_subgroup_metrics, fair_bands, fair_gap_report, fair_flags,
                                   fair_matrix, fair_predicates)}

_BANDED = """
banded as (select *,
    case when acctbal>-1000 and acctbal<=0 then '<=0' when acctbal>0 and acctbal<=5000 then '0-5000'
         when acctbal>5000 and acctbal<=10000 then '5000+' end as balance,
    case when priority_ord<=2 then 'Low' when priority_ord=3 then 'Medium' else 'High' end as urgency,
    case when qty_sum<=60 then 'Low' when qty_sum<=140 then 'Medium' else 'High' end as quantity
  from scored),
members as (
    select 'Overall' as subgroup, 'All' as "group", y, pred_a, score_a from banded
    union all select 'segment', segment, y, pred_a, score_a from banded
    union all select 'balance', balance, y, pred_a, score_a from banded
    union all select 'urgency', urgency, y, pred_a, score_a from banded
    union all select 'quantity', quantity, y, pred_a, score_a from banded
    union all select 'status', status, y, pred_a, score_a from banded)"""
_NAMES = fair.METRICS
_METRICS = _BANDED + f""",
cells as (select subgroup, "group", {counts()} from members where "group" is not null group by all),
metrics as (select subgroup, "group", {metric_list(_NAMES)} from cells where tp+fp+fn+tn>=30)"""

ORACLE = {
    "fair_subgroup_metrics": chain(SCORED, _METRICS + """,
        ranked as (select subgroup, "group", y, (rank() over w + (count(*) over (partition by subgroup, "group", score_a)-1)/2.0::DOUBLE) as rk
            from members where "group" is not null window w as (partition by subgroup, "group" order by score_a)),
        auc as (select subgroup, "group", (sum(rk) filter (where y=1) - count(*) filter (where y=1)*(count(*) filter (where y=1)+1)/2.0::DOUBLE)
              / nullif((count(*) filter (where y=1))::DOUBLE*count(*) filter (where y=0),0) as a from ranked group by all)""",
        'select m.*, round(a,6) as roc_auc from metrics m left join auc using (subgroup, "group")'),
    "fair_bands": chain(SCORED, _BANDED, """
        select band, "value", count(*) as n from (
          select 'balance' as band, balance as "value" from banded union all
          select 'urgency', urgency from banded union all select 'quantity', quantity from banded) group by all"""),
    "fair_gap_report": chain(SCORED, _METRICS, """
        select subgroup, round(max(f1_macro)-min(f1_macro),4) as f1_gap,
               round(max(recall_pos)-min(recall_pos),4) as recall_gap
        from metrics where subgroup<>'Overall' group by subgroup"""),
    "fair_flags": chain(SCORED, _METRICS, """
        select subgroup, coalesce(string_agg("group", ', ' order by "group")
                 filter (where recall_pos < o - 0.05::DOUBLE),'') as flagged,
               count(*) filter (where recall_pos < o - 0.05::DOUBLE) as n_flagged
        from metrics, (select recall_pos as o from metrics where subgroup='Overall')
        where subgroup<>'Overall' group by subgroup"""),
    "fair_matrix": chain(SCORED, _METRICS, " union all ".join(f"""
        select subgroup||' | '||"group" as label, '{m}' as metric, {m} as "value",
          (select {m} from metrics where subgroup='Overall') as overall from metrics""" for m in MATRIX)),
    "fair_predicates": chain(SCORED, f"""
        sets as (select 'urgency<=2' as subgroup, y, pred_a from scored where priority_ord<=2
          union all select 'urgency>=4', y, pred_a from scored where priority_ord>=4
          union all select 'quantity>140', y, pred_a from scored where qty_sum>140
          union all select 'no lines', y, pred_a from scored where n_lines is null),
        cells as (select subgroup, {counts()} from sets group by subgroup)""",
        f"select subgroup, {metric_list(['n', 'f1_macro', 'recall_pos'])} from cells where tp+fp+fn+tn>=30"),
}
