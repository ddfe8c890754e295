"""Profiling queries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from riskframe.catalog.base import SAMPLED, SURVEY, chain, survey
from riskframe.operators import profile as pr
from riskframe.plans.bindings import order_survey, sampled_orders, stored_survey
from riskframe.sources.tables import table

CATS = ["segment", "priority", "status", "region_name"]
NUMS = ["acctbal", "totalprice", "n_lines", "qty_sum", "disc_sum"]
BINNED = ["acctbal", "qty_sum", "n_lines"]
CORR = ["acctbal", "totalprice", "n_lines", "qty_sum", "disc_sum", "priority_ord", "y"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def eda_cat_freq(spark, sf):
    return pr.category_frequencies(order_survey(spark, sf), CATS)


def eda_cat_by_target(spark, sf):
    return pr.category_by_target(order_survey(spark, sf), CATS, "y")


def eda_box_stats(spark, sf):
    return pr.box_stats(stored_survey(spark, sf, "y", *NUMS), NUMS, ["y"])


def eda_histogram(spark, sf):
    return pr.histogram(stored_survey(spark, sf, "y", *BINNED), BINNED, 30, ["y"])


def eda_histogram_all(spark, sf):
    return pr.histogram(table(spark, sf, "events"), ["value"], 25)


def eda_kde(spark, sf):
    return pr.kernel_density(order_survey(spark, sf), ["acctbal", "qty_sum", "priority_ord"], ["y"])


def eda_mean_by_class(spark, sf):
    return pr.mean_by_class(order_survey(spark, sf), NUMS, "y")


def eda_corr_matrix(spark, sf):
    return pr.guarded_corr(order_survey(spark, sf), CORR)


def eda_point_biserial(spark, sf):
    df = order_survey(spark, sf).withColumn("flat", F.lit(1.0)).withColumn("open", F.when(F.col("status") == "O", "yes").otherwise("no"))
    encoded = pr.encode_for_correlation(
        df, NUMS + ["flat"], {"priority": PRIORITIES}, {"open": ["yes", "no"]},
        {"segment": SEGMENTS, "region_name": REGIONS}, keep=["y"])
    return pr.point_biserial(encoded, [c for c in encoded.columns if c != "y"], "y")


def eda_target_rate(spark, sf):
    return pr.target_rates(order_survey(spark, sf), CATS, "y")


def eda_flow_links(spark, sf):
    return pr.flow_links(order_survey(spark, sf), "segment", "priority", "y")


def eda_group_means(spark, sf):
    return pr.group_means(order_survey(spark, sf), ["segment", "y"], ["acctbal", "n_lines", "qty_sum"])


def eda_group_cube(spark, sf):
    return pr.group_means(order_survey(spark, sf), ["status", "y"], ["qty_sum"], totals="cube")


def eda_split_compare(spark, sf):
    return pr.split_compare(sampled_orders(spark, sf, folds=False), NUMS)


def eda_pair_bins(spark, sf):
    return pr.pair_bins(stored_survey(spark, sf, "y", "acctbal", "qty_sum"), "acctbal", "qty_sum", "y")


def eda_labelled_projection(spark, sf):
    df = pr.labelled_projection(order_survey(spark, sf), ["id", "priority_ord", "qty_sum", "absent"], "y",
                                {0: "low", 1: "high"})
    return df


QUERIES = {f.__name__: f for f in (
    eda_cat_freq, eda_cat_by_target, eda_box_stats, eda_histogram, eda_histogram_all, eda_kde, eda_mean_by_class,
    eda_corr_matrix, eda_point_biserial, eda_target_rate, eda_flow_links, eda_group_means, eda_group_cube,
    eda_split_compare, eda_pair_bins, eda_labelled_projection)}


def _corr(a: str, b: str) -> str:
    return (f"(select case when min(p)=max(p) or min(q)=max(q) then null else corr(p,q) end from "
            f"(select ({a})::DOUBLE as p, ({b})::DOUBLE as q from survey) where p is not null and q is not null)")


_BISERIAL = ([(c, c) for c in NUMS] + [("priority", "priority_ord")]
             + [("open", "case when status='O' then 1 else 0 end")]
             + [(f"segment_{s}", f"case when segment='{s}' then 1 else 0 end") for s in SEGMENTS[1:]]
             + [(f"region_name_{r}", f"case when region_name='{r}' then 1 else 0 end") for r in REGIONS[1:]])


def _box(c: str) -> str:
    return f"""
      select '{c}' as "column", y, n, round(a,6) as q1, round(m,6) as median, round(b,6) as q3,
        round(a-1.5::DOUBLE*(b-a),6) as fence_low, round(b+1.5::DOUBLE*(b-a),6) as fence_high,
        round(min({c}::DOUBLE) filter (where {c}>=a-1.5::DOUBLE*(b-a) and {c}<=b+1.5::DOUBLE*(b-a)),6) as whisker_low,
        round(max({c}::DOUBLE) filter (where {c}>=a-1.5::DOUBLE*(b-a) and {c}<=b+1.5::DOUBLE*(b-a)),6) as whisker_high,
        count(*) filter (where {c}<a-1.5::DOUBLE*(b-a) or {c}>b+1.5::DOUBLE*(b-a)) as outliers
      from survey join (select y, count({c}) as n, quantile_cont({c}::DOUBLE,0.25) as a, quantile_cont({c}::DOUBLE,0.5) as m,
        quantile_cont({c}::DOUBLE,0.75) as b from survey group by y) using (y)
      where {c} is not null group by y, n, a, m, b"""


def _hist(c: str, source: str, bins: int, by: str = "") -> str:
    key, on = (f"{by}, ", f"using ({by})") if by else ("", "on true")
    group = f"group by {by}" if by else ""
    return f"""
      select '{c}' as "column", {key}least(coalesce(floor(({c}::DOUBLE-lo)/nullif((hi-lo)/{bins}::DOUBLE,0)),0),{bins - 1})::BIGINT as bin,
        round(lo + least(coalesce(floor(({c}::DOUBLE-lo)/nullif((hi-lo)/{bins}::DOUBLE,0)),0),{bins - 1})*((hi-lo)/{bins}::DOUBLE),6) as bin_low,
        count(*) as n, round(count(*)/any_value(k*((hi-lo)/{bins}::DOUBLE)),9) as density
      from {source} join (select {key}min({c})::DOUBLE as lo, max({c})::DOUBLE as hi, count({c}) as k from {source} {group}) {on}
      where {c} is not null group by all"""


def _kde(c: str) -> str:
    return f"""
      select '{c}' as "column", g.y, g.i::INTEGER as point, round(g.x,6) as x,
        round(sum(exp(-0.5::DOUBLE*((g.x-v.v)/g.h)*((g.x-v.v)/g.h))*v.n)/(g.k*g.h*sqrt(2*pi())),9) as density
      from (select y, i, k, lo-pad+i*((hi-lo+2*pad)/299.0::DOUBLE) as x, s*f as h from
              (select min({c})::DOUBLE as lo, max({c})::DOUBLE as hi, (max({c})::DOUBLE-min({c})::DOUBLE)*0.04::DOUBLE as pad,
                 case when count(distinct {c})<=10 then 0.65::DOUBLE else 0.35::DOUBLE end as f from survey),
              (select y, count({c}) as k, stddev_samp({c}::DOUBLE) as s from survey group by y), range(0,300) r(i)) g
        join (select y, {c}::DOUBLE as v, count(*) as n from survey where {c} is not null group by all) v on v.y=g.y
      group by g.y, g.i, g.x, g.k, g.h"""


def _split(c: str) -> str:
    def on(side: str) -> str:
        return f"filter (where split='{side}')"

    m = ", ".join(f"count({c}) {on(s)} as n_{s}, round(avg({c}::DOUBLE) {on(s)},6) as mean_{s}, "
                  f"round(stddev_samp({c}::DOUBLE) {on(s)},6) as std_{s}, "
                  f"round(quantile_cont({c}::DOUBLE,0.5) {on(s)},6) as median_{s}" for s in ("train", "test"))
    return f"""
      select '{c}' as "column", m.*, round(psi,6) as stability_index from (select {m} from sampled) m,
        (select sum((p-q)*ln(p/q)) as psi from (
          select count(*) {on('train')}/a::DOUBLE as p, count(*) {on('test')}/b::DOUBLE as q from sampled,
            (select min({c})::DOUBLE as lo, max({c})::DOUBLE as hi, count({c}) {on('train')} as a, count({c}) {on('test')} as b from sampled)
          where {c} is not null
          group by least(floor(({c}::DOUBLE-lo)/((hi-lo)/10.0::DOUBLE)),9), a, b) where p>0 and q>0)"""


ORACLE = {
    "eda_cat_freq": survey(" union all ".join(
        f"select '{c}' as \"column\", {c} as \"value\", count(*) as n, "
        f"round(count(*)*100.0::DOUBLE/sum(count(*)) over (),2) as pct from survey group by {c}" for c in CATS)),
    "eda_cat_by_target": survey(" union all ".join(
        f"select '{c}' as \"column\", {c} as \"value\", count(*) filter (where y=0) as n_neg, "
        f"count(*) filter (where y=1) as n_pos from survey group by {c}" for c in CATS)),
    "eda_box_stats": survey(" union all ".join(_box(c) for c in NUMS)),
    "eda_histogram": survey(" union all ".join(_hist(c, "survey", 30, "y") for c in ("acctbal", "qty_sum", "n_lines"))),
    "eda_histogram_all": _hist("value", "events", 25),
    "eda_kde": survey(" union all ".join(_kde(c) for c in ("acctbal", "qty_sum", "priority_ord"))),
    "eda_mean_by_class": survey(" union all ".join(
        f"select '{c}' as feature, round(avg({c}) filter (where y=0),6) as class_0, "
        f"round(avg({c}) filter (where y=1),6) as class_1 from survey" for c in NUMS)),
    "eda_corr_matrix": survey(" union all ".join(
        f"select '{min(a, b)}' as a, '{max(a, b)}' as b, round({_corr(a, b)},6) as r" for a, b in combinations(CORR, 2))),
    "eda_point_biserial": chain(SURVEY, "rs as (" + " union all ".join(
        f"select '{name}' as feature, round(abs({_corr(text, 'y')}),6) as abs_r" for name, text in _BISERIAL) + ")", """
        select feature, abs_r, cast(row_number() over (order by abs_r desc, feature) as int) as place from rs"""),
    "eda_target_rate": survey(" union all ".join(f"""
        select '{c}' as "column", v as "value", n, round(rate,6) as rate,
          round(quantile_cont(rate,0.5) over (),6) as median_rate, rate > quantile_cont(rate,0.5) over () as above
        from (select {c} as v, count(*) as n, avg(y::DOUBLE) as rate from survey group by {c})""" for c in CATS)),
    "eda_flow_links": survey("""
        select 'path' as link, segment as a, priority as b, y::VARCHAR as t, count(*) as n from survey group by all
        union all select 'first-second', segment, priority, null, count(*) from survey group by all
        union all select 'second-target', null, priority, y::VARCHAR, count(*) from survey group by all"""),
    "eda_group_means": survey("""select segment, y, round(avg(acctbal),2) as acctbal, round(avg(n_lines),2) as n_lines,
        round(avg(qty_sum),2) as qty_sum from survey group by segment, y"""),
    "eda_group_cube": survey("select status, y, round(avg(qty_sum),2) as qty_sum from survey group by cube (status, y)"),
    "eda_split_compare": chain(SAMPLED, "one as (select 1)", " union all ".join(_split(c) for c in NUMS)),
    "eda_pair_bins": survey("""
        select least(floor((acctbal-lx)/((hx-lx)/10)),9)::BIGINT as bin_x, least(floor((qty_sum::DOUBLE-ly)/((hy-ly)/10)),9)::BIGINT as bin_y,
          y as class, count(*) as n
        from survey, (select min(acctbal) as lx, max(acctbal) as hx, min(qty_sum)::DOUBLE as ly, max(qty_sum)::DOUBLE as hy
          from survey where acctbal is not null and qty_sum is not null)
        where acctbal is not null and qty_sum is not null group by 1,2,3"""),
    "eda_labelled_projection": survey("""select id, priority_ord, qty_sum,
        case when y=0 then 'low' else 'high' end as label from survey"""),
}
