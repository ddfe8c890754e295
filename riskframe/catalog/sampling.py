"""Sampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.catalog.base import SCORED, chain, hash_sql, sampled, scored
from riskframe.operators import sampling as sm
from riskframe.plans.bindings import scored_orders, vectors
from riskframe.plans.neighbours import nearest_neighbours
from riskframe.plans.storage import store

# The fractions of the progressive samples.
FRACTIONS = [0.2, 0.4, 0.6, 0.8, 1.0]


def _rows(spark, sf):
    """The sampled columns, written once because a sampler reads them several times."""
    return store(scored_orders(spark, sf).select("id", "y"), "rows")


def sample_kfold(spark, sf):
    return sm.stratified_folds(_rows(spark, sf), "id", ["y"])


def split_stratified(spark, sf):
    return sm.stratified_split(_rows(spark, sf), "id", ["y"])


def sample_under(spark, sf):
    return sm.under_sample(_rows(spark, sf), "id", "y")


def sample_over(spark, sf):
    return sm.over_sample(_rows(spark, sf), "id", "y")


def sample_progressive(spark, sf):
    return sm.size_and_mix(sm.progressive_samples(_rows(spark, sf), "id", FRACTIONS), ["fraction"], "y")


def sample_fixed(spark, sf):
    return sm.fixed_sample(scored_orders(spark, sf).select("id", "y"), "id", 3000)


def sample_capped_kfold(spark, sf):
    return sm.capped_folds(_rows(spark, sf), "id", ["y"])


def sample_smote(spark, sf):
    made = sm.smote(vectors(spark, sf), "vec_id", "label", "embedding", minority=3)
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x)
    return made.select("base_id", "draw", "neighbour_id", F.round(F.get("embedding", F.lit(0)), 6).alias("first"),
                       F.round(total, 6).alias("total"))


def sample_neighbours(spark, sf):
    """Three nearest of every vector on a coarse grid, where most distances are tied."""
    grid = vectors(spark, sf).select("vec_id", F.transform(F.slice("embedding", 1, 2), lambda x: F.floor(x * 8).cast("double")).alias("v"))
    near = nearest_neighbours(grid, grid, "vec_id", "v", 3, block_rows=200, cells=4)
    return near.select("base_id", "rank", "neighbour_id", F.round("distance", 6).alias("distance"))


QUERIES = {f.__name__: f for f in (sample_kfold, split_stratified, sample_under, sample_over, sample_progressive,
                                   sample_fixed, sample_capped_kfold, sample_smote, sample_neighbours)}

_RANKED = "rk as (select id, y, row_number() over (partition by y order by {h}, id) as r, count(*) over (partition by y) as n from scored)"


def _u(salt: str) -> str:
    return f"('0x'||substr(md5(concat('{salt}:',b.id,'/',d)),1,8))::BIGINT"


ORACLE = {
    "sample_kfold": sampled("select id, y, fold from sampled"),
    "split_stratified": sampled("select id, y, split from sampled"),
    "sample_under": chain(SCORED, _RANKED.format(h=hash_sql("under")), """
        select id, y from rk where r <= (select min(n) from rk)"""),
    "sample_over": chain(SCORED, _RANKED.format(h=hash_sql("over")), """
        select id, y, c as "copy" from (select *, (select max(n) from rk)-n as deficit from rk),
          lateral (select unnest(range(0, cast(floor(deficit/n::DOUBLE) as bigint) + case when r <= deficit % n then 2 else 1 end)) as c)"""),
    "sample_progressive": chain(SCORED, f"""
        rk as (select id, y, row_number() over (order by {hash_sql('progressive')}, id) as r, count(*) over () as n from scored)""", """
        select f::DOUBLE as fraction, count(*) as n, count(*) filter (where y=1) as n_pos
        from (values (0.2::DOUBLE),(0.4::DOUBLE),(0.6::DOUBLE),(0.8::DOUBLE),(1.0::DOUBLE)) fr(f) join rk on r <= floor(round(n*f,6)) group by f"""),
    "sample_fixed": scored(f"select id, y from scored order by {hash_sql('fixed')}, id limit 3000"),
    "sample_capped_kfold": chain(SCORED, f"""
        ck as (select id, y, row_number() over (order by {hash_sql('cap')}, id) as r, count(*) over () as n from scored),
        cut as (select id, y from ck where r <= least(n, greatest(5000, floor(round(n*0.5::DOUBLE,6)))))""", f"""
        select id, y, cast(floor((row_number() over (partition by y order by {hash_sql('cap-fold')}, id)-1)*3.0::DOUBLE
          / count(*) over (partition by y)) as int) as fold from cut"""),
    "sample_neighbours": """
        with g as (select vec_id as id, floor(embedding[1]::DOUBLE*8) as x, floor(embedding[2]::DOUBLE*8) as y from embeddings),
        d as (select a.id as base_id, b.id as neighbour_id, sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) as d
          from g a join g b on a.id<>b.id)
        select base_id, "rank", neighbour_id, round(d,6) as distance from (select *,
          cast(row_number() over (partition by base_id order by d, neighbour_id) as int) as "rank" from d) where "rank" <= 3""",
    "sample_smote": f"""
        with e as (select vec_id as id, label, embedding::DOUBLE[] as v from embeddings),
        m as (select *, row_number() over (order by {hash_sql('smote')}, id) as r from e where label=3),
        k as (select (select count(*) from e) - 2*(select count(*) from m) as draws, (select count(*) from m) as n),
        near as (select a.id as id, b.id as nid, b.v as nv,
            row_number() over (partition by a.id order by list_distance(a.v,b.v), b.id) as rank
          from m a join m b on a.id<>b.id),
        b as (select m.id, m.v, unnest(range(1, cast(floor(draws/n::DOUBLE) as bigint) + case when r <= draws % n then 2 else 1 end)) as d
          from m, k),
        p as (select b.id, b.v, d::INTEGER as d, {_u('smote-pick')} % 5 + 1 as rank, {_u('smote-step')}/4294967296.0::DOUBLE as u from b)
        select p.id as base_id, d as draw, nid as neighbour_id, round(v[1]+u*(nv[1]-v[1]),6) as "first",
          round(list_sum([v[i]+u*(nv[i]-v[i]) for i in range(1,65)]),6) as total
        from p join near on near.id=p.id and near.rank=p.rank""",
}
