"""Feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.catalog.base import SAMPLED, SURVEY, chain, survey
from riskframe.operators import features as fe, training as tr
from riskframe.plans.bindings import modelling_table, order_survey, sampled_orders, stored_survey
from riskframe.plans.storage import store

SCALED = ["acctbal", "totalprice", "qty_sum"]
RANKED = ["acctbal", "totalprice", "n_lines", "qty_sum", "disc_sum"]
COV = ["acctbal", "totalprice", "n_lines", "qty_sum", "disc_sum", "priority_ord"]
LABELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


def fe_cardinality_guard(spark, sf):
    return fe.cardinality_guard(order_survey(spark, sf), ["segment", "status", "qty_sum", "priority"])


def fe_value_map(spark, sf):
    return order_survey(spark, sf).select("id", fe.value_map(F.col("status"), {"F": 1, "O": 0}).alias("mapped"))


def fe_ordinal(spark, sf):
    return order_survey(spark, sf).select("id", fe.ordinal(F.col("priority"), LABELS).alias("placed"))


def fe_interaction(spark, sf):
    return order_survey(spark, sf).select("id", fe.interaction(
        F.col("qty_sum"), fe.ordinal(F.col("priority"), LABELS)).alias("crossed"))


def fe_one_hot(spark, sf):
    df = order_survey(spark, sf)
    levels = fe.levels_of(df.filter("segment <> 'MACHINERY'"), ["segment"])["segment"]  # one category is unseen at fit
    return fe.one_hot(df.select("id", "segment"), "segment", levels).drop("segment")


def _fitted(spark, sf, fit):
    rows = sampled_orders(spark, sf, folds=False, columns=SCALED)
    return rows, fit(rows.filter("split = 'train'"), SCALED)


def fe_minmax(spark, sf):
    rows, bounds = _fitted(spark, sf, fe.fit_min_max)
    return rows.select("id", "split", *[F.round(fe.min_max(F.col(c), *bounds[c]), 6).alias(c) for c in SCALED])


def fe_standardize(spark, sf):
    rows, moments = _fitted(spark, sf, fe.fit_standard)
    return rows.select("id", "split", *[F.round(fe.standard(F.col(c), *moments[c]), 6).alias(c) for c in SCALED])


def fe_prepared(spark, sf):
    table, fitted = modelling_table(spark, sf, folds=False)
    return fe.slot_means(table, fitted.names)


def fe_chi2_topk(spark, sf):
    df = stored_survey(spark, sf, "y", "status", *RANKED).fillna(0)
    bounds = fe.fit_min_max(df, RANKED)
    scaled = df.select("y", "status", *[fe.min_max(F.col(c), *bounds[c]).alias(c) for c in RANKED])
    hot = fe.one_hot(scaled, "status", ["F", "O", "P"])
    return fe.chi2_ranking(hot, [*RANKED, "status_F", "status_O", "status_P"], "y", k=4)


def fe_covariance(spark, sf):
    df = order_survey(spark, sf).dropna(subset=COV)
    return fe.covariance_matrix(df.withColumns({c: F.col(c) / 1000 for c in ("acctbal", "totalprice")}), COV)


def fe_rfe(spark, sf):
    table, fitted = modelling_table(spark, sf, folds=False)
    train = tr.with_balanced_weights(table.filter("split = 'train'"))
    return fe.recursive_elimination(train, fitted.names, 15, weight="weight")


def fe_pca(spark, sf):
    table, _ = modelling_table(spark, sf, folds=False)
    return fe.pca_variance(table.filter("split = 'train'"))


def fe_pca_project(spark, sf):
    table, _ = modelling_table(spark, sf, folds=False)
    from pyspark.ml.functions import vector_to_array
    xy = vector_to_array("projected")
    return fe.pca_project(table, 2).select("id", "y", F.get(xy, F.lit(0)).alias("axis_1"),
                                           F.get(xy, F.lit(1)).alias("axis_2"))


def fe_svd(spark, sf):
    table, _ = modelling_table(spark, sf, folds=False)
    projected, _, _ = fe.truncated_svd(table.filter("split = 'train'"))
    return fe.svd_variance(projected, "features")


def fe_feature_ab(spark, sf):
    """Fold scores with and without the crossed feature."""
    table, fitted = modelling_table(spark, sf)
    train = table.filter("split = 'train'")
    plain = fe.keep_slots(train, fitted.names, [n for n in fitted.names if n != "qty_x_priority"], output="plain")
    out = None
    for label, rows, column in (("with", train, "features"), ("without", plain, "plain")):
        folds = tr.fold_metrics(tr.out_of_fold(rows, [tr.lr(name=label)], features=column))
        summary = tr.summarise_folds(folds, metrics=["f1_macro", "roc_auc"])
        out = summary if out is None else out.unionByName(summary)
    return out


def fe_supplementary(spark, sf):
    """One F1 per preparation variant, best first (F16)."""
    table, fitted = modelling_table(spark, sf, folds=False)
    train, test = table.filter("split = 'train'"), table.filter("split = 'test'")
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector

    models = {"min-max": (tr.fit(tr.lr(), train), test)}
    scaler = StandardScaler(withMean=True, inputCol="features", outputCol="standardised").fit(train)
    models["standardised"] = (tr.fit(tr.lr(), scaler.transform(train), "standardised"), scaler.transform(test))
    projected, _, v = fe.truncated_svd(train)
    as_vector = store(projected.withColumn("reduced", array_to_vector("projected")).select("y", "reduced"), "svd")
    reduced_test = fe.project(test, v).withColumn("reduced", array_to_vector("projected"))
    models["svd"] = (tr.fit(tr.lr(), as_vector, "reduced"), reduced_test)
    out = None
    for name, (model, rows) in models.items():
        part = tr.held_out({name: model}, rows)
        out = part if out is None else out.unionByName(part)
    return out.select("model", "f1_macro", "roc_auc").orderBy(F.col("f1_macro").desc())


QUERIES = {f.__name__: f for f in (
    fe_cardinality_guard, fe_value_map, fe_ordinal, fe_interaction, fe_one_hot, fe_minmax, fe_standardize,
    fe_prepared, fe_chi2_topk, fe_covariance, fe_rfe, fe_pca, fe_pca_project, fe_svd, fe_feature_ab,
    fe_supplementary)}

_PLACED = ("case priority when '1-URGENT' then 1 when '2-HIGH' then 2 when '3-MEDIUM' then 3 "
           "when '4-NOT SPECIFIED' then 4 else 3 end::DOUBLE")
_FILL = """fx as (select split, priority_ord::DOUBLE as priority, acctbal, totalprice, coalesce(n_lines,0)::DOUBLE as n_lines,
    coalesce(qty_sum,100)::DOUBLE as qty_sum, coalesce(disc_sum,0)::DOUBLE as disc_sum,
    coalesce(qty_sum,100)*priority_ord::DOUBLE as qty_x_priority, segment, status, region_name from sampled)"""
_NUM = ["acctbal", "totalprice", "n_lines", "qty_sum", "disc_sum", "qty_x_priority"]
_HOT = ([("segment", v) for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")]
        + [("status", v) for v in "FOP"]
        + [("region_name", v) for v in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")])
_SLOTS = ([(c, f"({c}-(select min({c}) from fx where split='train'))/((select max({c})-min({c}) from fx where split='train'))")
           for c in _NUM]
          + [(f"{c}_{v}", f"case when {c}='{v}' then 1.0::DOUBLE else 0 end") for c, v in _HOT]
          + [("priority", "priority")])


def _chi2(name: str, x: str) -> str:
    return f"""select '{name}' as feature, round(sum((o-e)*(o-e)/nullif(e,0)),6) as chi2 from (
        select sum({x}) filter (where y=c) as o, count(*) filter (where y=c)*sum({x})/count(*)::DOUBLE as e
        from rows0, (values (0),(1)) k(c) group by c)"""


def _kilo(c: str) -> str:
    return f"{c}::DOUBLE/1000" if c in ("acctbal", "totalprice") else f"{c}::DOUBLE"


_SCALE = "({c}-(select min({c}) from rows0))/(select (max({c})-min({c}))::DOUBLE from rows0)"

ORACLE = {
    "fe_cardinality_guard": survey(" union all ".join(
        f"select '{c}' as \"column\", count(distinct {c}) as levels, count(distinct {c})<=20 as kept from survey"
        for c in ("segment", "status", "qty_sum", "priority"))),
    "fe_value_map": survey("select id, case status when 'F' then 1::DOUBLE when 'O' then 0::DOUBLE end as mapped from survey"),
    "fe_ordinal": survey(f"select id, {_PLACED} as placed from survey"),
    "fe_interaction": survey(f"select id, qty_sum*({_PLACED}) as crossed from survey"),
    "fe_one_hot": survey("select id, " + ", ".join(
        f"(segment='{v}')::INT as \"segment_{v}\"" for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")) + " from survey"),
    "fe_minmax": chain(SAMPLED, "tr as (select * from sampled where split='train')", "select id, split, " + ", ".join(
        f"round(({c}-(select min({c}) from tr))/(select (max({c})-min({c}))::DOUBLE from tr),6) as {c}" for c in SCALED)
        + " from sampled"),
    "fe_standardize": chain(SAMPLED, "tr as (select * from sampled where split='train')", "select id, split, " + ", ".join(
        f"round(({c}-(select avg({c}) from tr))/(select stddev_pop({c}) from tr),6) as {c}" for c in SCALED)
        + " from sampled"),
    "fe_prepared": chain(SAMPLED, _FILL, " union all ".join(
        f"select {i}::INTEGER as position, '{n}' as name, round(avg({x}),6) as \"mean\" from fx"
        for i, (n, x) in enumerate(_SLOTS))),
    "fe_chi2_topk": chain(SURVEY, """rows0 as (select y, status, acctbal, totalprice, coalesce(n_lines,0) as n_lines,
        coalesce(qty_sum,0) as qty_sum, coalesce(disc_sum,0) as disc_sum from survey),
        scores as (""" + " union all ".join(
            [_chi2(c, _SCALE.format(c=c)) for c in RANKED]
            + [_chi2(f"status_{v}", f"case when status='{v}' then 1.0::DOUBLE else 0 end") for v in "FOP"]) + ")", """
        select feature, chi2, cast(row_number() over (order by chi2 desc, feature) as int) as place,
          row_number() over (order by chi2 desc, feature) <= 4 as kept from scores"""),
    "fe_covariance": survey(" union all ".join(
        f"select '{a}' as a, '{b}' as b, round(covar_samp({_kilo(a)},{_kilo(b)}),6) as cov from survey "
        "where qty_sum is not null" for i, a in enumerate(COV) for b in COV[i:])),
}
