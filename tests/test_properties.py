"""Invariants: ranking metrics against brute force, samplers under repartitioning, null rules."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from riskframe.functions.hashing import keyed_hash
from riskframe.operators import (evaluation as ev, explanation as ex, features as fe, profile as pr, quality as dq,
                                 sampling as sm)
from riskframe.plans import ordered
from riskframe.plans.bindings import scored_orders
from riskframe.plans.neighbours import nearest_neighbours
from riskframe.plans.storage import store

FEW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SCORES = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 8)), min_size=4, max_size=60)


def brute_auc(rows):
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@FEW
@given(rows=SCORES)
def test_auc_is_exact_and_antisymmetric(spark, rows):
    df = spark.createDataFrame([(y, s / 8) for y, s in rows], "y int, score double")
    want = brute_auc(rows)
    got = ev.roc_auc(df, digits=None).first()[0]
    mirrored = ev.roc_auc(df.withColumn("score", -F.col("score")), digits=None).first()[0]
    if want is None:
        assert got is None
    else:
        assert got == pytest.approx(want) and mirrored == pytest.approx(1 - want)


def test_two_level_totals_equal_one_level(spark):
    rng = np.random.default_rng(3)
    # A third of the rows share one score, and most distinct scores crowd near zero.
    scores = np.r_[np.full(1000, 0.5), rng.beta(0.2, 5, 2000)]
    df = spark.createDataFrame([(int(rng.random() < s), float(s), "ab"[i % 2]) for i, s in enumerate(scores)],
                               "y int, score double, g string")
    counts = ev.score_counts(df, "y", "score", ["g"])
    plain = ordered.running_totals(counts, ["g"], "score", ["pos", "neg"])
    split = ordered.running_totals(counts, ["g"], "score", ["pos", "neg"], rows_per_task=50)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.select(plain.columns).collect()))


def test_threshold_recall_never_rises(spark, sf):
    rows = ev.threshold_sweep(scored_orders(spark, sf), "y", "score_a").orderBy("threshold").collect()
    recalls = [r["recall"] for r in rows]
    assert len(rows) == 80 and recalls == sorted(recalls, reverse=True)
    assert sum(r["best"] for r in rows) == 1
    assert max(r["f1"] for r in rows) == next(r["f1"] for r in rows if r["best"])


@pytest.fixture(scope="module")
def labelled(spark):
    # One class holds a third of the rows, another a handful.
    return store(spark.range(3001).select("id", F.when(F.col("id") % 3 == 0, 1).when(F.col("id") < 8, 2)
                                          .otherwise(0).alias("y")), "labelled")


def test_folds_are_even_and_partition_free(spark, labelled):
    first = sm.stratified_folds(labelled, "id", ["y"], 5)
    again = sm.stratified_folds(labelled.repartition(7, "y"), "id", ["y"], 5)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    for r in (first.groupBy("y", "fold").count().groupBy("y")
              .agg(F.min("count").alias("lo"), F.max("count").alias("hi"), F.sum("count").alias("n")).collect()):
        assert r["hi"] - r["lo"] <= 1
    assert first.count() == 3001


def test_split_sizes(spark, labelled):
    got = sm.stratified_split(labelled, "id", ["y"], 0.2).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"test": 601, "train": 2400}


def test_resampled_sizes(spark, labelled):
    two = labelled.filter("y < 2")
    sizes = {r["y"]: r["count"] for r in two.groupBy("y").count().collect()}
    under = sm.under_sample(two, "id", "y").groupBy("y").count().collect()
    assert {r["count"] for r in under} == {min(sizes.values())}
    over = sm.over_sample(two, "id", "y")
    assert {r["count"] for r in over.groupBy("y").count().collect()} == {max(sizes.values())}
    copies = over.groupBy("y", "id").count().groupBy("y").agg((F.max("count") - F.min("count")).alias("d"))
    assert max(r["d"] for r in copies.collect()) <= 1


def test_heavy_repeats_are_dealt_in_steps(spark, monkeypatch):
    monkeypatch.setattr(sm, "COPIES_PER_STEP", 7)
    df = store(spark.range(300).select("id", (F.col("id") < 4).cast("int").alias("y")))
    over = sm.over_sample(df, "id", "y")
    assert {r["y"]: r["count"] for r in over.groupBy("y").count().collect()} == {0: 296, 1: 296}
    assert over.select("id", "copy").distinct().count() == 592


def test_fixed_samples_are_the_first_in_hash_order(spark, labelled):
    first = labelled.orderBy(keyed_hash("fixed", F.col("id")), "id").limit(500).collect()
    assert sorted(sm.fixed_sample(labelled, "id", 500).collect()) == sorted(first)
    assert sm.fixed_sample(labelled, "id", 9999).count() == 3001


def test_rows_without_a_class_are_a_class(spark):
    df = store(spark.range(1000).select("id", F.when(F.col("id") % 10 > 0, (F.col("id") % 2).cast("int")).alias("y")), "null-class")
    nulls = F.col("y").isNull()
    folds = sm.stratified_folds(df, "id", ["y"], 5).filter(nulls).groupBy("fold").count().collect()
    assert sorted((r["fold"], r["count"]) for r in folds) == [(i, 20) for i in range(5)]
    split = sm.stratified_split(df, "id", ["y"], 0.2).filter(nulls).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in split} == {"test": 20, "train": 80}
    for sampled, size in ((sm.under_sample(df, "id", "y"), 100), (sm.over_sample(df, "id", "y"), 500)):
        assert {r["count"] for r in sampled.groupBy("y").count().collect()} == {size}
        assert sampled.filter(nulls).count() == size


def test_many_strata(spark):
    """More classes than fit any list: every one has its share."""
    df = store(spark.range(6000).select("id", (F.col("id") % 2000).cast("string").alias("y")), "many")
    split = sm.stratified_split(df, "id", ["y"], 0.5)
    assert split.filter("split = 'test'").count() == 3000
    per = split.groupBy("y").agg(F.count_if(F.col("split") == "test").alias("n")).groupBy("n").count().collect()
    assert {r["n"] for r in per} == {1, 2}


def test_progressive_samples_nest(spark, labelled):
    rows = sm.progressive_samples(labelled, "id", [0.2, 0.5, 1.0])
    sizes = {r["fraction"]: r["count"] for r in rows.groupBy("fraction").count().collect()}
    assert sizes == {0.2: 600, 0.5: 1500, 1.0: 3001}
    small, large = (rows.filter(F.col("fraction") == f).select("id") for f in (0.2, 0.5))
    assert small.join(large, "id", "left_anti").count() == 0


def test_fixed_sample(spark, labelled):
    assert sm.fixed_sample(labelled, "id", 500).select("id").distinct().count() == 500


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(120, 4)).round(1)  # rounding makes ties
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id long, v array<double>")
    for block in (8192, 30):
        rows = nearest_neighbours(df, df, "id", "v", 3, block_rows=block).collect()
        got = {(r["base_id"], r["rank"]): r["neighbour_id"] for r in rows}
        for i in range(120):
            ranked = sorted((np.sqrt(((points[i] - points[j]) ** 2).sum()), j) for j in range(120) if j != i)
            assert [got[(i, r)] for r in (1, 2, 3)] == [j for _, j in ranked[:3]]


def brute_neighbours(points, k):
    out = {}
    for i, p in enumerate(points):
        away = np.sqrt(((points - p) ** 2).sum(axis=1))
        out[i] = [j for _, j in sorted((d, j) for j, d in enumerate(away) if j != i)[:k]]
    return out


@pytest.mark.parametrize("kind", ["grid", "far", "clusters"])
def test_neighbours_with_ties_and_offsets(spark, kind):
    """More ties than any spare candidates, values near 1e8, and clusters whose cells are ruled out."""
    rng = np.random.default_rng(11)
    points = {"grid": rng.integers(0, 3, (400, 2)).astype(float), "far": 1e8 + rng.normal(size=(400, 3)),
              "clusters": rng.normal(size=(400, 3)) + 50 * rng.integers(0, 5, (400, 1))}[kind]
    want = brute_neighbours(points, 3)
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id long, v array<double>")
    for block, cells in ((8_192, 256), (90, 256), (90, 1), (25, 7)):
        got = {}
        for r in nearest_neighbours(df, df, "id", "v", 3, block_rows=block, cells=cells).collect():
            got.setdefault(r["base_id"], {})[r["rank"]] = r["neighbour_id"]
        assert {i: [g[r] for r in (1, 2, 3)] for i, g in got.items()} == want


def test_fewer_rows_than_neighbours(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, None)], "id long, v array<double>")
    got = sorted((r["base_id"], r["neighbour_id"]) for r in nearest_neighbours(df, df, "id", "v", 5).collect())
    assert got == [(1, 2), (2, 1)] and nearest_neighbours(df, df.limit(0), "id", "v", 5).count() == 0


def test_counterfactuals_for_any_number_of_instances(spark):
    rng = np.random.default_rng(3)
    rows = [(i, *map(float, rng.normal(size=2))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, `b.c` double")
    got = ex.nearest_counterfactuals(df.filter("id < 150"), df.filter("id >= 150"), "id", ["a", "b.c"])
    found = {r["instance_id"]: r["pool_id"] for r in got.filter("type = 'counterfactual'").collect()}
    for i, a, b in rows[:150]:
        assert found[i] == min((((x - a) ** 2 + (y - b) ** 2), j) for j, x, y in rows[150:])[1]
    assert got.count() == 450


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, 1.0, "B.Ed", 0), (2, 2.0, "M.Tech", 1), (3, 4.0, "B.Ed", 1), (4, None, None, 0)],
                               "id long, `a.b` double, `deg.ree` string, y int")
    spec = fe.FeatureSpec(numeric=["a.b"], one_hot=["deg.ree"], fill={"a.b": 1.0}, interactions={"a.b^2": ("a.b", "a.b")})
    fitted = fe.fit_features(df, spec)
    assert fitted.names == ["a.b", "a.b^2", "deg.ree_B.Ed", "deg.ree_M.Tech"]
    got = fitted.transform(df).select("id", "features").orderBy("id").collect()
    assert got[1]["features"].toArray().tolist() == pytest.approx([1 / 3, 3 / 15, 0, 1])
    assert pr.box_stats(df, ["a.b"], ["y"]).count() == 2
    assert pr.mean_by_class(df, ["a.b"], "y").first()["class_1"] == 3.0
    assert pr.guarded_corr(df, ["a.b", "y"]).first()["r"] is not None
    assert ev.error_rates(df.withColumn("pred", F.lit(1)), ["deg.ree"], "y", "pred").count() == 2
    assert fe.one_hot(df, "deg.ree", ["B.Ed"]).filter("`deg.ree_B.Ed` = 1").count() == 2
    assert dq.column_profile(df, ["a.b", "deg.ree"]).count() == 2


def test_pair_sums_against_numpy(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 3)) * [1, 100, 1e-3] + [1e6, 0, 5]
    x[rng.random((500, 3)) < 0.2] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) + (7.0,) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, flat double").repartition(5)
    got = {(r["a"], r["b"]): r["r"] for r in pr.guarded_corr(df, ["a", "b", "c", "flat"], digits=9).collect()}
    for i, j in ((0, 1), (0, 2), (1, 2)):
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert got[("abc"[i], "abc"[j])] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-8)
    assert got[("a", "flat")] is None


def test_null_rows_follow_the_comparison(spark):
    df = spark.createDataFrame([(1.0, "a"), (0.0, "b"), (None, None)], "x double, c string")
    assert dq.drop_invalid(df, "x", 0.0).count() == 2
    assert dq.drop_values(df, {"c": ["a"]}).count() == 2
    assert dq.in_range(df, "x", high=5).count() == 2
    assert dq.drop_rare(df, ["c"], 0.6).count() == 1
    assert dq.null_correlation(df, ["x", "c"]).first()["r"] == 1.0
    assert dq.null_correlation(df.fillna(0.0, ["x"]), ["x", "c"]).count() == 0


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "id long, c string")
    assert sorted(r["id"] for r in dq.drop_duplicates(df, ["c"], "id").collect()) == [1, 3, 5]
    assert dq.duplicate_report(df, ["c"], "id").first()["duplicates"] == 2


def test_smote_lies_between_its_ends(spark):
    rng = np.random.default_rng(2)
    rows = [(i, int(i < 12), [float(x) for x in rng.normal(size=3)]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, y int, v array<double>")
    made = sm.smote(df, "id", "y", "v", minority=1).collect()
    assert len(made) == 60 - 24
    at = {i: np.array(v) for i, _, v in rows}
    for r in made:
        a, b, x = at[r["base_id"]], at[r["neighbour_id"]], np.array(r["v"])
        u = (x - a) @ (b - a) / ((b - a) @ (b - a))
        assert 0 <= u < 1 and np.allclose(x, a + u * (b - a))
