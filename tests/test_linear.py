"""Many linear models from one scan against single fits and plain versions."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import linear, sampling, training as tr
from riskframe.plans import blocks as bl
from riskframe.plans.bindings import modelling_table


@pytest.fixture(scope="module")
def train(spark, sf):
    rows, _ = modelling_table(spark, sf)
    return rows.filter("split = 'train'")


@pytest.fixture(scope="module")
def rows(train):
    return linear.member_blocks(train, F.array("fold"))


@pytest.fixture(scope="module")
def local(train):
    got = train.select("features", "y", "fold").collect()
    return np.array([r[0].toArray() for r in got]), np.array([r[1] for r in got]), np.array([r[2] for r in got])


def test_every_fold_and_strength_equals_a_single_fit(train, rows):
    specs = [linear.Spec(C, "logistic", 0, "not", i) for C in (0.01, 1.0, 50.0) for i in range(5)]
    fits = linear.fit_many(rows, specs)
    assert fits.passes < 15
    for i, spec in enumerate(specs):
        part = tr.with_balanced_weights(train.filter(F.col("fold") != spec.value))
        single = tr.logistic_regression(part, spec.C, weight="weight").setTol(1e-12).fit(part)
        assert np.abs(fits.coefficients[i] - single.coefficients.toArray()).max() < 1e-4
        assert abs(fits.intercepts[i] - single.intercept) < 1e-4
        assert fits.class_rows[i].tolist() == list(tr.class_counts(train.filter(F.col("fold") != spec.value)).values())


def objective(local, fits, i):
    x, y, fold = local
    spec, keep = fits.specs[i], fold != fits.specs[i].value
    x, y, n = x[keep], y[keep], keep.sum()
    weight = np.where(y == 1, n / (2 * (y == 1).sum()), n / (2 * (y == 0).sum()))
    z = x @ fits.coefficients[i] + fits.intercepts[i]
    loss, _, _ = linear._losses(z[:, None], y, np.array([spec.loss == "hinge"]))
    return (weight * loss[:, 0]).mean() + (fits.coefficients[i] ** 2).sum() / (2 * spec.C * n)


def test_steps_without_curvature_reach_the_same_point(rows, local, monkeypatch):
    specs = [linear.Spec(C, loss, 0, "not", i) for C in (0.1, 10.0) for loss in ("logistic", "hinge") for i in (0, 3)]
    exact = linear.fit_many(rows, specs)
    monkeypatch.setattr(linear, "WIDE", 0)
    other = linear.fit_many(rows, specs, tolerance=1e-6, most=300)
    for i in range(len(specs)):
        assert objective(local, exact, i) <= objective(local, other, i) + 1e-8
        assert objective(local, other, i) == pytest.approx(objective(local, exact, i), abs=1e-5)


def test_rounded_hinge_is_close_to_the_library_s(train, rows, local):
    fits = linear.fit_many(rows, [linear.Spec(1.0, "hinge")])
    single = tr.fit(tr.linear_svm(1.0), train)
    x, y, _ = local
    ours = x @ fits.coefficients[0] + fits.intercepts[0] > 0
    theirs = x @ single.coefficients.toArray() + single.intercept > 0
    assert (ours == theirs).mean() > 0.97


def test_slots_starts_and_models_without_a_class(rows, local):
    some = [1, 4, 7]
    cut = linear.fit_many(rows, [linear.Spec(1.0)], slots=some)
    again = linear.fit_many(rows, [linear.Spec(1.0)], slots=some, start=np.column_stack([cut.coefficients, cut.intercepts]))
    assert cut.coefficients.shape == (1, 3) and again.passes == 1 < cut.passes
    assert np.allclose(again.coefficients, cut.coefficients)
    none = linear.fit_many(rows, [linear.Spec(1.0, "logistic", 0, "upto", 0)])
    assert not none.coefficients.any() and none.class_rows.tolist() == [[0, 0]]


def test_counts_are_those_of_the_scored_rows(train, rows):
    names = ["a"] * 5
    fits = linear.fit_many(rows, [linear.Spec(1.0, "logistic", 0, "not", i) for i in range(5)])
    scored = linear.score_held_out(train, fits, names)
    assert scored.count() == train.count() and scored.select("id").distinct().count() == train.count()
    cells = linear.confusion_of(rows, fits)
    for i in range(5):
        held = scored.filter(F.col("fold") == i).agg(*[F.count_if((F.col("y") == y) & (F.col("pred") == p))
                                                       for y, p in ((1, 1), (0, 1), (1, 0), (0, 0))]).first()
        assert cells[i, 1].tolist() == list(held)
        assert cells[i].sum() == train.count()


def test_nested_levels_are_the_progressive_samples(train):
    sizes = [0.1, 0.35, 1.0]
    got = sampling.nested_levels(train.select("id", "fold"), "id", "fold", 5, sizes, "curve").select("id", "fold", "levels").collect()
    for i in range(5):
        others = train.select("id", "fold").filter(F.col("fold") != i)
        wanted = {(r["id"], r["fraction"]) for r in sampling.progressive_samples(others, "id", sizes, "curve").collect()}
        assert {(r["id"], s) for r in got for k, s in enumerate(sizes) if 1 <= r["levels"][i] <= k + 1} == wanted
        assert all((r["levels"][i] == 0) == (r["fold"] == i) for r in got)


def test_fold_arrays_are_stratified_folds(train):
    drawn = sampling.fold_arrays(train.select("id", "y"), "id", "y", [0, 1], 5, [7, "x"]).collect()
    for j, salt in enumerate(("7", "x")):
        wanted = {r["id"]: r["f"] for r in sampling.stratified_folds(train.select("id", "y"), "id", ["y"], 5, salt, "f").collect()}
        assert {r["id"]: r["folds"][j] for r in drawn} == wanted


def test_learning_curve_from_one_scan_matches_single_fits(train):
    rows = {r["size"]: r for r in tr.learning_curve(train, tr.lr(), [0.25, 1.0], folds=5).collect()}
    plain = tr.learning_curve(train, tr.Learner("single", tr.lr().build), [0.25, 1.0], folds=5).collect()
    for r in plain:  # the samples differ (another salt per fold), their sizes don't; the whole is the same
        assert rows[r["size"]]["train_rows"] == r["train_rows"]
        if r["size"] == 1.0:
            assert rows[1.0]["validation_mean"] == pytest.approx(r["validation_mean"], abs=2e-3)


def test_blocks_and_sums(spark):
    df = spark.range(10_000).select(F.col("id"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v")).repartition(70)
    made = bl.make_blocks(df, "v", {"id": (F.col("id"), "<i8")}, size=64)
    sums = bl.sum_blocks(made, lambda b: {"x": b.x.sum(axis=0), "n": np.array(b.n), "id": b["id"].sum()})
    assert sums["x"].tolist() == [49_995_000.0, 10_000.0] and sums["n"] == 10_000 and sums["id"] == 49_995_000
    assert bl.sum_blocks(bl.make_blocks(df.limit(0), "v", {}), lambda b: {"n": np.array(1)}) == {}
    assert linear.fit_many(linear.member_blocks(df.limit(0).withColumn("y", F.lit(1)), F.array(F.lit(0)), "v"), [linear.Spec()]).passes == 0
    with pytest.raises(Exception):
        bl.make_blocks(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "v array<double>").coalesce(1), "v", {})


@pytest.mark.parametrize("loss", ["logistic", "hinge"])
@pytest.mark.parametrize("size", [7, 129])
def test_curvatures_need_no_array_of_all_products(size, loss):
    """Sums of products of slots, in little more memory than the rows themselves take."""
    draw = np.random.default_rng(3)
    wide, at, y = draw.normal(size=(1_500, size)), 0.1 * draw.normal(size=(4, size)), draw.integers(0, 2, 1_500)
    curve = linear._losses(wide @ at.T, y, np.full(4, loss == "hinge"))[2]
    assert (curve == 0).any() == (loss == "hinge")
    tracemalloc.start()
    got = linear._curvatures(wide, curve).reshape(4, size, size)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < (16 if size < 10 else 8) * wide.nbytes + 2 * got.nbytes
    for m in range(4):
        assert np.allclose(got[m], (wide * curve[:, m, None]).T @ wide, rtol=1e-12, atol=1e-9)


def test_losses_of_mixed_models_equal_those_of_each_kind():
    draw = np.random.default_rng(4)
    z, y = np.concatenate([draw.normal(size=(50, 4)) * 3, [[-800.0, 800.0, -800.0, 800.0]]]), draw.integers(0, 2, 51)
    hinge = np.array([True, False, False, True])
    whole = linear._losses(z, y, hinge)
    for kind in (True, False):
        for all_, own in zip(whole, linear._losses(z[:, hinge == kind], y, np.full(2, kind))):
            assert np.array_equal(all_[:, hinge == kind], own) and np.isfinite(own).all()
    m = (2.0 * y - 1.0)[:, None] * z[:, 1:3]
    assert np.allclose(whole[0][:, 1:3], np.logaddexp(0.0, -m), rtol=1e-14, atol=0)


def test_tasks_share_one_file_of_blocks(spark):
    """One writer's file is one row group by default: a single task of every pass would read all of it."""
    rows = spark.range(16 * 4_096, numPartitions=1).select(F.array(*[F.rand(i) for i in range(64)]).alias("v"))
    blocks = bl.make_blocks(rows, "v", {})
    assert len(blocks.table.inputFiles()) == 1
    shares = [r["n"] for r in blocks.table.groupBy(F.spark_partition_id()).agg(F.sum("n").alias("n")).collect()]
    assert sum(shares) == 16 * 4_096 and len(shares) >= 4 and max(shares) <= 0.4 * sum(shares)


@pytest.mark.parametrize("loss", ["logistic", "hinge"])
def test_many_rows_start_where_some_blocks_end(spark, monkeypatch, loss):
    """Fewer passes over all rows, to the same optimum."""
    rows = spark.range(40_000, numPartitions=4).select("id", F.array(*[F.randn(i) for i in range(6)]).alias("v"), (F.col("id") % 5).alias("fold"))
    rows = rows.withColumn("y", (F.rand(9) < 1 / (1 + F.exp(1.5 * F.col("v")[0] - 2 * F.col("v")[1] + 1))).cast("int"))
    blocks = linear.member_blocks(rows, F.array(F.col("fold").cast("int")), "v")
    specs = [linear.Spec(C, loss, value=i) for C in (0.001, 1.0) for i in range(2)]
    plain = linear.fit_many(blocks, specs)
    monkeypatch.setattr(linear, "_FEW", 10_000)
    quick = linear.fit_many(blocks, specs)
    assert quick.passes < plain.passes
    assert (quick.class_rows == plain.class_rows).all()
    assert np.allclose(quick.coefficients, plain.coefficients, atol=1e-5) and np.allclose(quick.intercepts, plain.intercepts, atol=1e-5)
