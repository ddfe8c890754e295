"""Forests and boosted models on the binned matrix against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import training as tr, trees
from riskframe.plans.bindings import modelling_table

DRAW = np.random.default_rng(5)


def small_data(n=400, d=5, bins=8, seed=1):
    draw = np.random.default_rng(seed)
    x = draw.integers(0, bins, (n, d)).astype(np.uint8)
    y = (draw.random(n) < 1 / (1 + np.exp(-(x[:, 0] - 3.5 + (x[:, 1] > 4))))).astype(float)
    return x, y


def plain_split(x, g, h, l2, min_weight, min_rows):
    best = (0.0, 0, 0)
    for f in range(x.shape[1]):
        for c in range(int(x.max())):
            low = x[:, f] <= c
            if min(low.sum(), (~low).sum()) < min_rows or min(h[low].sum(), h[~low].sum()) < min_weight:
                continue
            gain = 0.5 * (g[low].sum() ** 2 / (h[low].sum() + l2) + g[~low].sum() ** 2 / (h[~low].sum() + l2) - g.sum() ** 2 / (h.sum() + l2))
            if gain > best[0] + 1e-12:
                best = (gain, f, c)
    return best


def plain_boost(x, y, spec, positive_weight):
    """Round by round, level by level or best leaf first, by recomputing every sum."""
    margin, gains = np.zeros(len(y)), []
    for _ in range(spec.trees):
        p = 1 / (1 + np.exp(-margin))
        w = np.where(y == 1, positive_weight, 1.0)
        g, h = w * (y - p), w * p * (1 - p)
        leaves = [(np.ones(len(y), bool), 0)]
        done = []
        while leaves and (not spec.leaves or len(leaves) + len(done) < spec.leaves):
            found = [plain_split(x[r], g[r], h[r], spec.l2, spec.min_weight, spec.min_rows) if not spec.depth or k < spec.depth
                     else (0.0, 0, 0) for r, k in leaves]
            at = int(np.argmax([f[0] for f in found]))
            gain, f, c = found[at]
            if gain <= spec.min_gain:
                break
            rows, k = leaves.pop(at)
            gains.append(gain)
            leaves += [(rows & (x[:, f] <= c), k + 1), (rows & (x[:, f] > c), k + 1)]
        for rows, _ in leaves + done:
            margin[rows] += spec.rate * g[rows].sum() / (h[rows].sum() + spec.l2)
    return margin, gains


@pytest.mark.parametrize("spec", [
    trees.Spec("boosted", 3, 3, rate=0.3), trees.Spec("boosted", 3, 0, 6, 10, rate=0.1, l2=0.0, min_weight=1e-3),
    trees.Spec("boosted", 2, 2, rate=0.5, l2=2.0, min_gain=0.5)], ids=["levels", "leaves", "gain"])
def test_boosting_equals_a_plain_version(spec):
    x, y = small_data()
    made = trees.boost_whole(x, y, np.arange(len(y)), spec, 8, 1.7)
    margin, gains = plain_boost(x, y, spec, 1.7)
    model = trees.Ensemble(spec, made, [], 5)
    assert model.margins(x) == pytest.approx(margin, abs=1e-9)
    ours = sorted(g for t in made for g in t.gain[t.feature >= 0])
    assert ours == pytest.approx(sorted(gains), abs=1e-9)


def test_splits_by_rows_and_by_histograms_agree():
    x, y = small_data(300)
    node = DRAW.integers(0, 4, 300)
    h = DRAW.integers(1, 4, 300).astype(float)
    every = np.tile(np.arange(5), (4, 1))
    by_rows = trees.row_splits(x, node, 4, every, 8, h * y, h, 3)
    by_bins = trees.best_splits(*trees.histograms(x, node, 4, 8, (h * y, h, None)), 0.0, 0.0, 3)
    for k in range(4):
        plain = plain_split(x[node == k], (h * y)[node == k], h[node == k], 0.0, 0.0, 3)
        for got in (by_rows, by_bins):
            assert got[0][k] == pytest.approx(plain[0]) and (got[1][k], got[2][k]) == plain[1:]


def leaves_are_done(tree, x, y, weight, min_split=2):
    leaf = tree.leaf_of(x)
    for one in np.unique(leaf[weight > 0]):
        own = (leaf == one) & (weight > 0)
        assert tree.feature[one] < 0
        assert len(np.unique(y[own])) == 1 or len(np.unique(x[own], axis=0)) == 1 or own.sum() < min_split
        assert tree.value[one] == pytest.approx(np.average(y[own], weights=weight[own]))


def test_forest_trees_grow_until_leaves_are_pure():
    x, y = small_data(600, 4, 6)
    for t in range(3):
        weight = trees.bootstrap_counts(np.arange(600), trees.Spec(), t) * np.where(y == 1, 1.3, 0.8)
        leaves_are_done(trees.grow_pure(x, y, weight, trees.Spec(), t, 6), x, y, weight)
    stairs = np.arange(256, dtype=np.uint8)[:, None]
    labels = (np.arange(256) % 2).astype(float)
    deep = trees.grow_pure(stairs, labels, np.ones(256), trees.Spec(), 0, 256)
    depth, at = 0, [0]
    while at := [c for n in at if deep.feature[n] >= 0 for c in (deep.left[n], deep.left[n] + 1)]:
        depth += 1
    assert depth > 30 and (deep.value[deep.leaf_of(stairs)] == labels).all()  # deeper than a library's limit
    limited = trees.grow_pure(x, y, np.ones(600), trees.Spec(depth=3, min_split=40), 0, 6)
    assert len(limited.feature) <= 15


def test_bootstrap_counts_are_poisson():
    counts = trees.bootstrap_counts(np.arange(200_000), trees.Spec(), 3)
    assert counts.mean() == pytest.approx(1, abs=0.01) and counts.var() == pytest.approx(1, abs=0.02)
    assert (counts == 0).mean() == pytest.approx(np.exp(-1), abs=0.005)


@pytest.fixture(scope="module")
def train(spark, sf):
    rows, _ = modelling_table(spark, sf)
    return rows.filter("split = 'train'")


@pytest.fixture(scope="module")
def blocks(train):
    edges = trees.bin_edges(train, bins=16)
    return trees.binned_blocks(train, edges, F.array("fold")), edges


def everything(blocks):
    rows = blocks.table.collect()
    parts = [(np.frombuffer(r["x"], "u1").reshape(r["n"], -1), np.frombuffer(r["y"], "<i1"), np.frombuffer(r["h"], "<i8"),
              np.frombuffer(r["member"], "<i2")) for r in rows]
    return [np.concatenate(a) for a in zip(*parts)]


def test_passes_over_the_table_give_the_trees_of_memory(blocks):
    rows, edges = blocks
    specs = [trees.Spec("boosted", 4, 3, rate=0.3, value=i, subsample=s) for i, s in ((0, 1.0), (2, 0.7))]
    specs.append(trees.Spec("boosted", 3, 0, 5, 20, l2=0.0, min_weight=1e-3, value=1))
    in_memory = trees.fit_many(rows, specs, edges)
    counts = np.array([m.class_rows for m in in_memory])
    by_passes = trees.boost_by_passes(rows, specs, counts, len(edges), max(len(e) + 1 for e in edges), keep=2)
    for a, b in zip(in_memory, by_passes):
        assert len(a.trees) == len(b) == a.spec.trees
        for s, t in zip(a.trees, b):
            assert s.feature.tolist() == t.feature.tolist() and s.cut.tolist() == t.cut.tolist()
            assert s.value == pytest.approx(t.value, abs=1e-9) and s.gain == pytest.approx(t.gain, abs=1e-6)


def test_forest_with_large_nodes_is_pure_too(blocks):
    rows, edges = blocks
    x, y, h, fold = everything(rows)
    spec = trees.Spec("forest", 3, value=1)
    model = trees.fit_many(rows, [spec], edges, whole_rows=200)[0]
    low, high = trees._class_weights(model.class_rows)
    own = fold != 1
    for t, tree in enumerate(model.trees):
        weight = trees.bootstrap_counts(h[own], spec, t) * np.where(y[own] == 1, high, low)
        leaves_are_done(tree, x[own], y[own].astype(float), weight)
    usual = trees.fit_many(rows, [spec], edges)[0]
    held = ~own
    for m in (model, usual):
        assert ((m.probabilities(x[held]) > 0.5) == y[held]).mean() > 0.6


def test_held_out_labels_play_no_part(train):
    learners = [tr.forest(5), tr.boosted(5, depth=3), tr.leafwise(5)]
    flipped = train.withColumn("y", F.when(F.col("fold") == 2, 1 - F.col("y")).otherwise(F.col("y")))
    got = {}
    for name, rows in (("plain", train), ("flipped", flipped.repartition(5))):
        out = tr.out_of_fold(rows, learners).filter("fold = 2")
        got[name] = {(r["model"], r["id"]): round(r["score"], 9) for r in out.collect()}
    assert len(got["plain"]) == 3 * train.filter("fold = 2").count() and got["plain"] == got["flipped"]


def test_scores_and_importances(train):
    model = tr.fit(tr.boosted(10, depth=3), train)
    scored = tr.score(model, train)
    assert scored.columns == [*train.columns, "pred", "score"] and scored.schema["features"].dataType == train.schema["features"].dataType
    assert model.importances.sum() == pytest.approx(1) and model.importances.min() >= 0
    one_class = trees.fit_many(*[(b, [trees.Spec("forest", 2)], e) for e in [trees.bin_edges(train)]
                                 for b in [trees.binned_blocks(train.filter("y = 1"), e, F.array("fold"))]][0])[0]
    assert one_class.trees == []


def test_bins_keep_few_values_apart(spark):
    df = spark.createDataFrame([([float(i % 3), float(i)],) for i in range(1_000)], "features array<double>")
    edges = trees.bin_edges(df, bins=16)
    assert edges[0].tolist() == [0.5, 1.5] and len(edges[1]) == 15
    assert trees.binned(np.array([[-5.0, 1e9], [1.0, 0.0]]), edges).tolist() == [[0, 15], [1, 0]]


def expectation(tree, row, known, node=0):
    """Value of the tree where only the slots in ``known`` are given."""
    if tree.feature[node] < 0:
        return tree.value[node]
    slot, left = tree.feature[node], tree.left[node]
    if slot in known:
        return expectation(tree, row, known, left + (row[slot] > tree.cut[node]))
    return sum(expectation(tree, row, known, c) * tree.cover[c] for c in (left, left + 1)) / tree.cover[node]


def test_contributions_equal_enumeration_over_subsets():
    from itertools import combinations
    from math import factorial

    x, y = small_data(500, 5, 8, seed=4)
    grown = [trees.boost_whole(x, y, np.arange(500), trees.Spec("boosted", 2, 4, rate=0.3), 8, 1.0)[1],
             trees.grow_pure(x, y, np.ones(500), trees.Spec(depth=4), 0, 8)]
    for tree in grown:
        base, phi = trees.contributions(tree, x[:12])
        assert base == pytest.approx(expectation(tree, x[0], ()))
        for row in range(12):
            for j in range(5):
                others = [i for i in range(5) if i != j]
                plain = sum(factorial(k) * factorial(4 - k) / factorial(5) * (expectation(tree, x[row], {*s, j}) - expectation(tree, x[row], s))
                            for k in range(5) for s in combinations(others, k))
                assert phi[row, j] == pytest.approx(plain, abs=1e-6)


def test_contributions_add_up_to_the_margin(train):
    from riskframe.operators import explanation as ex

    names = [f"x{i}" for i in range(20)]
    for learner in (tr.tree(3), tr.forest(3, 6), tr.boosted(5, depth=4)):
        model = tr.fit(learner, train)
        if not isinstance(model, trees.Ensemble):
            continue
        rows = ex.tree_contributions(train, model, names)
        assert rows.count() == 20 * train.count()
        sums = rows.groupBy("id").agg((F.sum("phi") + F.first("base")).alias("margin"))
        shown = F.col("margin") if learner.trees.kind == "forest" else 1 / (1 + F.exp(-F.col("margin")))
        gap = tr.score(model, train).join(sums, "id").agg(F.max(F.abs(F.col("score") - shown))).first()[0]
        assert gap < 1e-5


def test_forests_stay_stored_and_score_as_in_memory(train, blocks):
    """Neither fitting nor scoring brings the trees to the driver; tops grown by passes count too."""
    from pyspark.ml.functions import vector_to_array

    rows, edges = blocks
    models = {"whole": trees.fit_many(rows, [trees.Spec("forest", 5)], edges)[0],
              "passes": trees.fit_many(rows, [trees.Spec("forest", 3)], edges, whole_rows=200)[0]}
    for model in models.values():
        for together in (1_000_000, 100):
            got = trees.forest_scores(train, {0: model}, F.lit(0), together=together)
            assert got.columns == [*train.columns, "pred", "score"] and model._trees is None
            found = {r["id"]: (r["pred"], r["score"]) for r in got.collect()}
            assert len(found) == train.count() and model._trees is None
            mine = model.in_memory()
            model._trees = None
            data = train.select("id", vector_to_array("features").alias("x")).collect()
            plain = mine.probabilities(mine.binned(np.array([r["x"] for r in data])))
            for r, p in zip(data, plain):
                assert found[r["id"]] == (int(p > 0.5), pytest.approx(p, abs=1e-9))
    some = train.withColumn("which", F.when(F.col("id") % 2 == 0, 0).otherwise(7))
    assert trees.forest_scores(some, {0: models["whole"]}, F.col("which")).count() == some.filter("which = 0").count()


def test_contributions_by_patterns_are_those_by_rows():
    """Leaves of few slots by tables of their patterns, others row by row: both as tree by tree."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, (400, 14)).astype(np.uint8)
    y = ((x[:, 0] > 5) ^ (x[:, 1] > 3) ^ (rng.random(400) < 0.2)).astype(float)
    for spec in (trees.Spec("boosted", 6, 4), trees.Spec("forest", 3)):
        if spec.kind == "boosted":
            grown = trees.boost_whole(x, y, np.arange(400), spec, 12, 1.0)
        else:
            grown = [trees.grow_pure(x, y, trees.bootstrap_counts(np.arange(400), spec, t).astype(float), spec, t, 12) for t in range(3)]
        model = trees.Ensemble(spec, grown, [np.arange(11) + 0.5] * 14, 14)
        made = trees.prepared_contributions(model)
        assert any(len(leaf.slots) > trees.PATTERNS for leaf in made.leaves) == (spec.kind == "forest")
        base, phi = made.of(x)
        plain = [trees.contributions(t, x) for t in grown]
        many = 3 if spec.kind == "forest" else 1
        assert base == pytest.approx(sum(b for b, _ in plain) / many) and phi == pytest.approx(sum(c for _, c in plain) / many, abs=1e-12)


@pytest.mark.parametrize("many", [1, 300, 70_000, 3 * 2 ** 32])
def test_order_by_counting_is_the_stable_one(many):
    key = np.random.default_rng(6).integers(0, many, 5_000)
    assert np.array_equal(trees.stable_order(key, many), np.argsort(key, kind="stable"))


def test_boosted_models_have_a_wider_bound_than_forests(blocks, monkeypatch):
    """Passes of all rounds and levels are for tables that no group can hold."""
    rows, edges = blocks
    monkeypatch.setattr(trees, "WHOLE_ROWS", 200)
    monkeypatch.setattr(trees, "boost_by_passes", None)
    boosted, forest = trees.fit_many(rows, [trees.Spec("boosted", 2, 3), trees.Spec("forest", 2)], edges)
    assert len(boosted.trees) == 2 and forest.tops is not None


def test_all_tasks_work_on_the_blocks_of_one_writer(spark):
    rows = spark.range(64 * 1_000, numPartitions=1).select(
        "id", (F.col("id") % 2).cast("int").alias("y"), F.array(*[F.rand(i) for i in range(20)]).alias("v"))
    blocks = trees.binned_blocks(rows, [np.linspace(0, 1, 60)] * 20, F.array(F.lit(0)), "v")
    shares = [r["n"] for r in blocks.table.groupBy(F.spark_partition_id()).agg(F.sum("n").alias("n")).collect()]
    assert sum(shares) == 64_000 and len(shares) >= 3 and max(shares) <= 0.5 * sum(shares)


def test_joint_bins_are_the_bins_of_slots():
    rng = np.random.default_rng(7)
    sizes = [40, 2, 2, 3, 60, 2, 5]
    x = np.stack([rng.integers(0, n, 900) for n in sizes], axis=1).astype(np.uint8)
    node, g = rng.integers(-1, 5, 900), rng.normal(size=900)
    joint = trees.bundled_histograms(x, node, 5, sizes, (g, None))
    assert sorted(j for own in trees.bundles(sizes) for j in own) == list(range(7)) and len(trees.bundles(sizes)) < 5
    assert joint.shape[2] < 7 * 60
    plain = np.array(trees.histograms(x, node, 5, 60, (g, None)))
    assert trees.unbundled(joint, sizes, 60) == pytest.approx(plain, abs=1e-9)


def test_passes_hold_their_blocks_and_leave_none(blocks, monkeypatch):
    """Passes of a boosted model read its table once between two stored margins; margins held or stored in between don't change it."""
    rows, edges = blocks
    monkeypatch.setattr(trees, "sum_blocks", None)
    spark = rows.table.sparkSession
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    spec = trees.Spec("boosted", 6, 3, rate=0.3, value=1)
    counts = np.array([[500, 400]])
    stored, kept = [], trees._stored_margins
    monkeypatch.setattr(trees, "_stored_margins", lambda *a: stored.append(kept(*a)) or stored[-1])
    found = [trees.boost_by_passes(rows, [spec], counts, len(edges), 16, keep, [len(e) + 1 for e in edges], links)[0]
             for keep, links in ((1, 2), (10, 10))]
    assert len(stored) == 2 and spark.sparkContext._jsc.getPersistentRDDs().size() == before
    for a, b in zip(*found):
        assert a.feature.tolist() == b.feature.tolist() and a.cut.tolist() == b.cut.tolist() and a.value == pytest.approx(b.value, abs=1e-9)


def test_small_blocks_are_dealt_together():
    from riskframe.plans.blocks import Block, joined

    kinds = {"x": "u1", "y": "<i1"}
    parts = [Block.plain(n, (bytes(range(2 * n)), bytes([n] * n)), kinds) for n in (3, 1, 2, 4, 1)]
    made = list(joined(parts, 4))
    assert [b.n for b in made] == [4, 6, 1] and all(b.x.shape == (b.n, 2) for b in made)
    assert np.array_equal(np.concatenate([b["y"] for b in made]), np.concatenate([b["y"] for b in parts]))
    assert np.array_equal(np.concatenate([b.x for b in made]), np.concatenate([b.x for b in parts]))
