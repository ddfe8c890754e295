"""Nearest neighbours: what leaves the pool, and which leaves a query visits."""

import numpy as np

from riskframe.plans import neighbours as nb


def test_equal_vectors_keep_their_smallest_keys_only(spark):
    rows = [(i, [float(i % 2)]) for i in range(400)] + [(1, [1.0])] * 9 + [(5, [0.0]), (None, [7.0])]
    pool = spark.createDataFrame(rows, "id long, v array<double>")
    kept = sorted((r["v"][0], -1 if r["id"] is None else r["id"]) for r in nb._worth_keeping(pool, 2).collect())
    assert kept == [(0.0, 0), (0.0, 2), (0.0, 4), (1.0, 1), (1.0, 1), (1.0, 3), (1.0, 5), (7.0, -1)]


def test_repeated_keys_and_tied_vectors_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(nb, "_SHARE", 40)  # several shares of queries
    draw = np.random.default_rng(8)
    grid = [(int(i), [float(a), float(b)]) for i, a, b in zip(draw.integers(0, 150, 300), draw.integers(0, 6, 300), draw.integers(0, 6, 300))]
    rows = [*dict(grid).items(), (151, [40.0, -3.0])]
    pool = [*rows, *rows[:30], (152, [40.0, -3.0]), (152, [0.0, 0.0])]  # repeats, and a key with two vectors
    made = spark.createDataFrame(pool, "id long, v array<double>")
    got = {}
    for r in nb.nearest_neighbours(spark.createDataFrame(rows, made.schema), made, "id", "v", 4, block_rows=8, cells=32).collect():
        got.setdefault(r["base_id"], {})[r["rank"]] = (r["distance"], r["neighbour_id"])
    for base, v in rows:
        best = sorted((float(np.sqrt(((np.array(w) - v) ** 2).sum())), i) for i, w in pool if i != base)[:4]
        assert [got[base][rank + 1] for rank in range(4)] == best


def test_leaves_farther_than_the_limit_are_not_visited():
    draw = np.random.default_rng(9)
    rows = np.concatenate([draw.normal(size=(500, 3)) + 50 * c for c in range(8)])
    tree = nb._Tree.grow(rows, 64)
    own = tree.settle(rows)
    assert tree.leaves == 64 and np.bincount(own, minlength=64).max() < 200
    low = np.array([rows[own == c].min(axis=0) for c in range(64)])
    high = np.array([rows[own == c].max(axis=0) for c in range(64)])
    row, leaf = tree.within(rows, np.full(len(rows), 0.5), *tree.boxes(low, high))
    visited = {*zip(row.tolist(), leaf.tolist())}
    assert len(visited) == len(row) < 16 * len(rows)
    away = np.sqrt(((rows[:300, None] - rows[None, :]) ** 2).sum(axis=2))
    assert all((a, own[b]) in visited for a, b in zip(*np.nonzero(away <= 0.5)))


def test_equal_rows_make_one_leaf():
    tree = nb._Tree.grow(np.zeros((10, 2)), 4)
    assert tree.leaves == 1 and tree.settle(np.ones((3, 2))).tolist() == [0, 0, 0]
