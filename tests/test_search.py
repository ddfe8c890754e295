"""The sequential search against plain versions of its parts and against searches without a model."""

import json
import math

import numpy as np
import pytest

from riskframe.operators import surrogate, training as tr
from riskframe.plans.bindings import modelling_table

CURVES = {
    "bump": lambda p: math.exp(-((p - 0.63) / 0.08) ** 2),
    "slope and bump": lambda p: 0.3 * p + 0.8 * math.exp(-((p - 0.22) / 0.05) ** 2),
    "two hills": lambda p: 0.9 * math.exp(-((p - 0.8) / 0.1) ** 2) + math.exp(-((p - 0.3) / 0.06) ** 2),
    "end": lambda p: p ** 3,
}


@pytest.mark.parametrize("name", CURVES)
def test_thirty_points_reach_the_best_of_two_hundred(name):
    curve = CURVES[name]
    found = surrogate.maximise(lambda points: [curve(p) for p in points], 30)
    plain = [math.log(c["C"] / 0.001) / math.log(100_000) for c in tr.log_uniform(200)]
    assert len({p for p, _, _ in found}) == 30
    assert max(v for _, v, _ in found) >= max(map(curve, plain)) - 1e-3
    assert [n for _, _, n in found] == sorted(n for _, _, n in found) and found[5][2] == 0 and found[6][2] == 1


def test_posterior_and_improvement_equal_plain_ones():
    x, y, at = np.array([0.1, 0.4, 0.9]), np.array([0.5, -1.0, 0.7]), np.array([0.2, 0.65])
    mean, deviation = surrogate.posterior(x, y, at, 0.3, 0.01)
    inverse = np.linalg.inv(surrogate.kernel(x, x, 0.3) + 0.01 * np.eye(3))
    across = surrogate.kernel(at, x, 0.3)
    assert mean == pytest.approx(across @ inverse @ y, abs=1e-8)
    assert deviation ** 2 == pytest.approx(1 - np.einsum("ij,jk,ik->i", across, inverse, across), abs=1e-8)
    draws = mean[:, None] + deviation[:, None] * np.random.default_rng(0).standard_normal(400_000)
    assert surrogate.expected_improvement(mean, deviation, 0.2) == pytest.approx(np.maximum(draws - 0.2, 0).mean(axis=1), abs=3e-3)
    assert surrogate.expected_improvement(np.array([1.0, -1.0]), np.zeros(2), 0.2).tolist() == [0.8, 0.0]


def test_flat_curves_and_small_counts():
    assert len(surrogate.maximise(lambda points: [0.5] * len(points), 9)) == 9
    assert [n for _, _, n in surrogate.maximise(lambda points: points, 2)] == [0, 0]
    assert surrogate.maximise(lambda points: points, 0) == []
    assert len(surrogate.propose([0.25], [1.0], 5, cells=2)) == 1


def test_search_measures_what_the_plain_search_does(spark, sf):
    train = modelling_table(spark, sf)[0].filter("split = 'train'")
    found = tr.sequential_search(train, count=10, first=4, batch=3)
    rows = found.collect()
    assert len(rows) == 10 and {r["round"] for r in rows} == {0, 1, 2}
    plain = tr.search(train, "LogisticRegression", [json.loads(r["params"]) for r in rows]).collect()
    assert {r["params"]: r["f1_macro_mean"] for r in rows} == pytest.approx({r["params"]: r["f1_macro_mean"] for r in plain}, abs=2e-3)
    assert max(r["f1_macro_mean"] for r in rows) == rows[[r["place"] for r in rows].index(1)]["f1_macro_mean"]
    assert tr.refit_best(train, found) is not None
