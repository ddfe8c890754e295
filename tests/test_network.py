"""The network: gradients against differences, early stopping, the same weights again."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import network as nets, training as tr
from riskframe.plans.bindings import modelling_table


def test_gradient_equals_differences():
    draw = np.random.default_rng(1)
    spec = nets.Spec((4, 3), l2=0.1)
    x, y = draw.normal(size=(7, 5)), draw.integers(0, 2, 7).astype(float)
    w = nets.first_weights(spec, 5) + 0.05

    def loss(weights):
        layers = nets.layers_of(weights, spec, 5)
        z = nets.forward(x, layers)[-1][:, 0]
        return (np.logaddexp(0, z) - y * z).mean() + spec.l2 / 2 / 7 * sum((k[:-1] ** 2).sum() for k in layers)
    step = 1e-6
    plain = [(loss(w + step * e) - loss(w - step * e)) / (2 * step) for e in np.eye(len(w))]
    assert nets.gradient(x, y, w, spec) == pytest.approx(np.array(plain), abs=1e-6)


@pytest.fixture(scope="module")
def train(spark, sf):
    rows, _ = modelling_table(spark, sf)
    return rows.filter("split = 'train'")


@pytest.fixture(scope="module")
def blocks(train):
    return nets.network_blocks(train, F.array("fold"))


def test_training_stops_early_and_repeats(blocks):
    specs = [nets.Spec((8,), 60, 32, 0.01, patience=4, value=i) for i in (0, 1)]
    first, again = nets.fit_many(blocks, specs), nets.fit_many(blocks, specs)
    for a, b in zip(first, again):
        assert (a.weights == b.weights).all() and a.epochs == b.epochs
        assert 4 <= a.epochs < 60 and a.held_out_accuracy > 0.6
    alone = nets.fit_many(blocks, specs[1:])[0]  # models that train together don't touch each other
    assert (alone.weights == first[1].weights).all()


def test_patience_counts_epochs_without_gain(blocks):
    still = nets.Spec((4,), 50, 64, 0.0, patience=3)  # no step changes anything, so the first epoch stays the best
    made = nets.fit_many(blocks, [still])[0]
    assert made.epochs == 3 and (made.weights == nets.first_weights(still, made.size)).all()


def test_held_out_fold_plays_no_part(train):
    flipped = train.withColumn("y", F.when(F.col("fold") == 3, 1 - F.col("y")).otherwise(F.col("y")))
    learner = tr.network((8,), 6)
    scores = [{r["id"]: r["score"] for r in tr.out_of_fold(t, [learner]).filter("fold = 3").collect()} for t in (train, flipped)]
    assert scores[0] and scores[0].keys() == scores[1].keys()
    assert all(scores[0][i] == pytest.approx(scores[1][i], abs=1e-9) for i in scores[0])


def test_scores_hold_the_activations_of_few_rows_at_once():
    spec = nets.Spec()
    net = nets.Network(spec, nets.first_weights(spec, 19), 19, 1, 0.5)
    x = np.random.default_rng(2).normal(size=(20_500, 19))
    tracemalloc.start()
    got = net.probabilities(x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4_000_000  # all at once: 20,500 rows of 128 numbers are 21 MB
    assert np.allclose(got, 1 / (1 + np.exp(-nets.forward(x, nets.layers_of(net.weights, spec, 19))[-1][:, 0])), rtol=1e-12, atol=0)
    assert net.probabilities(x[:0]).shape == (0,)
