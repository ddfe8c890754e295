"""Feed-forward networks trained in mini-batches (F7), several folds together.

An epoch is one pass over the stored blocks. Every task takes its blocks' rows in an order that follows from their
hashes and the epoch, steps through mini-batches with Adam from the common weights, and the tasks' weights and moments
are averaged by their rows. A held-out share of the training rows is judged in the same pass; training stops when it has
not improved for some epochs, and the best weights stay. A task that runs again makes the same steps.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from riskframe.functions.hashing import mixed
from riskframe.operators.linear import _masks, class_rows
from riskframe.plans.blocks import Block, Blocks, make_blocks, sum_tasks

#: Rows whose activations are held at once when rows are scored: few enough to stay in a core's cache.
_AT_ONCE = 1_000


@dataclass(frozen=True)
class Spec:
    """One network and its training rows (as in ``linear.Spec``)."""

    hidden: tuple[int, ...] = (128, 64, 32)
    epochs: int = 300
    batch: int = 200
    rate: float = 1e-3
    l2: float = 1e-4
    held_out: float = 0.1
    patience: int = 15
    least_gain: float = 1e-4
    seed: int = 42
    group: int = 0
    rule: str = "not"
    value: int | tuple[int, ...] = -1

    @property
    def rows(self) -> tuple:
        return self.group, self.rule, self.value


def shapes(spec: Spec, size: int) -> list[tuple[int, int]]:
    widths = [size, *spec.hidden, 1]
    return [(a + 1, b) for a, b in zip(widths[:-1], widths[1:])]  # the last row of a layer is its bias


def first_weights(spec: Spec, size: int) -> np.ndarray:
    draw = np.random.default_rng(spec.seed)
    layers = []
    for a, b in shapes(spec, size):
        bound = np.sqrt(6.0 / (a - 1 + b))
        layers.append(np.vstack([draw.uniform(-bound, bound, (a - 1, b)), np.zeros((1, b))]).ravel())
    return np.concatenate(layers)


def layers_of(weights: np.ndarray, spec: Spec, size: int) -> list[np.ndarray]:
    out, at = [], 0
    for a, b in shapes(spec, size):
        out.append(weights[at:at + a * b].reshape(a, b))
        at += a * b
    return out


def forward(x: np.ndarray, layers: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Activations of every layer; the last are margins."""
    acts = [x]
    for i, layer in enumerate(layers):
        z = acts[-1] @ layer[:-1]
        z += layer[-1]
        acts.append(np.maximum(z, 0.0, out=z) if i + 1 < len(layers) else z)
    return acts


def gradient(x: np.ndarray, y: np.ndarray, weights: np.ndarray, spec: Spec) -> np.ndarray:
    """Of the mean logistic loss and the penalty l2 / 2 |w|^2 per row of the batch, biases unpenalised."""
    layers = layers_of(weights, spec, x.shape[1])
    acts = forward(x, layers)
    delta = (1.0 / (1.0 + np.exp(-acts[-1])) - y[:, None]) / len(x)
    parts = []
    for i in range(len(layers) - 1, -1, -1):
        own = np.vstack([acts[i].T @ delta + spec.l2 / len(x) * layers[i][:-1], delta.sum(axis=0, keepdims=True)])
        parts.append(own.ravel())
        if i:
            delta = (delta @ layers[i][:-1].T) * (acts[i] > 0)
    return np.concatenate(parts[::-1])


def is_judge(h: np.ndarray, spec: Spec) -> np.ndarray:
    """Rows that judge instead of training."""
    return mixed(h, spec.seed + 17) < np.uint64(int(spec.held_out * 2 ** 64))


@dataclass
class _State:
    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray
    steps: float = 0.0


def _epoch(blocks: Iterator[Block], specs: Sequence[Spec], live: Sequence[int], states: Sequence[_State], epoch: int) -> dict:
    """A task's share of an epoch."""
    own = {m: _State(states[m].weights.copy(), states[m].first.copy(), states[m].second.copy(), states[m].steps) for m in live}
    seen, right = dict.fromkeys(live, 0), {m: np.zeros(2) for m in live}
    for block in blocks:
        masks, kind = _masks(block, specs)
        order = np.argsort(mixed(block["h"], 1_000_003 + epoch), kind="stable")
        for m in live:
            spec, state = specs[m], own[m]
            judge = is_judge(block["h"], spec)
            mask = masks[:, kind[m]]
            held = mask & judge
            if held.any():
                z = forward(block.x[held], layers_of(states[m].weights, spec, block.x.shape[1]))[-1][:, 0]
                right[m] += ((z > 0) == (block["y"][held] == 1)).sum(), held.sum()
            rows = order[(mask & ~judge)[order]]
            for at in range(0, len(rows), spec.batch):
                part = rows[at:at + spec.batch]
                g = gradient(block.x[part], block["y"][part].astype(float), state.weights, spec)
                state.steps += 1
                state.first = 0.9 * state.first + 0.1 * g
                state.second = 0.999 * state.second + 0.001 * g * g
                size = spec.rate * np.sqrt(1 - 0.999 ** state.steps) / (1 - 0.9 ** state.steps)
                state.weights = state.weights - size * state.first / (np.sqrt(state.second) + 1e-8)
            seen[m] += len(rows)
    out = {}
    for m in live:
        out[f"r{m}"] = right[m]
        if seen[m]:
            s = own[m]
            out[f"w{m}"] = seen[m] * np.concatenate([s.weights, s.first, s.second, [s.steps, 1.0]])
    return out


@dataclass
class Network:
    """A fitted network; ``epochs`` it took and the share of held-out rows it gets right."""

    spec: Spec
    weights: np.ndarray
    size: int
    epochs: int
    held_out_accuracy: float

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        layers = layers_of(self.weights, self.spec, self.size)
        out = np.empty(len(x))
        for at in range(0, len(x), _AT_ONCE):
            out[at:at + _AT_ONCE] = forward(x[at:at + _AT_ONCE], layers)[-1][:, 0]
        return 1.0 / (1.0 + np.exp(-out))

    def binned(self, x: np.ndarray) -> np.ndarray:  # as tree ensembles are scored
        return x

    def score_rows(self, df: DataFrame, vector: str = "features") -> DataFrame:
        from riskframe.operators.trees import scored_rows

        return scored_rows(self, df, vector)


def network_blocks(df: DataFrame, member: Column, vector: str = "features", target: str = "y", key: str | None = "id") -> Blocks:
    rows = df.filter(F.col(target).isin(0, 1))
    values = F.col(vector) if df.schema[vector].dataType.typeName() == "array" else vector_to_array(vector)
    spread = F.xxhash64(F.col(key)) if key and key in df.columns else F.xxhash64(values, F.col(target))
    return make_blocks(rows, vector, {"y": (F.col(target).cast("int"), "<i1"), "member": (member, "<i2"), "h": (spread, "<i8")})


def fit_many(blocks: Blocks, specs: Sequence[Spec]) -> list[Network]:
    """Train every network; those without rows of both classes keep their first weights and take no epoch."""
    specs = list(specs)
    first = blocks.table.select(F.octet_length("x").alias("b"), "n").first()
    size = 0 if first is None else first["b"] // np.dtype(blocks.kinds["x"]).itemsize // first["n"]
    rows = class_rows(blocks, specs)
    states = [_State(w, np.zeros_like(w), np.zeros_like(w)) for w in (first_weights(s, size) for s in specs)]
    best = [(-1.0, s.weights, 0) for s in states]
    ran = [0] * len(specs)
    live = [m for m in range(len(specs)) if (rows[m] > 0).all()]
    epoch = 0
    while live:
        now = list(live)
        sums = sum_tasks(blocks, lambda own: _epoch(own, specs, now, states, epoch))
        for m in now:
            spec = specs[m]
            good, judged = sums.get(f"r{m}", np.zeros(2))
            accuracy = good / judged if judged else 0.0
            if accuracy > best[m][0] + spec.least_gain:  # judged with the weights before this epoch
                best[m] = (accuracy, states[m].weights, epoch)
            if epoch >= spec.epochs or (judged and epoch - best[m][2] >= spec.patience) or f"w{m}" not in sums:
                live.remove(m)
                continue
            total = sums[f"w{m}"]
            mean = total[:-1] / total[-1]
            cut = len(states[m].weights)
            states[m] = _State(mean[:cut], mean[cut:2 * cut], mean[2 * cut:3 * cut], mean[-1])
            ran[m] = epoch + 1
            if not judged:
                best[m] = (0.0, states[m].weights, epoch)
        epoch += 1
    return [Network(s, b[1], size, r, max(0.0, b[0])) for s, b, r in zip(specs, best, ran)]
