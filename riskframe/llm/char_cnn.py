"""A small character convolutional network in numpy.

Characters are embedded, one convolution reads the window, and its strongest answers inside the candidate and around it
feed a logistic output. It is trained with Adam; a second, held-out set of windows calibrates the output (Platt scaling)
and sets the threshold that keeps a wanted recall. ``train`` and ``calibrate`` work on arrays; the parts they are made of
also serve tasks that hold a share of the windows each.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np

BEFORE, INSIDE, AFTER = 32, 48, 12
LENGTH = BEFORE + INSIDE + AFTER
_ALPHABET = 130  # ASCII, any other character, none
#: Windows whose answers are held at once: few enough to stay in a core's cache.
_AT_ONCE = 128


def encode_window(text: str, start: int, end: int) -> np.ndarray:
    """Codes of the characters around and inside ``text[start:end]``; only the first ``INSIDE`` of a longer stretch."""
    end = min(end, start + INSIDE)
    codes = np.full(LENGTH, 129, np.uint8)

    def put(at: int, piece: str) -> None:
        codes[at:at + len(piece)] = [min(ord(c), 128) for c in piece]
    before = text[max(0, start - BEFORE):start]
    put(BEFORE - len(before), before)
    put(BEFORE, text[start:end])
    put(BEFORE + INSIDE, text[end:end + AFTER])
    return codes


def candidate_windows(text: str, start: int, end: int) -> list[np.ndarray]:
    """A window for every ``INSIDE`` characters, so that a long candidate is seen whole."""
    return [encode_window(text, at, min(end, at + INSIDE)) for at in range(start, end, INSIDE)]


class CharCnn(NamedTuple):
    """Weights, calibration and threshold."""

    embed: np.ndarray   # alphabet x d
    kernel: np.ndarray  # width * d x filters
    bias: np.ndarray
    out: np.ndarray     # 2 * filters
    shift: float
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 0.5

    def _answers(self, codes: np.ndarray) -> np.ndarray:
        """Every filter's answer at every step, without its bias: windows x steps x filters."""
        width, d = self.kernel.shape[0] // self.embed.shape[1], self.embed.shape[1]
        seen = self.embed[codes].reshape(len(codes), -1)
        read = np.lib.stride_tricks.sliding_window_view(seen, width * d, axis=1)[:, ::d]  # n, steps, width * d
        read = np.ascontiguousarray(read).reshape(-1, width * d)
        return (read @ self.kernel).reshape(len(codes), -1, self.kernel.shape[1])

    def logits(self, codes: np.ndarray) -> np.ndarray:
        out = np.empty(len(codes))
        for at in range(0, len(codes), _AT_ONCE):
            answers = self._answers(codes[at:at + _AT_ONCE])
            inside, before, after = answers[:, BEFORE:BEFORE + INSIDE], answers[:, :BEFORE], answers[:, BEFORE + INSIDE:]
            strongest = np.concatenate([inside.max(axis=1), np.maximum(before.max(axis=1), after.max(axis=1))], axis=1)
            strongest += np.concatenate([self.bias, self.bias])
            out[at:at + _AT_ONCE] = np.maximum(strongest, 0.0) @ self.out + self.shift
        return out

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of being a secret."""
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * self.logits(codes) + self.offset, -60, 60)))


Weights = dict[str, np.ndarray]


class State(NamedTuple):
    """Weights under training, Adam's two moments of each and the steps taken."""

    weights: Weights
    first: Weights
    second: Weights
    steps: float = 0.0

    def net(self) -> CharCnn:
        w = self.weights
        return CharCnn(w["embed"], w["kernel"], w["bias"], w["out"], float(w["shift"][0]))


def first_state(filters: int = 24, width: int = 5, d: int = 8, seed: int = 5) -> State:
    rng = np.random.default_rng(seed)
    weights = {"embed": rng.normal(0, 0.3, (_ALPHABET, d)), "kernel": rng.normal(0, 0.2, (width * d, filters)),
               "bias": np.zeros(filters), "out": rng.normal(0, 0.2, 2 * filters), "shift": np.zeros(1)}
    weights = {k: v.astype(np.float32) for k, v in weights.items()}
    return State(weights, {k: np.zeros_like(v) for k, v in weights.items()}, {k: np.zeros_like(v) for k, v in weights.items()})


def _gradient(net: CharCnn, codes: np.ndarray, labels: np.ndarray, weight_of: np.ndarray) -> Weights:
    """Of the weighted mean cross entropy of some windows."""
    n, filters, (alphabet, d) = len(codes), len(net.bias), net.embed.shape
    answers = net._answers(codes)
    inside = answers[:, BEFORE:BEFORE + INSIDE].argmax(axis=1) + BEFORE
    ends = [answers[:, :BEFORE], answers[:, BEFORE + INSIDE:]]
    before, after = (e.argmax(axis=1) for e in ends)
    line, place = np.arange(n)[:, None], np.arange(filters)[None, :]
    outside = np.where(ends[0][line, before, place] >= ends[1][line, after, place], before, after + BEFORE + INSIDE)
    places = np.concatenate([inside, outside], axis=1)  # n, 2 * filters
    both = np.concatenate([place, place], axis=1)
    strongest = np.maximum(answers[line, places, both] + net.bias[both], 0.0)
    p = 1.0 / (1.0 + np.exp(-np.clip(strongest @ net.out + np.float32(net.shift), -60, 60)))
    error = ((p - labels) * weight_of / n).astype(np.float32)
    passed = error[:, None] * net.out[None, :] * (strongest > 0)
    width = net.kernel.shape[0] // d
    reached = codes[line[:, :, None], places[:, :, None] + np.arange(width)]  # characters read: n, 2 * filters, width
    cells = (reached * np.intp(width) + np.arange(width)) * filters + both[:, :, None]
    reads = np.bincount(cells.ravel(), np.repeat(passed.ravel(), width), alphabet * width * filters).astype(np.float32)
    reads = reads.reshape(alphabet, width, filters)  # by character, its place in the window read, and filter
    embed = np.tensordot(reads, net.kernel.reshape(width, d, filters), ((1, 2), (0, 2)))
    kernel = np.tensordot(reads, net.embed, (0, 0)).transpose(0, 2, 1).reshape(width * d, filters)
    return {"embed": embed, "kernel": kernel,
            "bias": (passed[:, :filters] + passed[:, filters:]).sum(axis=0), "out": strongest.T @ error,
            "shift": error.sum(keepdims=True)}


def step(state: State, codes: np.ndarray, labels: np.ndarray, weight_of: np.ndarray, rate: float) -> State:
    """One step of Adam on some windows; the state given is left as it is."""
    grads = _gradient(state.net(), codes, labels, weight_of)
    t = state.steps + 1
    first = {k: v + np.float32(0.1) * (grads[k] - v) for k, v in state.first.items()}
    second = {k: v + np.float32(0.001) * (grads[k] ** 2 - v) for k, v in state.second.items()}
    by, root = np.float32(rate / (1 - 0.9 ** t)), np.float32(1 / np.sqrt(1 - 0.999 ** t))
    return State({k: v - by * first[k] / (np.sqrt(second[k]) * root + np.float32(1e-8)) for k, v in state.weights.items()},
                 first, second, t)


def class_weights(windows: tuple[float, float]) -> np.ndarray:
    """Weight of a window of each label, from the numbers of windows of each."""
    share = np.array(windows, float) / max(1, sum(windows))
    return (0.5 / np.maximum(share, 1e-6)).astype(np.float32)


def train(codes: np.ndarray, labels: np.ndarray, filters: int = 24, width: int = 5, d: int = 8, epochs: int = 8,
          rate: float = 0.01, seed: int = 5) -> CharCnn:
    """Weights fitted by Adam on class-balanced cross entropy."""
    rng = np.random.default_rng(seed)
    state = first_state(filters, width, d, seed)
    weight_of = class_weights((int((labels != 1).sum()), int((labels == 1).sum())))[(labels == 1).astype(int)]
    for _ in range(epochs):
        order = rng.permutation(len(codes))
        for at in range(0, len(order), 128):
            rows = order[at:at + 128]
            state = step(state, codes[rows], labels[rows], weight_of[rows], rate)
    return state.net()


def fit_scale(sums: Callable[[float, float], np.ndarray]) -> tuple[float, float]:
    """Platt's slope and offset by Newton steps; ``sums`` are ``scale_sums`` of all windows."""
    a, b = 1.0, 0.0
    for _ in range(200):
        s = sums(a, b)
        g = np.array([s[0] + 1e-6 * a, s[1]])
        h = np.array([[s[2] + 1e-6, s[3]], [s[3], s[4]]])
        move = np.linalg.solve(h + 1e-9 * np.eye(2), g)
        a, b = a - np.clip(move[0], -2, 2), b - np.clip(move[1], -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return float(a), float(b)


def scale_sums(x: np.ndarray, target: np.ndarray, a: float, b: float) -> np.ndarray:
    """The gradient and the curvature of the cross entropy in slope and offset."""
    p = 1 / (1 + np.exp(-np.clip(a * x + b, -60, 60)))
    w = p * (1 - p) + 1e-9
    return np.array([((p - target) * x).sum(), (p - target).sum(), (w * x * x).sum(), (w * x).sum(), w.sum()])


def scale_targets(negatives: int, positives: int) -> np.ndarray:
    """Platt's targets of the two labels."""
    return np.array([1 / (negatives + 2), (positives + 1) / (positives + 2)])


def calibrate(net: CharCnn, codes: np.ndarray, labels: np.ndarray, recall: float, false: float = 0.0005) -> CharCnn:
    """Platt scaling on held-out windows, and the highest threshold that still finds ``recall`` of the positive ones.

    Where words score higher than that, the threshold is above all but ``false`` of the negative ones.
    """
    z = net.logits(codes)
    slope, offset = 1.0, 0.0
    if len(z) and 0 < labels.sum() < len(labels):
        target = scale_targets(int((labels != 1).sum()), int(labels.sum()))[(labels == 1).astype(int)]
        spread = max(float(np.abs(z).max()), 1e-9)
        slope, offset = fit_scale(lambda a, b: scale_sums(z / spread, target, a, b))
        slope /= spread
    net = net._replace(slope=slope, offset=offset)
    found = np.sort(net.probabilities(codes[labels == 1]))
    threshold = float(found[int(np.floor((1 - recall) * len(found)))]) if len(found) else 1.1
    words = np.sort(net.probabilities(codes[labels == 0]))
    if len(words):
        threshold = max(threshold, float(np.nextafter(words[-1 - int(false * len(words))], 2.0)))
    return net._replace(threshold=threshold)
