"""Proposing the next points of a search over one number.

A Gaussian process on what has been measured stands in for the costly curve; the points with the greatest expected
improvement come next. All of it is small: as many numbers as points measured. What is costly, measuring a batch of
points, is the caller's.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np

#: Candidates for the process's length (of an axis from 0 to 1) and its noise (of a variance of 1).
LENGTHS = np.geomspace(0.03, 1.0, 12)
NOISES = np.geomspace(1e-6, 0.3, 8)


def kernel(a: np.ndarray, b: np.ndarray, length: float) -> np.ndarray:
    """Correlations of a curve that is twice differentiable."""
    gap = math.sqrt(5.0) * np.abs(a[:, None] - b[None, :]) / length
    return (1.0 + gap + gap * gap / 3.0) * np.exp(-gap)


def likelihood(x: np.ndarray, y: np.ndarray, length: float, noise: float) -> float:
    """Log likelihood of the values (mean 0, variance 1), up to a constant."""
    root = np.linalg.cholesky(kernel(x, x, length) + (noise + 1e-10) * np.eye(len(x)))
    half = np.linalg.solve(root, y)
    return float(-0.5 * half @ half - np.log(np.diag(root)).sum())


def posterior(x: np.ndarray, y: np.ndarray, at: np.ndarray, length: float, noise: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of the curve at further points."""
    root = np.linalg.cholesky(kernel(x, x, length) + (noise + 1e-10) * np.eye(len(x)))
    across = np.linalg.solve(root, kernel(x, at, length))
    mean = across.T @ np.linalg.solve(root, y)
    return mean, np.sqrt(np.maximum(1.0 - (across * across).sum(axis=0), 0.0))


def expected_improvement(mean: np.ndarray, deviation: np.ndarray, best: float) -> np.ndarray:
    """How much above ``best`` a point is expected to be, counting what is below as nothing."""
    gain = mean - best
    z = np.divide(gain, deviation, out=np.zeros_like(gain), where=deviation > 0)
    below = 0.5 * (1.0 + np.array([math.erf(v / math.sqrt(2.0)) for v in z]))
    density = np.exp(-0.5 * z * z) / math.sqrt(2.0 * math.pi)
    return np.where(deviation > 0, gain * below + deviation * density, np.maximum(gain, 0.0))


def propose(x: Sequence[float], y: Sequence[float], batch: int, cells: int = 1_000) -> list[float]:
    """The next ``batch`` points of the axis from 0 to 1, given the values measured so far.

    Length and noise are those of the greatest likelihood. A point that is proposed counts as measured, with the value
    expected of it, when the next is chosen. Ties go to the smaller point. No point is proposed twice; on an axis
    whose cells are all taken fewer points come back.
    """
    known, values = np.array(x, float), np.array(y, float)
    spread = values.std()
    values = (values - values.mean()) / (spread if spread > 0 else 1.0)
    length, noise = max(((l, n) for l in LENGTHS for n in NOISES), key=lambda ln: likelihood(known, values, *ln))
    axis = (np.arange(cells) + 0.5) / cells
    chosen: list[float] = []
    for _ in range(batch):
        free = axis[np.abs(axis[:, None] - known[None, :]).min(axis=1) > 0.25 / cells]
        if not len(free):
            break
        reached = posterior(known, values, known, length, noise)[0].max()
        mean, deviation = posterior(known, values, free, length, noise)
        best = int(np.argmax(expected_improvement(mean, deviation, reached)))
        chosen.append(float(free[best]))
        known, values = np.append(known, free[best]), np.append(values, mean[best])
    return chosen


def maximise(measure: Callable[[list[float]], Sequence[float]], count: int, first: int = 6, batch: int = 4
             ) -> list[tuple[float, float, int]]:
    """(point, value, round) of ``count`` points between 0 and 1; ``measure`` gets a round's points at once.

    The first round has ``first`` points spread evenly, later ones ``batch`` proposals each.
    """
    first = min(first, count)
    points = [(i + 0.5) / first for i in range(first)]
    found: list[tuple[float, float, int]] = []
    number = 0
    while points:
        found += [(p, float(v), number) for p, v in zip(points, measure(points))]
        number += 1
        left = min(batch, count - len(found))
        points = propose([p for p, _, _ in found], [v for _, v, _ in found], left) if left else []
    return found
