"""Many linear classifiers from one scan.

Models that differ in their training rows (folds, seeds, sample sizes), strength or slots are fitted together: a pass
over the table carries the losses, gradients and curvatures of all of them as matrices, so a hundred fits cost the
passes of one. Steps are Newton's with halving; beyond ``WIDE`` slots, limited-memory quasi-Newton steps without curvatures.
Over many rows the steps start where the same models of some blocks end; they go on over all rows to the same tolerance.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from riskframe.plans.blocks import ROW_GROUP, Block, Blocks, make_blocks, sum_blocks
from riskframe.plans.storage import store
from riskframe.plans.workers import ready

WIDE = 400
#: Up to this many slots, the intercept among them, all models share the products of slots.
NARROW = 48
#: Half the width of the rounded corner of the hinge.
CORNER = 0.1
_CELLS = 4_000_000
#: About the rows that give models of many more rows (``_MANY`` times) the point from which they start.
_FEW = 131_072
_MANY = 4


@dataclass(frozen=True)
class Spec:
    """One model: ``loss`` is "logistic" or "hinge", ``C`` the inverse strength of the penalty.

    ``group`` picks a number of the row's ``member`` array. The model trains on rows where it is not ``value`` (or none of
    several) if ``rule`` is "not", one of several if it is "in", from 1 to ``value`` if it is "upto". Others are held out.
    """

    C: float = 1.0
    loss: str = "logistic"
    group: int = 0
    rule: str = "not"
    value: int | tuple[int, ...] = -1

    @property
    def rows(self) -> tuple:
        return self.group, self.rule, self.value


@dataclass
class Fits:
    """Coefficients (models x slots), intercepts, rows of each class that the models saw, and passes over the table."""

    specs: list[Spec]
    coefficients: np.ndarray
    intercepts: np.ndarray
    class_rows: np.ndarray
    passes: int


def member_blocks(df: DataFrame, member, vector: str = "features", target: str = "y", weight: str | None = None) -> Blocks:
    """Rows of class 0 or 1 as blocks with their ``member`` array (an expression) and, if named, a weight."""
    rows = df.filter(F.col(target).isin(0, 1))
    columns = {"y": (F.col(target).cast("int"), "<i1"), "member": (member, "<i2")}
    if weight:
        columns["w"] = (F.col(weight).cast("double"), "<f8")
    return make_blocks(rows, vector, columns)


def total_weights(blocks: Blocks, specs: Sequence[Spec]) -> np.ndarray:
    """The weight of every model's training rows, from one pass."""
    def count(block: Block) -> dict:
        masks, kind = _masks(block, specs)
        return {"w": (masks * block.arrays["w"]).sum(axis=0)[kind]}
    return sum_blocks(blocks, count).get("w", np.zeros(len(specs)))


def _masks(block: Block, specs: Sequence[Spec]) -> tuple[np.ndarray, np.ndarray]:
    """(rows x kinds) training masks of the distinct kinds of rows, and every model's kind."""
    kinds = list(dict.fromkeys(s.rows for s in specs))
    member = block.arrays["member"]
    masks = np.empty((block.n, len(kinds)), bool)
    for i, (group, rule, value) in enumerate(kinds):
        own = member[:, group]
        if rule == "upto":
            masks[:, i] = (own >= 1) & (own <= value)
        else:
            masks[:, i] = np.isin(own, value, invert=rule == "not")
    place = {k: i for i, k in enumerate(kinds)}
    return masks, np.array([place[s.rows] for s in specs])


def _losses(z: np.ndarray, y: np.ndarray, hinge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, slope and curvature by margin, of all rows and models."""
    sign = (2.0 * y - 1.0)[:, None]
    t = sign * z
    if hinge.all():
        return _rounded_hinge(t, sign)
    if not hinge.any():
        return _logistic(t, sign)
    both = [np.empty_like(z) for _ in range(3)]
    for own, kind in ((~hinge, _logistic), (hinge, _rounded_hinge)):
        for whole, part in zip(both, kind(t[:, own], sign)):
            whole[:, own] = part
    return tuple(both)


def _logistic(m: np.ndarray, sign: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    small = np.exp(-np.abs(m))  # one exponential serves all three
    p = np.where(m >= 0, small, 1.0) / (1.0 + small)  # probability of the other class
    return np.maximum(-m, 0.0) + np.log1p(small), -p * sign, p * (1.0 - p)


def _rounded_hinge(t: np.ndarray, sign: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    short = 1.0 + CORNER - t
    corner = (short > 0) & (short < 2 * CORNER)
    flat = short >= 2 * CORNER
    loss = np.where(flat, short - CORNER, np.where(corner, short ** 2 / (4 * CORNER), 0.0))
    slope = np.where(flat, -1.0, np.where(corner, -short / (2 * CORNER), 0.0)) * sign
    return loss, slope, np.where(corner, 1.0 / (2 * CORNER), 0.0)


def _curvatures(wide: np.ndarray, curve: np.ndarray) -> np.ndarray:
    """(models x slots * slots) sums of a row's products of two slots, weighted by its curvature under each model.

    Few slots: the products of slots are made once for all models, one triangle of them. More: a matrix product a model, of
    the rows that have a curvature (under the hinge, those in its corner).
    """
    size = wide.shape[1]
    out = np.empty((curve.shape[1], size, size))
    if size <= NARROW:
        i, j = np.triu_indices(size)
        slots = np.ascontiguousarray(wide.T)
        out[:, i, j] = curve.T @ (slots[i] * slots[j]).T
        out[:, j, i] = out[:, i, j]
    else:
        for m in range(len(out)):
            at = np.flatnonzero(curve[:, m])
            rows = wide[at]
            np.matmul((rows * curve[at, m, None]).T, rows, out=out[m])
    return out.reshape(len(out), size * size)


def class_rows(blocks: Blocks, specs: Sequence[Spec]) -> np.ndarray:
    """(models x 2) training rows by class, from one pass."""
    def count(block: Block) -> dict:
        masks, kind = _masks(block, specs)
        positive = block["y"] == 1
        both = np.stack([masks[~positive].sum(axis=0), masks[positive].sum(axis=0)], axis=1)
        return {"rows": both[kind].astype(np.int64)}
    return sum_blocks(blocks, count).get("rows", np.zeros((len(specs), 2), np.int64))


def _pass(blocks: Blocks, specs: Sequence[Spec], weights: np.ndarray, slots: np.ndarray | None, at: np.ndarray,
          second: bool) -> dict:
    """Summed loss, gradient and, with ``second``, curvature at ``at`` (models x slots + 1, the intercept last)."""
    hinge = np.array([s.loss == "hinge" for s in specs])

    def work(block: Block) -> dict:
        x = block.x if slots is None else block.x[:, slots]
        size = x.shape[1] + 1
        step = max(64, _CELLS // size ** 2) if second and size <= NARROW else block.n
        masks, kind = _masks(block, specs)
        y = block["y"]
        out = {"loss": np.zeros(len(specs)), "grad": np.zeros((len(specs), size))}
        if second:
            out["hess"] = np.zeros((len(specs), size * size))
        for start in range(0, block.n, step):
            part = slice(start, start + step)
            wide = np.column_stack([x[part], np.ones(len(x[part]))])
            loss, slope, curve = _losses(wide @ at.T, y[part], hinge)
            own = masks[part][:, kind] * weights[:, y[part].astype(np.int64)].T
            if "w" in block.arrays:
                own *= block.arrays["w"][part]
            out["loss"] += (own * loss).sum(axis=0)
            out["grad"] += (own * slope).T @ wide
            if second:
                out["hess"] += _curvatures(wide, own * curve)
        return out
    return sum_blocks(blocks, work)


def fit_many(blocks: Blocks, specs: Sequence[Spec], balanced: bool = True, slots: Sequence[int] | None = None,
             start: np.ndarray | None = None, tolerance: float = 1e-7, most: int = 100, memory: int = 8) -> Fits:
    """Fit every model; each minimises its weighted mean loss plus |w|^2 / (2 C n), the intercept unpenalised.

    Balanced weights are those of the model's own training rows; rows that bear a weight have that instead, and n is its
    sum. ``slots`` cuts the vectors, ``start`` (models x slots +
    1) begins elsewhere than at zero or, with many rows, at ``_start``. A model stops when no part of its gradient exceeds ``tolerance``; models of which
    one class is missing stay at zero. ``most`` bounds the passes.
    """
    specs = list(specs)
    chosen = None if slots is None else np.asarray(slots, np.int64)
    rows = class_rows(blocks, specs)
    first = blocks.table.select(F.octet_length("x").alias("b"), "n").first()
    full = 0 if first is None else first["b"] // np.dtype(blocks.kinds["x"]).itemsize // first["n"]
    size = (full if chosen is None else len(chosen)) + 1
    n = rows.sum(axis=1).astype(float)
    weights = np.ones((len(specs), 2))
    if "w" in blocks.kinds:
        n = total_weights(blocks, specs)
    elif balanced:
        weights = n[:, None] / (2.0 * np.maximum(rows, 1))
    penalty = 1.0 / (np.array([s.C for s in specs]) * np.maximum(n, 1))
    if start is None:
        start = _start(blocks, specs, balanced, slots, tolerance, most, memory)
    x = np.zeros((len(specs), size)) if start is None else np.array(start, float)
    second = size <= WIDE
    live = np.flatnonzero((rows > 0).all(axis=1))
    passes = 0

    def measure(which: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        nonlocal passes
        passes += 1
        per_pass = len(which) if not second else max(1, 16 * _CELLS // size ** 2)
        loss, grad, hess = [], [], []
        for i in range(0, len(which), per_pass):
            some = which[i:i + per_pass]
            sums = _pass(blocks, [specs[m] for m in some], weights[some], chosen, points[i:i + per_pass], second)
            loss.append(sums["loss"])
            grad.append(sums["grad"])
            hess.append(sums.get("hess"))
        w, lam, count = points.copy(), penalty[which], n[which]
        w[:, -1] = 0.0
        value = np.concatenate(loss) / count + 0.5 * lam * (w * w).sum(axis=1)
        slope = np.concatenate(grad) / count[:, None] + lam[:, None] * w
        curve = None
        if second:
            curve = np.concatenate(hess).reshape(len(which), size, size) / count[:, None, None]
            diagonal = np.arange(size - 1)
            curve[:, diagonal, diagonal] += lam[:, None]
            curve[:, size - 1, size - 1] += 1e-10
        return value, slope, curve

    if len(live):
        value, slope, curve = np.zeros(len(specs)), np.zeros_like(x), np.zeros((len(specs), size, size)) if second else None
        v, g, h = measure(live, x[live])
        value[live], slope[live] = v, g
        if second:
            curve[live] = h
        pasts: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in specs]
        direction, length = np.zeros_like(x), np.ones(len(specs))

        def aim(m: int) -> None:
            if second:
                direction[m] = -np.linalg.solve(curve[m], slope[m])
            else:
                direction[m] = -_two_loops(slope[m], pasts[m])
            if direction[m] @ slope[m] >= 0:
                direction[m] = -slope[m]
                pasts[m].clear()
            length[m] = 1.0 if second or pasts[m] else min(1.0, 1.0 / max(1e-12, np.abs(slope[m]).sum()))

        live = live[np.abs(slope[live]).max(axis=1) > tolerance]
        for m in live:
            aim(m)
        while len(live) and passes < most:
            points = x[live] + length[live, None] * direction[live]
            v, g, h = measure(live, points)
            done = []
            for i, m in enumerate(live):
                if v[i] <= value[m] + 1e-4 * length[m] * (direction[m] @ slope[m]) + 1e-15 * abs(value[m]):
                    if not second:
                        s, d = points[i] - x[m], g[i] - slope[m]
                        if s @ d > 1e-12 * (d @ d):
                            pasts[m] = [*pasts[m], (s, d)][-memory:]
                    x[m], value[m], slope[m] = points[i], v[i], g[i]
                    if second:
                        curve[m] = h[i]
                    if np.abs(slope[m]).max() <= tolerance:
                        done.append(m)
                    else:
                        aim(m)
                else:
                    length[m] /= 2.0
                    if length[m] < 1e-10:
                        done.append(m)
            live = np.setdiff1d(live, done)
    return Fits(specs, x[:, :-1], x[:, -1], rows, passes)


def _start(blocks: Blocks, specs: Sequence[Spec], balanced: bool, slots: Sequence[int] | None, tolerance: float, most: int,
           memory: int) -> np.ndarray | None:
    """Where models of some blocks end, under the penalty that all rows have; None unless there are many rows.

    It only saves passes: whatever it is, the steps over all rows end at the same tolerance.
    """
    whole = blocks.table.agg(F.sum("n")).first()[0] or 0
    if whole < _MANY * _FEW:
        return None
    some = Blocks(store(blocks.table.sample(_FEW / whole, seed=1), "start", row_group=ROW_GROUP), blocks.kinds)
    seen = some.table.agg(F.sum("n")).first()[0] or 0
    if not seen:
        return None
    fits = fit_many(some, [replace(s, C=s.C * whole / seen) for s in specs], balanced, slots, None, max(tolerance, 1e-5), most, memory)
    return np.column_stack([fits.coefficients, fits.intercepts])


def _two_loops(slope: np.ndarray, past: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The slope times the inverse curvature that the past steps show."""
    q, shares = slope.copy(), []
    for s, d in reversed(past):
        share = (s @ q) / (s @ d)
        q -= share * d
        shares.append(share)
    if past:
        s, d = past[-1]
        q *= (s @ d) / (d @ d)
    for (s, d), share in zip(past, reversed(shares)):
        q += (share - (d @ q) / (s @ d)) * s
    return q


def confusion_of(blocks: Blocks, fits: Fits, slots: Sequence[int] | None = None) -> np.ndarray:
    """(models x 2 x 4) tp, fp, fn, tn of every model on its training rows and on the others, from one pass."""
    chosen = None if slots is None else np.asarray(slots, np.int64)

    def work(block: Block) -> dict:
        x = block.x if chosen is None else block.x[:, chosen]
        masks, kind = _masks(block, fits.specs)
        yes = x @ fits.coefficients.T + fits.intercepts > 0
        y = (block["y"] == 1)[:, None]
        cells = np.stack([yes & y, yes & ~y, ~yes & y, ~yes & ~y], axis=2)
        own = masks[:, kind, None]
        return {"cells": np.stack([(cells & own).sum(axis=0), (cells & ~own).sum(axis=0)], axis=1)}
    return sum_blocks(blocks, work).get("cells", np.zeros((len(fits.specs), 2, 4), np.int64))


def score_held_out(table: DataFrame, fits: Fits, names: Sequence[str], key: str = "id", vector: str = "features",
                   target: str = "y", fold: str = "fold") -> DataFrame:
    """(model, key, fold, target, pred, score): every row by the models that held its fold out.

    ``names`` are the models' names; a model's rule must be "not" with the fold as its value. The score is the
    probability of class 1, or the margin where the loss is the hinge.
    """
    ready(table.sparkSession)
    by_fold: dict[int, list[int]] = {}
    for i, spec in enumerate(fits.specs):
        by_fold.setdefault(spec.value, []).append(i)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            fold_of = rows.column(1).to_numpy(zero_copy_only=False)
            for value, models in by_fold.items():
                at = np.flatnonzero(fold_of == value)
                if not len(at):
                    continue
                part = rows.take(pa.array(at))
                x = part.column(3).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
                z = x @ fits.coefficients[models].T + fits.intercepts[models]
                for j, m in enumerate(models):
                    score = z[:, j] if fits.specs[m].loss == "hinge" else 1.0 / (1.0 + np.exp(-z[:, j]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[m]] * len(at), pa.string()), part.column(0), part.column(1), part.column(2),
                         pa.array((z[:, j] > 0).astype(np.int32)), pa.array(score)], names=["model", key, fold, target, "pred", "score"])

    kinds = {c: table.schema[c].dataType.simpleString() for c in (key, fold, target)}
    return (table.select(key, fold, target, vector_to_array(vector).alias("_x")).mapInArrow(
        run, f"model string, `{key}` {kinds[key]}, `{fold}` {kinds[fold]}, `{target}` {kinds[target]}, pred int, score double"))
