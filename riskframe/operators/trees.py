"""Forests and second-order boosting on one binned matrix.

Rows are cut into quantile bins once and stored as blocks of bytes. Trees grow by histograms of two numbers per row:
weighted labels and weights for forests (the gain is the fall of the Gini impurity), gradients and curvatures for
boosting. Models of several folds and candidates grow together: a pass over the table carries the histograms of all open
nodes of all of them, one pass a level. A node with few rows (``whole_rows``, bounded) goes whole to one group, where
its trees grow on in memory: a forest's to purity, without a limit of depth, a boosted model's for all its rounds.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from riskframe.functions.hashing import mixed
from riskframe.operators.linear import _masks, class_rows
from riskframe.plans.blocks import ROW_GROUP, Block, Blocks, blocks_of, hold, joined, make_blocks, sum_blocks
from riskframe.plans.storage import drop, store
from riskframe.plans.workers import ready

WHOLE_ROWS = 200_000
#: The same for a boosted model, of which one group holds the rows once (some 200 bytes a row while it grows).
BOOSTED_ROWS = 1_000_000
#: Numbers that the histograms of one pass may hold.
_CELLS = 8_000_000
#: Nodes of a tree through which all rows go together; through larger ones only those that are not at a leaf.
_SHALLOW = 512
#: Bytes of rows that a task sends on at a time.
_DEALT = 4_000_000
#: Cells of slots whose bins are counted together.
_TOGETHER = 256
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


@dataclass(frozen=True)
class Spec:
    """One model and its training rows (as in ``linear.Spec``).

    ``kind`` is "forest" or "boosted". ``leaves`` and ``depth`` of 0 set no limit. Boosted trees grow level by level
    where there is no limit of leaves, else the leaf with the highest gain first. A forest's node of fewer than
    ``min_split`` rows is a leaf.
    """

    kind: str = "forest"
    trees: int = 200
    depth: int = 0
    leaves: int = 0
    min_rows: int = 1
    min_split: int = 2
    rate: float = 0.1
    subsample: float = 1.0
    l2: float = 1.0
    min_gain: float = 0.0
    min_weight: float = 1.0
    seed: int = 42
    group: int = 0
    rule: str = "not"
    value: int | tuple[int, ...] = -1

    @property
    def rows(self) -> tuple:
        return self.group, self.rule, self.value


@dataclass
class Tree:
    """Nodes as arrays; a node without a feature (-1) is a leaf, the right child follows the left one."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        if len(self.feature) <= _SHALLOW and x.flags.c_contiguous:
            return self._steps(x)
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while len(rows):
            own = at[rows]
            rows = rows[self.feature[own] >= 0]
            own = at[rows]
            at[rows] = self.left[own] + (x[rows, self.feature[own]] > self.cut[own])
        return at

    def _steps(self, x: np.ndarray) -> np.ndarray:
        """All rows take a step at a time; at a leaf, which no bin exceeds, they stay."""
        inner = self.feature >= 0
        slot, cut = np.where(inner, self.feature, 0).astype(np.intp), np.where(inner, self.cut, 2 ** 14).astype(np.int16)
        left = np.where(inner, self.left, np.arange(len(inner))).astype(np.intp)
        at, first, cells = np.zeros(len(x), np.intp), np.arange(len(x)) * x.shape[1], x.ravel()
        level = np.zeros(1, np.intp)
        while len(level := level[inner[level]]):  # the inner nodes of a level, from the root
            above = cells.take(slot.take(at) + first) > cut.take(at)
            at = left.take(at)
            at += above
            level = np.concatenate([left[level], left[level] + 1])
        return at


@dataclass
class Ensemble:
    """A fitted model: trees over binned slots; ``edges`` are the upper ends of the bins of every slot."""

    spec: Spec
    trees: list[Tree]
    edges: list[np.ndarray]
    width: int
    class_rows: np.ndarray = field(default_factory=lambda: np.zeros(2, np.int64))

    def binned(self, x: np.ndarray) -> np.ndarray:
        return binned(x, self.edges)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Positive share (forest, mean over trees) or log odds (boosted, sum) of binned rows."""
        total = np.zeros(len(x))
        for tree in self.trees:
            total += tree.value[tree.leaf_of(x)]
        return total / max(1, len(self.trees)) if self.spec.kind == "forest" else total

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        margin = self.margins(x)
        return margin if self.spec.kind == "forest" else 1.0 / (1.0 + np.exp(-margin))

    @property
    def importances(self) -> np.ndarray:
        """Gain per slot, as shares; every tree of a forest counts the same."""
        total = np.zeros(self.width)
        for tree in self.trees:
            inner = tree.feature >= 0
            own = np.bincount(tree.feature[inner], tree.gain[inner], minlength=self.width)
            total += own / own.sum() if self.spec.kind == "forest" and own.sum() > 0 else own
        return total / total.sum() if total.sum() > 0 else total

    def score_rows(self, df: DataFrame, vector: str = "features") -> DataFrame:
        """``df`` with ``pred`` and ``score``."""
        return scored_rows(self, df, vector)


class StoredForest(Ensemble):
    """A forest whose trees stay in a stored table, since grown to purity they are as large as the data.

    ``table`` has (model, work, tree, leaf, made): a whole tree, or what hangs below a leaf of a tree's top. ``works`` are
    the model's numbers there; ``tops`` are the tops of trees whose large nodes were split by passes. ``trees`` collects
    everything and is for small forests.
    """

    def __init__(self, spec: Spec, edges: list[np.ndarray], width: int, rows: np.ndarray, table: DataFrame, number: int,
                 works: Sequence[tuple[int, int, int]], tops: list[Tree] | None = None):
        self.spec, self.edges, self.width, self.class_rows = spec, edges, width, rows
        self.table, self.number, self.works, self.tops = table.filter(F.col("model") == number), number, list(works), tops
        self._trees: list[Tree] | None = None

    @property
    def trees(self) -> list[Tree]:
        if self._trees is None:
            found = self.table.orderBy("work", "tree").select("tree", "leaf", "made").collect()
            if self.tops is None:
                self._trees = [pickle.loads(bytes(r["made"])) for r in found]
            else:
                self._trees = list(self.tops)
                for r in found:
                    self._trees[r["tree"]] = attach(self._trees[r["tree"]], r["leaf"], pickle.loads(bytes(r["made"])))
        return self._trees

    def in_memory(self) -> Ensemble:
        return Ensemble(self.spec, self.trees, self.edges, self.width, self.class_rows)

    def score_rows(self, df: DataFrame, vector: str = "features") -> DataFrame:
        return forest_scores(df, {0: self}, F.lit(0), vector)


def in_memory(model):
    """The model with everything it needs to score in a task."""
    return model.in_memory() if isinstance(model, StoredForest) else model


def forest_scores(df: DataFrame, models: dict[int, StoredForest], which: Column, vector: str = "features",
                  together: int = 1_000_000) -> DataFrame:
    """``df`` with ``pred`` and ``score``, every row by the model that ``which`` names (rows without one go).

    Bins of the rows go to the trees: a group holds the trees of one piece of work and about ``together`` rows, and a row's
    sums over all pieces are added up in the order of the pieces.
    """
    spark = ready(df.sparkSession)
    rows = store(df.withColumn("_at", which.cast("int")).filter(F.col("_at").isin(*models))
                 .withColumn("_row", F.monotonically_increasing_id()), "scored")
    slices = max(1, -(-rows.count() // together))
    plans = {m: (f.edges, [(w, t, leaf) for w, t, leaf in f.works], f.tops) for m, f in models.items()}
    kind = "model int, work long, slice int, rows binary, x binary, sums binary"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if not part.num_rows:
                continue
            wide = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            ids, at = part.column(0).to_numpy(), part.column(1).to_numpy()
            out: list[tuple] = []
            for m in np.unique(at).tolist():
                edges, works, tops = plans[m]
                own = ids[at == m]
                x = binned(wide[at == m], edges)
                turn = int(own[0] >> 33) % slices
                if tops is None:
                    out += [(m, w, turn, own.tobytes(), x.tobytes(), None) for w in sorted({w for w, _, _ in works})]
                    continue
                leaves = [top.leaf_of(x) for top in tops]
                settled = sum(top.value[leaf] for top, leaf in zip(tops, leaves))
                for w, t, leaf in works:
                    mask = leaves[t] == leaf
                    if mask.any():
                        settled = settled - np.where(mask, tops[t].value[leaf], 0.0)
                        out.append((m, w, turn, own[mask].tobytes(), x[mask].tobytes(), None))
                out.append((m, -1, turn, own.tobytes(), None, settled.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), (
                pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                names=["model", "work", "slice", "rows", "x", "sums"])

    def run(held: pa.Table, dealt: pa.Table) -> pa.Table:
        if not dealt.num_rows:
            return pa.table({"_row": pa.array([], pa.int64()), "work": pa.array([], pa.int64()), "part": pa.array([], pa.float64())})
        ids = np.frombuffer(b"".join(dealt["rows"].to_pylist()), "<i8")
        work = dealt["work"][0].as_py()
        if work < 0:
            total = np.frombuffer(b"".join(dealt["sums"].to_pylist()), "<f8")
        else:
            x = np.frombuffer(b"".join(dealt["x"].to_pylist()), "u1").reshape(len(ids), -1)
            total = np.zeros(len(ids))
            for one in held.sort_by("tree")["made"]:
                tree = pickle.loads(one.as_py())
                total += tree.value[tree.leaf_of(x)]
        return pa.table({"_row": pa.array(ids), "work": pa.array(np.full(len(ids), work)), "part": pa.array(total)})

    trees = None
    for m, forest in models.items():
        own = forest.table.select(F.lit(m).alias("model"), "work", "tree", "made", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
        trees = own if trees is None else trees.unionByName(own)
    keys = ["model", "work", "slice"]
    dealt = rows.select("_row", "_at", vector_to_array(vector).alias("_x")).mapInArrow(deal, kind)
    parts = trees.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(run, "_row long, work long, part double")
    many = F.create_map(*[F.lit(v) for m, f in models.items() for v in (m, float(max(1, f.spec.trees)))])
    sums = parts.groupBy("_row").agg(F.aggregate(F.array_sort(F.collect_list(F.struct("work", "part"))), F.lit(0.0),
                                                 lambda total, p: total + p["part"]).alias("_sum"))
    joined = rows.join(sums, "_row").withColumn("score", F.col("_sum") / F.element_at(many, F.col("_at")))
    return joined.withColumn("pred", (F.col("score") > 0.5).cast("int")).select(*df.columns, "pred", "score")


def scored_rows(model, df: DataFrame, vector: str = "features") -> DataFrame:
    """``df`` with ``pred`` and ``score`` by a model that has ``binned`` and ``probabilities``."""
    ready(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            x = rows.column(1).flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
            score = model.probabilities(model.binned(x)) if rows.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array((score > 0.5).astype(np.int32)), pa.array(score)],
                                             names=["_row", "pred", "score"])

    whole = [vector_to_array(vector).alias(vector) if c == vector else F.col(f"`{c}`") for c in df.columns]
    packed = df.select(F.struct(*whole).alias("_row"), vector_to_array(vector).alias("_x"))
    made = packed.mapInArrow(run, f"_row {packed.schema['_row'].dataType.simpleString()}, pred int, score double")
    back = [array_to_vector(F.col(f"_row.`{c}`")).alias(c) if c == vector else F.col(f"_row.`{c}`") for c in df.columns]
    return made.select(*back, "pred", "score")


# --- bins -------------------------------------------------------------------------------------------

def bin_edges(df: DataFrame, vector: str = "features", bins: int = 64, sample: int = 50_000, key: Column | None = None) -> list[np.ndarray]:
    """Upper ends of up to ``bins`` bins of every slot, from a bounded sample of the vectors (labels play no part).

    A slot with few values has a bin for each; a value beyond the last end lies in the last bin.
    """
    values = F.col(vector) if df.schema[vector].dataType.typeName() == "array" else vector_to_array(vector)
    place = F.xxhash64(values) if key is None else key
    rows = df.select(values.alias("x"), place.alias("h")).orderBy("h").limit(sample).select("x").toArrow()
    flat = rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    x = flat.reshape(rows.num_rows, -1) if rows.num_rows else np.empty((0, 0))
    edges = []
    for column in x.T:
        distinct = np.unique(column)
        if len(distinct) > bins:
            distinct = np.unique(np.quantile(column, np.linspace(0, 1, bins), method="inverted_cdf"))
        edges.append((distinct[1:] + distinct[:-1]) / 2)
    return edges


def binned(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.uint8)
    for j, ends in enumerate(edges):
        out[:, j] = np.searchsorted(ends, x[:, j], "left")
    return out


def binned_blocks(df: DataFrame, edges: list[np.ndarray], member: Column, vector: str = "features", target: str = "y",
                  key: str | None = "id") -> Blocks:
    """Rows of class 0 or 1 as blocks of bins, with ``member`` and a hash of the key (of the vector without a key)."""
    ready(df.sparkSession)
    rows = df.filter(F.col(target).isin(0, 1))
    values = F.col(vector) if df.schema[vector].dataType.typeName() == "array" else vector_to_array(vector)
    spread = F.xxhash64(F.col(key)) if key and key in df.columns else F.xxhash64(values, F.col(target))
    cells = rows.select(values.alias("_x"), F.col(target).cast("int").alias("_y"), member.alias("_m"), spread.alias("_h"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, len(edges))
            codes = binned(x, edges).ravel()
            offsets = np.arange(0, len(codes) + 1, max(1, len(edges)), dtype=np.int32)[:part.num_rows + 1]
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.astype(np.int16))),
                                              *part.columns[1:]], names=["_x", "_y", "_m", "_h"])

    kind = cells.schema["_m"].dataType.simpleString()
    made = cells.mapInArrow(cut, f"_x array<smallint>, _y int, _m {kind}, _h long")
    return make_blocks(made, "_x", {"y": (F.col("_y"), "<i1"), "member": (F.col("_m"), "<i2"), "h": (F.col("_h"), "<i8")}, x_kind="u1",
                       tasks=df.sparkSession.sparkContext.defaultParallelism)


# --- splits -----------------------------------------------------------------------------------------

def best_splits(g: np.ndarray, h: np.ndarray, n: np.ndarray, l2: float, min_weight: float, min_rows: int) -> tuple[np.ndarray, ...]:
    """(gain, slot, cut) of the best split of every node, from its histograms (nodes x slots x bins).

    The gain is half the sum of G^2 / (H + l2) of both sides less the node's. Ties go to the first slot and the lowest
    cut; without a split the gain is 0.
    """
    left_g, left_h, left_n = (np.cumsum(a, axis=2)[:, :, :-1] for a in (g, h, n))
    whole_g, whole_h, whole_n = (a.sum(axis=2)[:, :, None] for a in (g, h, n))
    right_g, right_h, right_n = whole_g - left_g, whole_h - left_h, whole_n - left_n
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 0.5 * (left_g ** 2 / (left_h + l2) + right_g ** 2 / (right_h + l2) - whole_g ** 2 / (whole_h + l2))
    fits = (left_n >= min_rows) & (right_n >= min_rows) & (left_h >= min_weight) & (right_h >= min_weight)
    gain = np.where(fits & np.isfinite(gain), gain, -1.0).reshape(len(g), -1)
    at = gain.argmax(axis=1) if gain.shape[1] else np.zeros(len(g), np.int64)
    top = gain[np.arange(len(g)), at] if gain.shape[1] else np.full(len(g), -1.0)
    wide = max(1, g.shape[2] - 1)
    return np.maximum(top, 0.0), at // wide, at % wide


class Grower:
    """One boosted tree: nodes are split as far as anybody has asked, and the best leaves are chosen in the end."""

    def __init__(self, spec: Spec, g: float, h: float, n: float):
        self.spec = spec
        self.feature, self.cut, self.left, self.depth, self.gain = [-1], [0], [-1], [0], [None]
        self.sums = [(g, h, n)]

    def _walk(self, chosen: set[int] | None = None) -> set[int]:
        """Best-first over what is known; the nodes whose split is needed but unknown. ``chosen`` collects the split ones."""
        asked: set[int] = set()
        heap: list[tuple[float, int]] = []

        def offer(node: int) -> None:
            if self.spec.depth and self.depth[node] >= self.spec.depth:
                return
            if self.gain[node] is None:
                asked.add(node)
            elif self.gain[node] > self.spec.min_gain and self.left[node] >= 0:
                heapq.heappush(heap, (-self.gain[node], node))
        offer(0)
        leaves = 1
        while heap and (not self.spec.leaves or leaves < self.spec.leaves):
            _, node = heapq.heappop(heap)
            leaves += 1
            if chosen is not None:
                chosen.add(node)
            offer(self.left[node])
            offer(self.left[node] + 1)
        return asked

    def asked(self) -> list[int]:
        return sorted(self._walk())

    def feed(self, nodes: Sequence[int], g: np.ndarray, h: np.ndarray, n: np.ndarray) -> None:
        gains, slots, cuts = best_splits(g, h, n, self.spec.l2, self.spec.min_weight, self.spec.min_rows)
        for i, node in enumerate(nodes):
            self.gain[node] = float(gains[i])
            if gains[i] <= self.spec.min_gain:
                continue
            f, c = int(slots[i]), int(cuts[i])
            self.feature[node], self.cut[node], self.left[node] = f, c, len(self.feature)
            own = tuple(float(a[i, f].sum()) for a in (g, h, n))
            low = tuple(float(a[i, f, :c + 1].sum()) for a in (g, h, n))
            for sums in (low, tuple(a - b for a, b in zip(own, low))):
                self.feature.append(-1)
                self.cut.append(0)
                self.left.append(-1)
                self.depth.append(self.depth[node] + 1)
                self.gain.append(None)
                self.sums.append(sums)

    def expanded(self) -> Tree:
        """All nodes that are known, for finding the rows of a node."""
        zero = np.zeros(len(self.feature))
        return Tree(np.array(self.feature), np.array(self.cut), np.array(self.left), zero, zero, zero)

    def tree(self) -> Tree:
        chosen: set[int] = set()
        self._walk(chosen)
        order, place = [0], {0: 0}
        for node in order:
            if node in chosen:
                for child in (self.left[node], self.left[node] + 1):
                    place[child] = len(order)
                    order.append(child)
        inner = np.array([node in chosen for node in order])
        g, h, n = np.array([self.sums[i] for i in order]).T
        return Tree(np.where(inner, [self.feature[i] for i in order], -1).astype(np.int16), np.array([self.cut[i] for i in order], np.int16),
                    np.array([place[self.left[i]] if i in chosen else -1 for i in order], np.int32),
                    (self.spec.rate * g / (h + self.spec.l2)).astype(float),
                    np.array([self.gain[i] if i in chosen else 0.0 for i in order]), h)


def histograms(x: np.ndarray, node: np.ndarray, count: int, bins: int, columns: Sequence[np.ndarray],
               slots: np.ndarray | None = None) -> list[np.ndarray]:
    """Sums of every column by (node, slot, bin); rows whose node is negative are left out. ``slots``: x by slots, if it is known."""
    rows = np.flatnonzero(node >= 0)
    some = len(rows) < len(node)
    if some:
        node, columns = node[rows], [c if c is None else c[rows] for c in columns]
    start = node * bins
    out = [np.empty((count, x.shape[1], bins)) for _ in columns]
    for j, slot in enumerate(np.ascontiguousarray(x.T) if slots is None else slots):
        at = start + (slot[rows] if some else slot)
        for sums, c in zip(out, columns):
            sums[:, j] = np.bincount(at, c, count * bins).reshape(count, bins)
    return out


def bundles(sizes: Sequence[int]) -> list[list[int]]:
    """Slots by their numbers of bins, in bundles whose joint bins are no more than ``_TOGETHER``, or of one slot."""
    out: list[list[int]] = []
    cells = 0
    for slot in sorted(range(len(sizes)), key=lambda j: (sizes[j], j)):
        if out and cells * sizes[slot] <= _TOGETHER:
            out[-1].append(slot)
            cells *= sizes[slot]
        else:
            out.append([slot])
            cells = sizes[slot]
    return out


def bundled_histograms(x: np.ndarray, node: np.ndarray, count: int, sizes: Sequence[int], columns: Sequence[np.ndarray]) -> np.ndarray:
    """(columns x nodes x joint bins of all bundles) sums, which ``unbundled`` makes histograms of slots."""
    rows = np.flatnonzero(node >= 0)
    if len(rows) < len(node):
        x, node, columns = x[rows], node[rows], [c if c is None else c[rows] for c in columns]
    slots, out = np.ascontiguousarray(x.T), [[] for _ in columns]
    for own in bundles(sizes):
        code, cells = slots[own[0]].astype(np.uint16), sizes[own[0]]
        for j in own[1:]:
            code *= np.uint16(sizes[j])
            code += slots[j]
            cells *= sizes[j]
        code = node * cells + code
        for sums, c in zip(out, columns):
            sums.append(np.bincount(code, c, count * cells).reshape(count, cells))
    return np.array([np.concatenate(sums, axis=1) for sums in out], float)


def unbundled(sums: np.ndarray, sizes: Sequence[int], bins: int) -> np.ndarray:
    """(columns x nodes x slots x bins) from ``bundled_histograms``."""
    out, at = np.zeros((*sums.shape[:2], len(sizes), bins)), 0
    for own in bundles(sizes):
        shape = [sizes[j] for j in own]
        joint = sums[:, :, at:at + math.prod(shape)].reshape(*sums.shape[:2], *shape)
        for k, j in enumerate(own):
            out[:, :, j, :sizes[j]] = joint.sum(axis=tuple(2 + i for i in range(len(own)) if i != k))
        at += math.prod(shape)
    return out


def slopes(margin: np.ndarray, y: np.ndarray, positive_weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Negative gradient and curvature of the logistic loss."""
    p = 1.0 / (1.0 + np.exp(-margin))
    w = np.where(y == 1, positive_weight, 1.0)
    return w * (y - p), w * np.maximum(p * (1.0 - p), 1e-16)


def in_round(h: np.ndarray, spec: Spec, number: int) -> np.ndarray:
    """Rows that a boosting round draws."""
    if spec.subsample >= 1:
        return np.ones(len(h), bool)
    return mixed(h, spec.seed * 100_003 + number) < np.uint64(int(spec.subsample * 2 ** 64))


def boost_whole(x: np.ndarray, y: np.ndarray, h: np.ndarray, spec: Spec, bins: int, positive_weight: float) -> list[Tree]:
    """All rounds over rows in memory."""
    margin, trees = np.zeros(len(y)), []
    x, slots = np.ascontiguousarray(x), np.ascontiguousarray(x.T)
    for number in range(spec.trees):
        g, c = slopes(margin, y, positive_weight)
        drawn = in_round(h, spec, number)
        grower = Grower(spec, float(g[drawn].sum()), float(c[drawn].sum()), float(drawn.sum()))
        at = np.zeros(len(y), np.int64)
        while asked := grower.asked():
            place = np.full(len(grower.feature), -1)
            place[asked] = np.arange(len(asked))
            grower.feed(asked, *histograms(x, np.where(drawn, place[at], -1), len(asked), bins, (g, c, None), slots))
            known = grower.expanded()
            rows = np.flatnonzero((known.feature[at] >= 0) & (known.left[at] >= 0))
            own = at[rows]
            at[rows] = known.left[own] + (x[rows, known.feature[own]] > known.cut[own])
        tree = grower.tree()
        trees.append(tree)
        margin += tree.value[tree.leaf_of(x)]
        if len(tree.feature) == 1 and spec.subsample >= 1:
            break
    return trees


# --- forests ----------------------------------------------------------------------------------------

def bootstrap_counts(h: np.ndarray, spec: Spec, tree: int) -> np.ndarray:
    """How often a tree has drawn each row: one Poisson(1) draw by a hash of row and tree."""
    u = mixed(h, spec.seed * 100_003 + tree).astype(float) / 2.0 ** 64
    return np.searchsorted(_POISSON, u, "right")


def node_slots(spec: Spec, tree: int, nodes: np.ndarray, slots: int) -> np.ndarray:
    """The slots that every node may split by: the square root of all, drawn by tree and node."""
    many = max(1, int(math.sqrt(slots)))
    order = mixed(np.asarray(nodes, np.int64)[:, None] * slots + np.arange(slots), spec.seed * 7919 + tree)
    return np.sort(np.argsort(order, axis=1, kind="stable")[:, :many], axis=1)


@dataclass
class _Nodes:
    """A forest tree that grows."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [0.0])
    g: list[float] = field(default_factory=lambda: [0.0])
    h: list[float] = field(default_factory=lambda: [0.0])
    depth: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, cut: int, gain: float, low: tuple[float, float], high: tuple[float, float]) -> int:
        first = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.gain[node] = feature, cut, first, gain
        for g, h in (low, high):
            self.feature.append(-1)
            self.cut.append(0)
            self.left.append(-1)
            self.gain.append(0.0)
            self.g.append(g)
            self.h.append(h)
            self.depth.append(self.depth[node] + 1)
        return first

    def tree(self) -> Tree:
        g, h = np.array(self.g), np.array(self.h)
        return Tree(np.array(self.feature, np.int16), np.array(self.cut, np.int16), np.array(self.left, np.int32),
                    np.divide(g, h, out=np.zeros(len(g)), where=h > 0), np.array(self.gain), h)


def stable_order(key: np.ndarray, many: int) -> np.ndarray:
    """``np.argsort(key, kind="stable")`` of numbers from 0 to below ``many``: numpy counts numbers of 16 bits instead of comparing."""
    order = np.argsort((key & 0xFFFF).astype(np.uint16), kind="stable")
    shift = 16
    while many >> shift:
        order = order[np.argsort(((key >> shift) & 0xFFFF).astype(np.uint16)[order], kind="stable")]
        shift += 16
    return order


def row_splits(x: np.ndarray, node: np.ndarray, count: int, offered: np.ndarray, bins: int, g: np.ndarray, h: np.ndarray,
               min_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gain, slot, cut) of the best split of every node among its offered slots, from the sorted bins of its rows.

    As ``best_splits`` without l2; work follows the rows, not the bins, so that many small nodes are cheap.
    """
    many = offered.shape[1]
    key = ((node[:, None] * many + np.arange(many)) * bins + x[np.arange(len(x))[:, None], offered[node]]).ravel()
    order = stable_order(key, count * many * bins)
    key, row = key[order], order // many
    ends = np.append(np.flatnonzero(key[1:] != key[:-1]), len(key) - 1)  # the last row of every bin
    part, own = key[ends] // bins, key[ends] // (bins * many)
    first = np.append(True, part[1:] != part[:-1])
    rows = np.bincount(node, minlength=count)
    sums = []
    for run in (np.cumsum(g[row])[ends], np.cumsum(h[row])[ends], ends + 1.0):
        before = np.concatenate([[0.0], run[:-1]])[first]
        sums.append(run - before[np.cumsum(first) - 1])
    left_g, left_h, left_n = sums
    whole_g, whole_h = (np.bincount(node, v, count)[own] for v in (g, h))
    right_g, right_h, right_n = whole_g - left_g, whole_h - left_h, rows[own] - left_n
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 0.5 * (left_g ** 2 / left_h + right_g ** 2 / right_h - whole_g ** 2 / whole_h)
    gain = np.where((left_n >= min_rows) & (right_n >= max(1, min_rows)) & np.isfinite(gain), gain, 0.0)
    starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    top = np.maximum.reduceat(gain, starts)
    hits = np.flatnonzero(gain == np.repeat(top, np.diff(np.append(starts, len(gain)))))
    found, at = np.unique(own[hits], return_index=True)
    at = hits[at]
    out = np.zeros(count), np.zeros(count, np.int64), np.zeros(count, np.int64)
    out[0][found], out[2][found] = gain[at], key[ends[at]] % bins
    out[1][found] = offered[found, part[at] % many]
    return out


def grow_pure(x: np.ndarray, y: np.ndarray, weight: np.ndarray, spec: Spec, tree: int, bins: int, depth: int = 0,
              salt: int = 0) -> Tree:
    """A tree over rows in memory, level by level until leaves are pure or can't be split."""
    drawn = np.flatnonzero(weight > 0)
    x, h = x[drawn], weight[drawn].astype(float)
    g, at, slots = h * y[drawn], np.zeros(len(drawn), np.int64), x.shape[1]
    levels: list[Tree] = []
    before, count = 0, 1  # nodes of the levels above, nodes of this one
    while True:
        sums_g, sums_h = np.bincount(at, g, count), np.bincount(at, h, count)
        level = Tree(np.full(count, -1, np.int16), np.zeros(count, np.int16), np.full(count, -1, np.int32),
                     np.divide(sums_g, sums_h, out=np.zeros(count), where=sums_h > 0), np.zeros(count), sums_h)
        levels.append(level)
        wanted = (sums_g > 1e-12 * sums_h) & (sums_g < sums_h * (1 - 1e-12)) & (np.bincount(at, minlength=count) >= max(2, spec.min_split))
        if not wanted.any() or (spec.depth and depth + len(levels) > spec.depth):
            break
        keep = wanted[at]
        x, g, h, at = x[keep], g[keep], h[keep], at[keep]
        nodes = np.flatnonzero(wanted)
        own = (np.cumsum(wanted) - 1)[at]
        gain, slot, cut = row_splits(x, own, len(nodes), node_slots(spec, tree, before + nodes + (salt << 32), slots), bins, g, h,
                                     spec.min_rows)
        none = np.flatnonzero(gain <= 1e-12)
        if len(none):  # none of the drawn slots splits the node: look at all
            again = np.full(len(nodes), -1)
            again[none] = np.arange(len(none))
            rows = np.flatnonzero(again[own] >= 0)
            every = np.tile(np.arange(slots), (len(none), 1))
            gain[none], slot[none], cut[none] = row_splits(x[rows], again[own[rows]], len(none), every, bins, g[rows], h[rows], spec.min_rows)
        split = gain > 1e-12
        if not split.any():
            break
        child = 2 * (np.cumsum(split) - 1)
        inner = nodes[split]
        level.feature[inner], level.cut[inner], level.gain[inner] = slot[split], cut[split], 2.0 * gain[split]
        level.left[inner] = before + count + child[split]
        rows = np.flatnonzero(split[own])
        own = own[rows]
        x, g, h = x[rows], g[rows], h[rows]
        at = child[own] + (x[np.arange(len(x)), slot[own]] > cut[own])
        before, count = before + count, 2 * int(split.sum())
    return Tree(*(np.concatenate([getattr(level, name).astype(kind, copy=False) for level in levels])
                  for name, kind in (("feature", np.int16), ("cut", np.int16), ("left", np.int32), ("value", np.float64),
                                     ("gain", np.float32), ("cover", np.float32))))


def attach(top: Tree, leaf: int, below: Tree) -> Tree:
    """The tree with another one in the place of a leaf."""
    shift = len(top.feature) - 1
    joined = [np.concatenate([a, b[1:]]) for a, b in zip(
        (top.feature, top.cut, top.left, top.value, top.gain, top.cover),
        (below.feature, below.cut, np.where(below.left >= 0, below.left + shift, -1), below.value, below.gain, below.cover))]
    for a, b in zip(joined, (below.feature, below.cut, np.where(below.left >= 0, below.left + shift, -1), below.value, below.gain, below.cover)):
        a[leaf] = b[0]
    return Tree(*joined)


# --- contributions ----------------------------------------------------------------------------------

def leaf_paths(tree: Tree) -> Iterator[tuple[int, dict[int, tuple[float, int, int]]]]:
    """(leaf, what its path asks of each slot: the share of rows that follow it by chance, lowest and highest bin)."""
    waiting: list[tuple[int, dict]] = [(0, {})]
    while waiting:
        node, path = waiting.pop()
        if tree.feature[node] < 0:
            yield node, path
            continue
        slot, cut, left = int(tree.feature[node]), int(tree.cut[node]), int(tree.left[node])
        for child, low, high in ((left, 0, cut), (left + 1, cut + 1, 2 ** 15)):
            share, least, most = path.get(slot, (1.0, 0, 2 ** 15))
            share *= float(tree.cover[child]) / float(tree.cover[node])
            waiting.append((child, {**path, slot: (share, max(least, low), min(most, high))}))


def contributions(tree: Tree, x: np.ndarray) -> tuple[float, np.ndarray]:
    """(mean of the leaves by cover, rows x slots): exact Shapley values of the path-dependent game of one tree.

    A slot that is left out follows both branches by their cover. Only the slots of a leaf's path matter for it; the
    coalitions of the others are summed by size as the coefficients of a polynomial, for all rows at once.
    """
    out, base = np.zeros(x.shape), 0.0
    for leaf, path in leaf_paths(tree):
        value = float(tree.value[leaf])
        base += value * math.prod(a[0] for a in path.values())
        out += leaf_contributions(value, list(path), list(path.values()), x)
    return base, out


def leaf_contributions(value: float, slots: Sequence[int], asked: Sequence[tuple[float, int, int]], x: np.ndarray) -> np.ndarray:
    """(rows x slots) of one leaf."""
    out, many = np.zeros(x.shape), len(slots)
    if not many:
        return out
    follows = np.stack([(x[:, s] >= low) & (x[:, s] <= high) for s, (_, low, high) in zip(slots, asked)], axis=1).astype(float)
    share = np.array([a[0] for a in asked])
    weight = np.array([math.factorial(k) * math.factorial(many - k - 1) / math.factorial(many) for k in range(many)])
    for j, slot in enumerate(slots):
        sums = np.zeros((len(x), many))  # coefficient k: coalitions of k of the other slots
        sums[:, 0] = 1.0
        for i in range(many):
            if i != j:
                sums[:, 1:] = share[i] * sums[:, 1:] + follows[:, i:i + 1] * sums[:, :-1]
                sums[:, 0] *= share[i]
        out[:, slot] += value * (follows[:, j] - share[j]) * (sums @ weight)
    return out


#: Leaves whose paths have no more slots than this get a table of all patterns of followed slots.
PATTERNS = 8


@dataclass
class _Leaf:
    """A leaf's value and what its path asks; ``table`` (patterns x slots) has the contributions, without one rows are worked on."""

    tree: int
    value: float
    slots: list[int]
    asked: list[tuple[float, int, int]]
    table: np.ndarray | None = None


def _pattern_tables(share: np.ndarray, value: np.ndarray) -> np.ndarray:
    """(leaves x patterns x slots): contributions of leaves with the same number of slots; bit k of a pattern is slot k."""
    many = share.shape[1]
    follows = ((np.arange(2 ** many)[:, None] >> np.arange(many)) & 1).astype(float)
    weight = np.array([math.factorial(k) * math.factorial(many - k - 1) / math.factorial(many) for k in range(many)])
    out = np.empty((len(share), len(follows), many))
    for j in range(many):
        sums = np.zeros(out.shape)
        sums[:, :, 0] = 1.0
        for i in range(many):
            if i != j:
                own = share[:, i, None, None]
                sums[:, :, 1:] = own * sums[:, :, 1:] + follows[None, :, i, None] * sums[:, :, :-1]
                sums[:, :, 0] *= own[:, :, 0]
        out[:, :, j] = value[:, None] * (follows[None, :, j] - share[:, j, None]) * (sums @ weight)
    return out


@dataclass
class Contributions:
    """What is the same for all rows of ``ensemble_contributions``."""

    base: float
    many: int
    leaves: list[_Leaf]

    def of(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        """(base, rows x slots); leaves of few slots are looked up by which of the path's slots a row follows."""
        columns = np.ascontiguousarray(x.T)
        total = np.zeros(columns.shape)
        for leaf in self.leaves:
            if leaf.table is None:
                total += leaf_contributions(leaf.value, leaf.slots, leaf.asked, x).T
                continue
            code = np.zeros(len(x), np.uint8)
            for k, (slot, (_, low, high)) in enumerate(zip(leaf.slots, leaf.asked)):
                follows = (columns[slot] >= low) & (columns[slot] <= min(high, 255))
                code |= follows.view(np.uint8) << np.uint8(k)
            for k, slot in enumerate(leaf.slots):
                total[slot] += leaf.table[:, k][code]
        return self.base / self.many, np.ascontiguousarray(total.T) / self.many


def prepared_contributions(model: Ensemble) -> Contributions:
    base, leaves, sizes = 0.0, [], {}
    for number, tree in enumerate(model.trees):
        for leaf, path in leaf_paths(tree):
            value = float(tree.value[leaf])
            base += value * math.prod(a[0] for a in path.values())
            if path:
                leaves.append(_Leaf(number, value, list(path), list(path.values())))
                sizes.setdefault(len(path), []).append(leaves[-1])
    for many, own in sizes.items():
        step = max(1, 1_000_000 // (many * 2 ** many)) if many <= PATTERNS else len(own)
        for at in range(0, len(own) if many <= PATTERNS else 0, step):
            part = own[at:at + step]
            tables = _pattern_tables(np.array([[a[0] for a in l.asked] for l in part]), np.array([l.value for l in part]))
            for l, table in zip(part, tables):
                l.table = np.asfortranarray(table)
    return Contributions(base, max(1, len(model.trees)) if model.spec.kind == "forest" else 1, leaves)


def ensemble_contributions(model: Ensemble, x: np.ndarray) -> tuple[float, np.ndarray]:
    """(base, rows x slots) of binned rows; base and a row's values add up to the model's margin."""
    return prepared_contributions(model).of(x)


# --- the jobs ---------------------------------------------------------------------------------------

def _class_weights(rows: np.ndarray) -> tuple[float, float]:
    n = rows.sum()
    return (n / (2 * rows[0]) if rows[0] else 0.0, n / (2 * rows[1]) if rows[1] else 0.0)


_PART = pa.schema([("work", pa.int64()), ("x", pa.binary()), ("y", pa.binary()), ("h", pa.binary())])


def _in_groups(blocks: Blocks, specs: Sequence[Spec], works: Sequence[tuple], width: int,
               grow: Callable, picked: Callable | None = None) -> DataFrame:
    """(model, work, tree, leaf, made): what ``grow`` makes, as (tree, leaf, object), of the rows of every piece of work.

    The rows go to one group each; a piece's first entry is its model. ``picked(block)`` may narrow a model's training rows: a mask
    for every piece in turn.
    """
    kinds = blocks.kinds

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for block in joined(blocks_of(batches, kinds)):
            masks, kind = _masks(block, specs)
            narrow = None if picked is None else picked(block)
            for number, work in enumerate(works):
                mask = masks[:, kind[work[0]]]
                if narrow is not None:
                    mask = mask & next(narrow)
                if mask.any():
                    rows.append((number, *(a.tobytes() for a in (block.x[mask], block["y"][mask], block["h"][mask]))))
                    held += sum(map(len, rows[-1][1:]))
                if held > _DEALT:
                    yield part(rows)
                    rows, held = [], 0
        if rows:
            yield part(rows)

    def part(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), _PART)], schema=_PART)

    def run(table: pa.Table) -> pa.Table:
        number = table["work"][0].as_py()
        x, y, h = (np.frombuffer(b"".join(table[n].to_pylist()), k) for n, k in (("x", "u1"), ("y", "<i1"), ("h", "<i8")))
        x = x.reshape(len(y), width)
        order = np.lexsort((y, h))
        made = list(grow(works[number], x[order], y[order].astype(float), h[order]))
        return pa.table({"model": pa.array([works[number][0]] * len(made), pa.int32()), "work": pa.array([number] * len(made), pa.int64()),
                         "tree": pa.array([t for t, _, _ in made], pa.int32()), "leaf": pa.array([leaf for _, leaf, _ in made], pa.int32()),
                         "made": pa.array([pickle.dumps(m) for _, _, m in made], pa.binary())})

    spark = blocks.table.sparkSession
    partitions = max(1, min(2 * len(works), 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))))  # small, so that few meet
    return (blocks.table.mapInArrow(deal, "work long, x binary, y binary, h binary").repartition(partitions, "work")
            .groupBy("work").applyInArrow(run, "model int, work long, tree int, leaf int, made binary"))


def fit_many(blocks: Blocks, specs: Sequence[Spec], edges: list[np.ndarray], whole_rows: int | None = None,
             batches: int = 20) -> list[Ensemble]:
    """Fit every model; models of which one class is missing have no trees.

    Models of up to ``whole_rows`` training rows (``WHOLE_ROWS`` for a forest, ``BOOSTED_ROWS`` for a boosted model, if not
    given) grow in groups: a boosted one in its own, a forest in ``batches`` groups with a share of the trees each. Larger
    ones grow by passes over the table.
    """
    specs = list(specs)
    bound = {"forest": WHOLE_ROWS, "boosted": BOOSTED_ROWS} if whole_rows is None else dict.fromkeys(("forest", "boosted"), whole_rows)
    width = len(edges)
    bins = max((len(e) + 1 for e in edges), default=1)
    rows = class_rows(blocks, specs)
    out = [Ensemble(s, [], edges, width, r) for s, r in zip(specs, rows)]
    both = [i for i in range(len(specs)) if (rows[i] > 0).all()]
    small = [i for i in both if rows[i].sum() <= bound[specs[i].kind]]
    alone = [(i,) for i in small if specs[i].kind == "boosted"]
    shares = [(i, b) for i in small if specs[i].kind == "forest" for b in range(min(batches, specs[i].trees))]

    def boost(work: tuple, x: np.ndarray, y: np.ndarray, h: np.ndarray) -> list[tuple]:
        own = rows[work[0]]
        return [(0, 0, boost_whole(x, y, h, specs[work[0]], bins, own[0] / own[1]))]

    def grow(work: tuple, x: np.ndarray, y: np.ndarray, h: np.ndarray) -> Iterator[tuple]:
        spec = specs[work[0]]
        low, high = _class_weights(rows[work[0]])
        for t in range(work[1], spec.trees, batches):
            yield t, 0, grow_pure(x, y, bootstrap_counts(h, spec, t) * np.where(y == 1, high, low), spec, t, bins)

    if alone:
        for r in _in_groups(blocks, specs, alone, width, boost).collect():  # some nodes a round
            out[r["model"]].trees = pickle.loads(bytes(r["made"]))
    if shares:
        table = store(_in_groups(blocks, specs, shares, width, grow), "forest", ["model"])
        for i in {i for i, _ in shares}:
            out[i] = StoredForest(specs[i], edges, width, rows[i], table, i, [(w, -1, 0) for w, (m, _) in enumerate(shares) if m == i])
    large = [i for i in both if i not in set(small)]
    boosted = [i for i in large if specs[i].kind == "boosted"]
    if boosted:
        for i, trees in zip(boosted, boost_by_passes(blocks, [specs[i] for i in boosted], rows[boosted], width, bins,
                                                     sizes=[len(e) + 1 for e in edges])):
            out[i].trees = trees
    for i in large:
        if specs[i].kind == "forest":
            out[i] = forest_by_passes(blocks, specs[i], rows[i], edges, bins, bound["forest"])
    return out


def boost_by_passes(blocks: Blocks, specs: Sequence[Spec], rows: np.ndarray, width: int, bins: int, keep: int = 2,
                    sizes: Sequence[int] | None = None, links: int = 16) -> list[list[Tree]]:
    """Boosted models that grow together, one pass a level over blocks that the executors hold.

    Margins are held anew every ``keep`` rounds, each from those before, and stored anew after ``links`` times that, so that
    a lost executor costs that much at most; what is replaced goes. ``sizes`` are the slots' numbers of bins, if they are
    known to be fewer than ``bins``.
    """
    sizes = [bins] * width if sizes is None else list(sizes)
    weights = [r[0] / r[1] for r in rows]
    trees: list[list[Tree]] = [[] for _ in specs]
    state, held, stored, kept = blocks, hold(blocks), 0, 0

    def margins(block: Block, since: list[list[Tree]]) -> np.ndarray:
        if "margin" in block.arrays:
            total = block.arrays["margin"].copy()
        else:
            total = np.zeros((block.n, len(specs)))
        for m, own in enumerate(since):
            for tree in own:
                total[:, m] += tree.value[tree.leaf_of(block.x)]
        return total

    live = set(range(len(specs)))
    for number in range(max(s.trees for s in specs)):
        live = {m for m in live if number < specs[m].trees}
        if not live:
            break
        before = None
        if number - stored >= keep * links:
            held.release()
            last, state = state, _stored_margins(state, [own[stored:] for own in trees], len(specs), margins)
            if last is not blocks:
                drop(last.table)
            held, stored, kept = hold(state), number, number
        elif number - kept >= keep:
            before, held = held, held.with_array("margin", "<f8", lambda block, new=[own[kept:] for own in trees]: margins(block, new))
            kept = number
        since = [own[kept:] for own in trees]

        # The root's sums come with its histogram: any slot's bins add up to them.
        growers = {m: Grower(specs[m], 0.0, 0.0, 0.0) for m in live}
        while wanted := {m: a for m, a in ((m, g.asked()) for m, g in growers.items()) if a}:
            known = {m: growers[m].expanded() for m in wanted}

            def level(block: Block) -> dict:
                masks, kind = _masks(block, specs)
                total = margins(block, since)
                out = {}
                for m, asked in wanted.items():
                    own = masks[:, kind[m]] & in_round(block["h"], specs[m], number)
                    place = np.full(len(known[m].feature), -1)
                    place[asked] = np.arange(len(asked))
                    node = np.where(own, place[known[m].leaf_of(block.x)], -1)
                    g, h = slopes(total[:, m], block["y"], weights[m])
                    # Rows are only counted where the count decides more than whether there are any.
                    columns = (g, h) if specs[m].min_rows <= 1 and specs[m].min_weight > 0 else (g, h, None)
                    out[f"{m}"] = bundled_histograms(block.x, node, len(asked), sizes, columns)
                return out
            sums = held.sum(level)
            if before is not None:  # its successor is held now
                before.release()
                before = None
            for m, asked in wanted.items():
                g, h, *n = unbundled(sums[f"{m}"], sizes, bins)
                n = n[0] if n else (h > 0).astype(float)
                if growers[m].gain[0] is None:
                    growers[m].sums[0] = tuple(float(a[0, 0].sum()) for a in (g, h, n))
                growers[m].feed(asked, g, h, n)
        for m in list(live):
            trees[m].append(growers[m].tree())
            if len(trees[m][-1].feature) == 1 and specs[m].subsample >= 1:
                live.discard(m)
    held.release()
    if state is not blocks:
        drop(state.table)
    return trees


def _stored_margins(state: Blocks, since: list[list[Tree]], models: int, margins: Callable) -> Blocks:
    """The blocks with every model's margins so far."""
    kinds = state.kinds
    wide = {**kinds, "margin": "<f8"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches, kinds):
            total = margins(block, since)
            cells = [pa.array([block.arrays[n].tobytes() if n != "margin" else total.tobytes()], pa.binary()) for n in wide]
            yield pa.RecordBatch.from_arrays([pa.array([block.n], pa.int64()), *cells], names=["n", *wide])
    made = state.table.mapInArrow(run, "n long, " + ", ".join(f"{n} binary" for n in wide))
    return Blocks(store(made, "margins", row_group=ROW_GROUP), wide)


def forest_by_passes(blocks: Blocks, spec: Spec, rows: np.ndarray, edges: list[np.ndarray], bins: int, whole_rows: int) -> Ensemble:
    """A forest whose large nodes are split by passes over the table, and whose small ones go to groups."""
    width = len(edges)
    low, high = _class_weights(rows)
    growing = [_Nodes() for _ in range(spec.trees)]
    counts: dict[tuple[int, int], float] = {(t, 0): float(rows.sum()) for t in range(spec.trees)}
    waiting, finished = [(t, 0) for t in range(spec.trees)], []

    def weight_of(block: Block, t: int) -> np.ndarray:
        return bootstrap_counts(block["h"], spec, t) * np.where(block["y"] == 1, high, low)

    while waiting:
        step = max(1, _CELLS // (3 * width * bins))
        part, waiting = waiting[:step], waiting[step:]
        by_tree: dict[int, list[int]] = {}
        for t, node in part:
            by_tree.setdefault(t, []).append(node)
        known = {t: growing[t].tree() for t in by_tree}
        # All slots are summed, so that a node whose drawn slots don't split it needs no second pass.
        def level(block: Block) -> dict:
            masks, kind = _masks(block, [spec])
            own = masks[:, kind[0]]
            out = {}
            for t, nodes in by_tree.items():
                weight = weight_of(block, t)
                place = np.full(len(known[t].feature), -1)
                place[nodes] = np.arange(len(nodes))
                node = np.where(own & (weight > 0), place[known[t].leaf_of(block.x)], -1)
                out[f"{t}"] = np.stack(histograms(block.x, node, len(nodes), bins, (weight * block["y"], weight, None)))
            return out
        sums = sum_blocks(blocks, level)
        for t, nodes in by_tree.items():
            g, h, n = sums[f"{t}"]
            offered = node_slots(spec, t, nodes, width)
            pick = np.arange(len(nodes))[:, None]
            gain, slot, cut = best_splits(g[pick, offered], h[pick, offered], n[pick, offered], 0.0, 0.0, spec.min_rows)
            gain_all, slot_all, cut_all = best_splits(g, h, n, 0.0, 0.0, spec.min_rows)
            for i, node in enumerate(nodes):
                own = growing[t]
                own.g[node], own.h[node] = float(g[i, 0].sum()), float(h[i, 0].sum())
                f, c, top = (int(offered[i, slot[i]]), int(cut[i]), gain[i]) if gain[i] > 1e-12 else (int(slot_all[i]), int(cut_all[i]), gain_all[i])
                pure = not 0 < own.g[node] < own.h[node] * (1 - 1e-12)
                if pure or top <= 1e-12 or n[i, 0].sum() < spec.min_split or (spec.depth and own.depth[node] >= spec.depth):
                    continue
                sides = [tuple(float(a[i, f, side].sum()) for a in (g, h, n)) for side in (slice(0, c + 1), slice(c + 1, None))]
                first = own.split(node, f, c, 2.0 * float(top), sides[0][:2], sides[1][:2])
                for child, side in zip((first, first + 1), sides):
                    (waiting if side[2] > whole_rows else finished).append((t, child))
    trees = [g.tree() for g in growing]
    works = [(0, t, node) for t, node in sorted(finished)
             if 0 < growing[t].g[node] < growing[t].h[node] * (1 - 1e-12)
             and not (spec.depth and growing[t].depth[node] >= spec.depth)]

    def picked(block: Block) -> Iterator[np.ndarray]:
        leaf = t = None
        for _, tree, node in works:
            if tree != t:  # the works of a tree follow one another
                t, leaf = tree, np.where(bootstrap_counts(block["h"], spec, tree) > 0, trees[tree].leaf_of(block.x), -1)
            yield leaf == node

    def grow(work: tuple, x: np.ndarray, y: np.ndarray, h: np.ndarray) -> list[tuple]:
        weight = bootstrap_counts(h, spec, work[1]) * np.where(y == 1, high, low)
        depth = growing[work[1]].depth[work[2]]
        return [(work[1], work[2], grow_pure(x, y, weight, spec, work[1], bins, depth, salt=1 + work[2]))]

    if not works:
        return Ensemble(spec, trees, edges, width, rows)
    table = store(_in_groups(blocks, [spec], works, width, grow, picked), "forest", ["model"])
    return StoredForest(spec, edges, width, rows, table, 0, [(w, t, node) for w, (_, t, node) in enumerate(works)], trees)


def score_held_out(table: DataFrame, models: Sequence, names: Sequence[str], key: str = "id",
                   vector: str = "features", target: str = "y", fold: str = "fold") -> DataFrame:
    """(model, key, fold, target, pred, score): every row by the models that held its fold out."""
    ready(table.sparkSession)
    kinds = {c: table.schema[c].dataType.simpleString() for c in (key, fold, target)}
    kind = f"model string, `{key}` {kinds[key]}, `{fold}` {kinds[fold]}, `{target}` {kinds[target]}, pred int, score double"
    rows = table.select(key, fold, target, vector_to_array(vector).alias("_x"))

    def scored(own: list[int]) -> Callable:
        held = [(names[m], models[m]) for m in own]  # a task gets the models of its fold only

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batches:
                if not part.num_rows:
                    continue
                x = part.column(3).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                for name, model in held:
                    score = model.probabilities(model.binned(x))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(x), pa.string()), part.column(0), part.column(1), part.column(2),
                         pa.array((score > 0.5).astype(np.int32)), pa.array(score)], names=["model", key, fold, target, "pred", "score"])
        return run

    out = None
    for name in dict.fromkeys(n for n, m in zip(names, models) if isinstance(m, StoredForest)):
        forests = {m.spec.value: m for n, m in zip(names, models) if n == name and isinstance(m, StoredForest)}
        part = forest_scores(table.select(key, fold, target, vector), forests, F.col(fold), vector)
        part = part.select(F.lit(name).alias("model"), key, fold, target, "pred", "score")
        out = part if out is None else out.unionByName(part)
    plain = [i for i, m in enumerate(models) if not isinstance(m, StoredForest)]
    for value in sorted({models[i].spec.value for i in plain}):
        own = [i for i in plain if models[i].spec.value == value]
        part = rows.filter(F.col(fold) == value).mapInArrow(scored(own), kind)
        out = part if out is None else out.unionByName(part)
    return out
