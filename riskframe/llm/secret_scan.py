"""Secret scan: fixed patterns, and a character convolutional network for what they leave.

The patterns find secrets by their form. Every other run of twelve or more key characters is a candidate; a network scores
it, and the patterns' findings, with the characters around it. The network is trained on all of the patterns' findings in
all documents, against all other words and runs, once with their surroundings and once without, so that it knows a
secret's form where no key word stands before it. Findings that calibrate it are not those it was trained on.
"""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from riskframe.llm.char_cnn import (AFTER, BEFORE, INSIDE, LENGTH, CharCnn, State, calibrate, candidate_windows, class_weights,
                                    encode_window, first_state, fit_scale, scale_sums, scale_targets, step, train)
from riskframe.llm.tokens import forget, slices
from riskframe.llm.workers import batch, ready, release
from riskframe.plans.blocks import sum_batches
from riskframe.plans.storage import store

# The patterns of the contract, in its order.
KINDS = ["assign", "access", "hex"]
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.ASCII | re.IGNORECASE)
#: One of them, in lower case, is in every text with a match.
_KEYS = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_LEAST = {"assign": 12, "access": 18, "hex": 16}

#: What the network adds.
LEARNED = "learned"
_RUN = r"[A-Za-z0-9+/_=-]"
_SHORTEST = _LEAST["assign"]
_CANDIDATE = re.compile(rf"(?<!{_RUN}){_RUN}{{{_SHORTEST},}}+")
_WORD = re.compile(r"\S{8,}")
_PLACE = re.compile(r"\S{4,}")
_PLACES = 12
_LETTERS = string.ascii_letters + string.digits
#: Least size, and below which, of values drawn anew (0: as long as the finding's), and from how many of ``_LETTERS``.
_DRAWN = [(0, 0, 62), (_SHORTEST, 16, 62), (_SHORTEST, INSIDE, 52), (_SHORTEST, 16, 52)]

SPAN = "array<struct<kind:string,start:long,end:long,probability:double>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))
_SEEN = pa.schema([("kind", pa.int32()), ("place", pa.int64()), ("row", pa.int64())])
_EXAMPLE = pa.schema([("kind", pa.int32()), ("place", pa.int64()), ("codes", pa.binary())])
_VALUE = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("codes", pa.binary())])
_SCORED = pa.schema([("label", pa.int32()), ("z", pa.float64())])

#: Parts of the training values, for as many rounds, and the one of the values that calibrate.
_PARTS = 8
_HELD = _PARTS
#: Windows a task should have in a round, windows to take in all at least, and most passes for that.
_SHARE = 16_384
_ENOUGH = 131_072
_PASSES = 8
#: Windows of a step.
_STEP = 128
#: Words whose windows are one row.
_TOGETHER = 64
#: Windows that are laid out at once.
_BLOCK = 4_096
#: Rows whose windows are held at once.
_ROWS = 500
#: Distinct values of a kind a task remembers.
_KNOWN = 500_000


def pattern_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns' findings in code points, by start, then by kind as listed."""
    lower = text.lower()
    found = []
    if any(key in lower for key in _KEYS):
        found = [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= _LEAST["assign"]]
    found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= _LEAST["access"]]
    found += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    found.sort(key=lambda f: (f[0], f[2]))
    return [(start, end, KINDS[kind]) for start, end, kind in found]


class Cover:
    """Spans in order of their starts, with the furthest end so far: looked up by bisection."""

    def __init__(self, spans: list[tuple[int, int, str]]):
        self.starts = [s for s, _, _ in spans]
        self.ends = list(accumulate((e for _, e, _ in spans), max))

    def free(self, start: int, end: int) -> bool:
        """Whether no span touches any of it."""
        at = bisect_left(self.starts, end) - 1
        return at < 0 or self.ends[at] <= start

    def holds(self, start: int, end: int) -> bool:
        """Whether one span contains it."""
        at = bisect_right(self.starts, start) - 1
        return at >= 0 and self.ends[at] >= end


def candidates(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Runs of ``_SHORTEST`` key characters or more, whole, that no pattern's span contains."""
    cover = Cover(spans)
    return [m.span() for m in _CANDIDATE.finditer(text) if not cover.holds(*m.span())]


def _value(text: str, start: int, kind: str) -> int:
    """Where a finding's value starts."""
    return _ASSIGN.match(text, start).start(2) if kind == "assign" else start


def _place(text: str) -> int:
    """Place of a value in the order in which examples are drawn."""
    return zlib.crc32(text.encode()) * 2_654_435_761 % 2 ** 32


def _labelled(text: str) -> Iterator[tuple[int, int, tuple]]:
    """(kind, place, where) of what may become an example: 0 findings, 1 other words of eight characters or more, 2 runs."""
    spans = pattern_spans(text)
    cover = Cover(spans)
    for start, end, kind in spans:
        value = _value(text, start, kind)
        if any(c.isalpha() for c in text[value:end]):  # a mere number may be anything
            yield 0, _place(text[value:end]), (value, end)
    for m in _WORD.finditer(text):
        plain = m[0].isalpha() and zlib.crc32(m[0].encode()) % 16  # plain words are many and alike
        if not plain and cover.free(*m.span()):
            yield 1, _place(m[0]), m.span()
    for m in _CANDIDATE.finditer(text):
        if cover.free(*m.span()):  # not partly a finding
            yield 2, _place(m[0]), m.span()


def _examples(text: str, wanted: set[tuple[int, int]]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(kind, place, window) of the wanted ones, each value once.

    A finding is given as it stands and with its value drawn anew: from letters and digits, as long as it is and as short
    as a candidate may be, and from letters alone. It stands in its surroundings, in those of other words of the text and
    alone; runs stand in theirs and alone, then also in capitals.
    """
    words = None
    for kind, place, (start, end) in _labelled(text):
        if (kind, place) not in wanted:
            continue
        wanted = wanted - {(kind, place)}
        if kind == 1:
            yield kind, place, encode_window(text, start, end)
        elif kind == 2:
            for source, at, to in ((text, start, end), (text[start:end], 0, end - start), (text[start:end].upper(), 0, end - start)):
                for window in candidate_windows(source, at, to):
                    yield kind, place, window
        else:
            if words is None:
                cover = Cover(pattern_spans(text))
                words = [m.span() for m in _PLACE.finditer(text) if cover.free(*m.span())]
            rng = np.random.default_rng(place)
            places = [(start, end), *(words[i] for i in rng.integers(0, max(1, len(words)), _PLACES if words else 0))]
            seen = text[start:min(end, start + INSIDE)]
            sides = [(text[max(0, at - BEFORE):at], text[to:to + AFTER]) for at, to in places]
            for before, after in [*sides, ("", "")]:
                drawn = ["".join(_LETTERS[i] for i in rng.integers(0, kinds, rng.integers(least, most) if most else len(seen)))
                         for least, most, kinds in _DRAWN]
                for one in (seen, *drawn):
                    yield kind, place, encode_window(before + one + after, len(before), len(before) + len(one))


def sample_examples(docs: DataFrame, findings: int, others: int, text_col: str = "text") -> list[tuple[int, int, bytes]]:
    """(kind, place, window) of the ``findings`` and, of words and runs each, the ``others`` distinct values with the
    smallest places among all rows.

    One pass gives the smallest places of every task; only rows that hold a chosen value are read again.
    """
    ready(docs.sparkSession)
    bounds = (findings, others, others)
    keyed = docs.select(F.xxhash64(F.col(text_col)).alias("row"), F.col(text_col).alias("text")).filter("text is not null")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        smallest: list[dict[int, int]] = [{}, {}, {}]
        limit = [2 ** 32] * 3
        for part in slices(batches, 1, 2_000_000):
            for row, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                for kind, place, _ in _labelled(text):
                    if place < limit[kind]:
                        own = smallest[kind]
                        own[place] = min(row, own.get(place, row))
                        if len(own) > 2 * bounds[kind]:
                            smallest[kind] = dict(sorted(own.items())[:bounds[kind]])
                            limit[kind] = max(smallest[kind]) + 1
        rows = [(kind, place, row) for kind, own in enumerate(smallest) for place, row in sorted(own.items())[:bounds[kind]]]
        yield batch(_SEEN, *(zip(*rows) if rows else [[]] * 3))
        release()

    seen = store(keyed.mapInArrow(look, "kind int, place long, row long").groupBy("kind", "place").agg(F.min("row").alias("row")), "seen")
    wanted: dict[int, set[tuple[int, int]]] = {}
    for kind, bound in enumerate(bounds):  # bounded by the parameters
        for r in seen.filter(F.col("kind") == kind).orderBy("place").limit(bound).collect():
            wanted.setdefault(r["row"], set()).add((kind, r["place"]))
    if not wanted:
        return []
    chosen = docs.sparkSession.createDataFrame([(r,) for r in wanted], "row long")
    again = keyed.join(F.broadcast(chosen), "row", "left_semi")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            found = [e for row, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                     for e in _examples(text, wanted[row])]
            yield batch(_EXAMPLE, [k for k, _, _ in found], [p for _, p, _ in found], [w.tobytes() for _, _, w in found])
            del found
        release()

    made = again.mapInArrow(make, "kind int, place long, codes binary")
    rows = made.distinct().collect()  # copies of a chosen row give the same examples
    return [(r["kind"], r["place"], bytes(r["codes"])) for r in rows]


def split_examples(examples: list[tuple[int, int, bytes]], most: int) -> list[list[tuple[int, bytes]]]:
    """(label, window) lists that train and that calibrate, from different values: every fourth, the second first,
    calibrates; a single value does both. At most ``most`` windows of each label, a quarter of them for calibration."""
    sides: list[list[tuple[int, bytes]]] = [[], []]
    for label, kinds in ((1, (0,)), (0, (1, 2))):
        own = sorted({(place, kind) for kind, place, _ in examples if kind in kinds})
        held = {key for i, key in enumerate(own) if i % 4 == 1}
        windows = sorted({(zlib.crc32(codes), codes, (place, kind)) for kind, place, codes in examples if kind in kinds})
        for side in (0, 1):
            part = [codes for _, codes, key in windows if len(own) == 1 or (key in held) == bool(side)]
            sides[side] += [(label, codes) for codes in part[:most * (3, 1)[side] // 4]]
    return sides


def _laid_out(texts: list[str]) -> tuple[np.ndarray, list[int]]:
    """Codes of all texts, apart by what stands for no character, and where each begins."""
    pad = np.full(LENGTH, 129, np.uint8)
    parts, starts, at = [pad], [], LENGTH
    for text in texts:
        if text.isascii():
            own = np.frombuffer(text.encode(), np.uint8)
        else:
            own = np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), 128).astype(np.uint8)
        parts += [own, pad]
        starts.append(at)
        at += len(own) + LENGTH
    return np.concatenate(parts), starts


def _codes(laid: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``encode_window`` of many spans of texts that are laid out (spans x ``LENGTH``)."""
    if len(start) > _BLOCK:
        return np.concatenate([_codes(laid, start[i:i + _BLOCK], end[i:i + _BLOCK]) for i in range(0, len(start), _BLOCK)])
    size = np.minimum(end - start, INSIDE)[:, None]
    out = laid[start[:, None] + np.arange(-BEFORE, INSIDE + AFTER)]
    out[:, BEFORE:BEFORE + INSIDE][np.arange(INSIDE) >= size] = 129
    out[:, BEFORE + INSIDE:] = laid[start[:, None] + size + np.arange(AFTER)]
    return out


def _side(value: str) -> int:
    """The part of a value: ``_HELD`` for every fourth, by its place."""
    drawn = _place(value) >> 27
    return _HELD if drawn % 4 == 1 else drawn // 4


def _values(texts: list[str], known: tuple[set[str], set[str], set[str]]) -> Iterator[tuple[int, int, bytes]]:
    """(part, kind, windows) of the findings, words and runs (kinds as in ``_labelled``) that are not ``known`` yet.

    A finding has its windows as ``_examples`` makes them, a run those in its surroundings, from which ``_windows`` derives
    the others; words have one each, some of a part together.
    """
    laid, starts = _laid_out(texts)
    words: list[list[tuple[int, int]]] = [[] for _ in range(_PARTS + 1)]
    runs, pieces = [], []
    for text, base in zip(texts, starts):
        spans = pattern_spans(text)
        cover = Cover(spans)
        found = {}
        for start, end, kind in spans:
            value = text[_value(text, start, kind):end]
            if value not in known[0] and any(c.isalpha() for c in value):  # a mere number may be anything
                known[0].add(value)
                found[_place(value)] = value
        if found:
            made: dict[int, list[np.ndarray]] = {}
            for _, place, window in _examples(text, {(0, place) for place in found}):
                made.setdefault(place, []).append(window)
            for place, windows in made.items():
                yield _side(found[place]), 0, np.concatenate(windows).tobytes()
        for m in _WORD.finditer(text):
            value = m[0]
            if value not in known[1] and (not spans or cover.free(*m.span())):
                known[1].add(value)
                words[_side(value)].append((base + m.start(), base + m.end()))
        for m in _CANDIDATE.finditer(text):
            value = m[0]
            if value not in known[2] and (not spans or cover.free(*m.span())):  # not partly a finding
                known[2].add(value)
                own = [(i, min(base + m.end(), i + INSIDE)) for i in range(base + m.start(), base + m.end(), INSIDE)]
                runs.append((_side(value), len(own)))
                pieces += own
    for part, own in enumerate(words):
        for at in range(0, len(own), _TOGETHER):
            yield part, 1, _codes(laid, *np.array(own[at:at + _TOGETHER]).T).tobytes()
    codes, at = _codes(laid, *np.array(pieces, np.int64).reshape(-1, 2).T), 0
    for part, n in runs:
        yield part, 2, codes[at:at + n].tobytes()
        at += n


def store_values(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(part, kind, codes) of the distinct findings, words and runs of every task, from all rows, stored by part.

    A value is held once per task (a task forgets what it has seen when that is much); its part follows from the value
    alone, so what calibrates is never what trains. Nothing is shuffled.
    """
    ready(docs.sparkSession)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        known: tuple[set[str], set[str], set[str]] = set(), set(), set()
        for rows in slices(batches, 0, 2_000_000):
            found = list(_values(rows.column(0).to_pylist(), known))
            yield batch(_VALUE, *(zip(*found) if found else [[]] * 3))
            for values in known:
                if len(values) > _KNOWN:
                    values.clear()
        release()

    texts = docs.select(F.col(text_col).alias("text")).filter("text is not null")
    return store(texts.mapInArrow(look, "part int, kind int, codes binary").select("kind", "codes", "part"), "values", ["part"])


def _windows(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(windows, labels) of some rows of ``store_values`` (kind, codes): runs also stand alone, and alone in capitals."""
    kind = rows.column(0).to_numpy()
    if not len(kind):
        return np.empty((0, LENGTH), np.uint8), np.empty(0, np.int64)
    cells = rows.column(1).to_pylist()
    many = np.array([len(c) // LENGTH for c in cells], np.int64)
    codes = np.frombuffer(b"".join(cells), np.uint8).reshape(-1, LENGTH)
    of = np.repeat(kind, many)
    run = np.flatnonzero(of == 2)
    alone = codes[run]
    last = np.cumsum(many)
    nth = (np.arange(len(of)) - np.repeat(last - many, many))[run]
    left = (np.repeat(last, many) - 1 - np.arange(len(of)))[run]  # windows of the run after this one
    size = (codes[np.repeat(last, many)[run] - 1, BEFORE:BEFORE + INSIDE] != 129).sum(axis=1)  # of its last window
    own = np.where(left == 0, 0, np.where(left == 1, size, INSIDE))
    alone[:, :BEFORE][nth == 0] = 129
    alone[:, BEFORE + INSIDE:][np.arange(AFTER) >= own[:, None]] = 129
    capital = np.where((alone >= 97) & (alone <= 122), alone - 32, alone)
    return np.concatenate([codes, alone, capital]), np.concatenate([of == 0, np.zeros(2 * len(run), bool)]).astype(np.int64)


def _flat(state: State) -> np.ndarray:
    return np.concatenate([w.ravel() for part in state[:3] for w in part.values()] + [[state.steps]])


def _unflat(numbers: np.ndarray, like: State) -> State:
    parts, at = [], 0
    for part in like[:3]:
        parts.append({})
        for k, w in part.items():
            parts[-1][k] = numbers[at:at + w.size].reshape(w.shape).astype(np.float32)
            at += w.size
    return State(*parts, float(numbers[at]))


def train_tasks(values: DataFrame, windows: tuple[float, float], rounds: int, passes: int, tasks: int, rate: float = 0.01) -> CharCnn:
    """Weights trained on all ``values`` (part, kind, codes) that do not calibrate.

    A round takes some of the parts: every task steps through its rows from the common weights, and the tasks' weights and
    moments are averaged by their windows. ``windows`` are those of each label.
    """
    state, weight = first_state(), class_weights(windows)
    for turn in range(rounds * passes):
        mine = values.filter(F.col("part") % rounds == turn % rounds).select("kind", "codes").coalesce(tasks)
        begun, own_rate = state, rate * (1 - 0.8 * turn / (rounds * passes))

        def work(batches: Iterator[pa.RecordBatch]) -> dict | None:
            own, seen = begun, 0
            for rows in batches:
                for at in range(0, rows.num_rows, _ROWS):
                    codes, labels = _windows(rows.slice(at, _ROWS))
                    order = np.random.default_rng([turn, seen]).permutation(len(codes))
                    for i in range(0, len(order), _STEP):
                        some = order[i:i + _STEP]
                        own = step(own, codes[some], labels[some], weight[labels[some]], own_rate)
                    seen += len(codes)
            return {"n": np.array([float(seen)]), "state": seen * _flat(own)} if seen else None

        sums = sum_batches(mine, work)
        if sums:
            state = _unflat(sums["state"] / sums["n"], state)
    return state.net()


def _kth(scores: DataFrame, label: int, k: int, low: float, high: float) -> float:
    """The ``k``-th smallest score (from 0) of a label, exactly: counts between ever closer bounds, then those few."""
    high = float(np.nextafter(high, np.inf))
    while True:
        edges = np.unique(np.linspace(low, high, 1_025))
        if len(edges) <= 2:
            return low

        def work(batches: Iterator[pa.RecordBatch]) -> dict:
            total = np.zeros(len(edges) - 1, np.int64)
            for rows in batches:
                z = rows.column(1).to_numpy()[rows.column(0).to_numpy() == label]
                z = z[(z >= edges[0]) & (z < edges[-1])]
                total += np.bincount(np.searchsorted(edges, z, "right") - 1, minlength=len(total))
            return {"n": total}

        counts = sum_batches(scores, work)["n"]
        upto = np.cumsum(counts)
        at = int(np.searchsorted(upto, k, "right"))
        k -= int(upto[at] - counts[at])
        low, high = float(edges[at]), float(edges[at + 1])
        if counts[at] <= 4_096:
            few = scores.filter((F.col("label") == label) & (F.col("z") >= low) & (F.col("z") < high)).select("z").collect()
            return sorted(r["z"] for r in few)[k]


def calibrate_tasks(net: CharCnn, held: DataFrame, recall: float, false: float = 0.0005) -> CharCnn:
    """``char_cnn.calibrate`` by all rows (kind, codes) of ``held``: sums and counts of tasks, no sample."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, _ROWS):
                codes, labels = _windows(rows.slice(at, _ROWS))
                yield batch(_SCORED, labels.astype(np.int32), net.logits(codes))
        release()

    scores = store(held.select("kind", "codes").mapInArrow(look, "label int, z double"), "logits")
    seen = {r["label"]: r for r in scores.groupBy("label").agg(F.count("z").alias("n"), F.min("z").alias("low"),
                                                              F.max("z").alias("high")).collect()}  # a row per label
    n = [seen[c]["n"] if c in seen else 0 for c in (0, 1)]
    if all(n):
        spread = max(1e-9, *(abs(seen[c][side]) for c in (0, 1) for side in ("low", "high")))
        target = scale_targets(*n)

        def sums(a: float, b: float) -> np.ndarray:
            def work(batches: Iterator[pa.RecordBatch]) -> dict:
                return {"s": sum((scale_sums(rows.column(1).to_numpy() / spread, target[rows.column(0).to_numpy()], a, b)
                                  for rows in batches), np.zeros(5))}
            return sum_batches(scores, work)["s"]

        slope, offset = fit_scale(sums)
        net = net._replace(slope=slope / spread, offset=offset)

    def probability(label: int, k: int) -> float:
        """The ``k``-th smallest of a label."""
        z = _kth(scores, label, k if net.slope >= 0 else n[label] - 1 - k, seen[label]["low"], seen[label]["high"])
        return float(1.0 / (1.0 + np.exp(-np.clip(net.slope * z + net.offset, -60, 60))))

    threshold = probability(1, int(np.floor((1 - recall) * n[1]))) if n[1] else 1.1
    if n[0]:
        threshold = max(threshold, float(np.nextafter(probability(0, n[0] - 1 - int(false * n[0])), 2.0)))
    return net._replace(threshold=threshold)


def learn_all(docs: DataFrame, recall: float = 0.98, text_col: str = "text") -> CharCnn | None:
    """A network from all findings, words and runs of all rows: three of four distinct values train, the others calibrate.

    Large tables are passed through once, in ``_PARTS`` rounds; small ones in fewer rounds and up to ``_PASSES`` times.
    Where all values of a label fell on one side they serve both. None without an example of each label.
    """
    values = store_values(docs, text_col)
    windows = F.sum(F.octet_length("codes") / LENGTH * F.when(F.col("kind") == 2, 3).otherwise(1)).alias("n")
    counts = {(r["held"], r["label"]): r["n"] for r in values.groupBy(
        (F.col("part") == _HELD).alias("held"), (F.col("kind") == 0).cast("int").alias("label")).agg(windows).collect()}
    both = [c for c in (0, 1) if ((True, c) in counts) != ((False, c) in counts)]
    if any((True, c) not in counts and (False, c) not in counts for c in (0, 1)):
        return None
    shared = (F.col("kind") == 0).cast("int").isin(both) if both else F.lit(False)
    n = tuple(counts.get((False, c), counts.get((True, c))) for c in (0, 1))
    rounds = max(r for r in (1, 2, 4, _PARTS) if r == 1 or r * _SHARE <= sum(n))
    passes = int(min(_PASSES, max(1, -(-_ENOUGH // sum(n)))))
    tasks = max(1, int(sum(n) / rounds) // _SHARE)
    training = values.filter((F.col("part") != _HELD) | shared)
    net = train_tasks(training, n, rounds, passes, tasks)
    return calibrate_tasks(net, values.filter((F.col("part") == _HELD) | shared), recall)


def learn(docs: DataFrame, findings: int | None = None, others: int | None = None, most: int | None = None, recall: float = 0.98,
          text_col: str = "text") -> CharCnn | None:
    """A network from all findings, words and runs of all rows (``learn_all``).

    With bounds, from at most ``findings`` distinct findings and ``others`` distinct words and runs each, and at most
    ``most`` windows of each label, on the driver. What calibrates stems from other values than what trains. Rows without
    an id and repeated rows count; nulls don't. Without an example of each label there is nothing to learn, and nothing is
    added to the patterns' findings.
    """
    if findings is None and others is None and most is None:
        return learn_all(docs, recall, text_col)
    sides = split_examples(sample_examples(docs, findings or 400, others or 3_000, text_col), most or 6_000)
    arrays = [(np.array([np.frombuffer(c, np.uint8) for _, c in side]).reshape(len(side), LENGTH), np.array([l for l, _ in side]))
              for side in sides]
    if len(set(arrays[0][1].tolist())) < 2:
        return None
    return calibrate(train(*arrays[0]), *arrays[1], recall)


def find_spans(texts: list[str], net: CharCnn | None) -> list[list[tuple[str, int, int, float | None]]]:
    """(kind, start, end, probability) per text: the patterns' findings and what the network adds, in order."""
    found, owners, windows = [], [], []
    for row, text in enumerate(texts):
        spans = pattern_spans(text)
        found.append([(kind, start, end, None) for start, end, kind in spans])
        if net is not None:
            for start, end, kind in [*spans, *((*c, LEARNED) for c in candidates(text, spans))]:
                for window in candidate_windows(text, _value(text, start, kind), end):
                    owners.append((row, start, end, kind))
                    windows.append(window)
    if windows:
        best: dict[tuple[int, int, int, str], float] = {}
        for owner, p in zip(owners, net.probabilities(np.array(windows)).tolist()):
            best[owner] = max(p, best.get(owner, 0.0))
        order = {kind: place for place, kind in enumerate([*KINDS, LEARNED])}
        for row in {owner[0] for owner in best}:
            found[row] = []
        for (row, start, end, kind), p in best.items():
            if kind != LEARNED or p >= net.threshold:  # what a pattern finds stays
                found[row].append((kind, start, end, p))
        for spans in found:
            spans.sort(key=lambda s: (s[1], order[s[0]]))
    return found


def _span_array(found: list[list[tuple]]) -> pa.Array:
    names = ("kind", "start", "end", "probability")
    return pa.array([[dict(zip(names, span)) for span in one] for one in found], _SPAN)


def scan(docs: DataFrame, net: CharCnn | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every row, positions in code points, ends exclusive.

    A null or empty text has no spans; null and repeated ids are kept and every row is scanned by itself, a text of any
    length whole; an empty table gives no rows. Rows are independent: nothing is shuffled.
    """
    ready(docs.sparkSession)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for rows in slices(batches, 1, 4_000_000):
            texts = [t or "" for t in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), _span_array(find_spans(texts, net))], names=["doc_id", "spans"])
        release()

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(look, f"doc_id long, spans {SPAN}"))


def blank(text: str, spans: list[tuple[str, int, int, float | None]], mark: str) -> str:
    """The text with every stretch that spans cover replaced by one ``mark``."""
    covered: list[list[int]] = []
    for _, start, end, _ in spans:  # by start
        if covered and start < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    out, at = [], 0
    for start, end in covered:
        out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, net: CharCnn | None, mark: str = "[SECRET]", text_col: str = "text",
           length_col: str = "n_chars") -> DataFrame:
    """The rows with secrets blanked out of their texts; ``length_col``, if there, then counts the new text's characters.

    All other columns pass unread. Nulls stay null; rows without secrets stay as they are.
    """
    ready(docs.sparkSession)
    at = docs.columns.index(text_col)
    counted = docs.columns.index(length_col) if length_col in docs.columns else None

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for rows in slices(batches, at, 2_000_000):
            texts = rows.column(at).to_pylist()
            found = find_spans([t or "" for t in texts], net)
            made = [blank(t, s, mark) if s else t for t, s in zip(texts, found)]
            columns = list(rows.columns)
            columns[at] = pa.array(made, columns[at].type)
            if counted is not None:
                lengths = [len(t) if s else n for t, s, n in zip(made, found, columns[counted].to_pylist())]
                columns[counted] = pa.array(lengths, columns[counted].type)
            yield pa.RecordBatch.from_arrays(columns, schema=rows.schema)
            texts = found = made = columns = None
            release()

    return docs.mapInArrow(rewrite, T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema.fields]))
