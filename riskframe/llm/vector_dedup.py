"""Near copies of embeddings: random-hyperplane sign hashing, exact cosine verification, connected components.

Rows with the same label and vector are folded into one first. Every distinct vector gets a sign code per table; those
that share a code in a table (and the label) are compared exactly in double precision, many buckets at a time. A pair
counts in the first table it meets in, so no pair is emitted or shuffled: a task returns the links of each vector as a
number, and a forest of them for the components. The codes' bits follow the rows of the largest label, so that unlike
vectors rarely meet, and the number of tables follows from the bits and the allowed share of missed pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskframe.llm.components import connected_components, forest
from riskframe.llm.top_k import usable
from riskframe.llm.workers import batch, ready
from riskframe.plans.storage import store

_CODED = pa.schema([("rep", pa.int64()), ("label", pa.int64()), ("copies", pa.int64()), ("codes", pa.list_(pa.int32())),
                    ("v", pa.binary())])
_PAIRS = 100_000
#: Buckets of up to so many rows are compared together, pair by pair.
_SMALL = 48
_FOUND = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def sign_codes(vectors: np.ndarray, tables: int, bits: int, seed: int = 20) -> np.ndarray:
    """One code per vector and table: the signs of ``bits`` projections, as whole numbers."""
    planes = np.random.default_rng(seed).standard_normal((vectors.shape[1], tables * bits))
    signs = (vectors @ planes >= 0).reshape(len(vectors), tables, bits)
    return (signs << np.arange(bits)).sum(axis=2).astype("<u4")


def bits_for(rows: int) -> int:
    """Bits of a code: so many that about one in eight of ``rows`` unlike vectors meets another in a table."""
    return min(30, max(8, rows.bit_length() + 3))


def tables_for(bits: int, least: float, miss: float) -> int:
    """Tables after which two vectors at a cosine of ``least`` have met but for a probability of ``miss``."""
    same = (1 - math.acos(least) / math.pi) ** bits
    return max(1, math.ceil(math.log(miss) / math.log1p(-same)))


class Found:
    """Links and a forest, collected from pairs of rows."""

    def __init__(self, rows: pa.Table, least: float):
        self.reps, self.copies = rows["rep"].to_numpy(), rows["copies"].to_numpy()
        self.tab = rows["tab"].to_numpy()
        codes = rows["codes"].combine_chunks()
        self.codes = codes.flatten().to_numpy().reshape(len(self.reps), -1)
        self.v = np.frombuffer(b"".join(rows["v"].to_pylist()), "<f8").reshape(len(self.reps), -1)
        self.norms = np.sqrt(np.einsum("ij,ij->i", self.v, self.v))
        self.least, self.links = least, np.zeros(len(self.reps), np.int64)
        self.a, self.b = np.empty(0, np.int64), np.empty(0, np.int64)

    def near(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", self.v[p], self.v[q]) / (self.norms[p] * self.norms[q]) >= self.least

    def add(self, p: np.ndarray, q: np.ndarray) -> None:
        """Near pairs; those that have met in an earlier table are left out."""
        for at in range(0, len(p), _PAIRS):
            x, y = p[at:at + _PAIRS], q[at:at + _PAIRS]
            first = (self.codes[x] == self.codes[y]).argmax(axis=1) == self.tab[x]
            x, y = x[first], y[first]
            np.add.at(self.links, x, self.copies[y])
            np.add.at(self.links, y, self.copies[x])
            self.a, self.b = forest(np.concatenate([self.a, self.reps[x]]), np.concatenate([self.b, self.reps[y]]))

    def rows(self) -> pa.Table:
        met = np.flatnonzero(self.links)
        nodes = np.concatenate([self.reps[met], self.a])
        counts = np.concatenate([self.links[met], np.zeros(len(self.a), np.int64)])
        return pa.Table.from_arrays([pa.array(nodes), pa.array(counts), pa.array(np.concatenate([self.reps[met], self.b]))],
                                    schema=_FOUND)


def _block(rows: pa.Table, least: float, cross: bool = False) -> pa.Table:
    """Links of one block, or between two blocks of a bucket."""
    found = Found(rows, least)
    side = rows["block"].to_numpy() if cross else None
    for start in range(0, rows.num_rows, 256):
        stop = min(start + 256, rows.num_rows)
        near = (found.v[start:stop] @ found.v.T) / (found.norms[start:stop, None] * found.norms[None, :]) >= least
        near &= np.arange(rows.num_rows)[None, :] > np.arange(start, stop)[:, None]
        if cross:
            near &= side[None, :] != side[start:stop, None]
        x, y = np.nonzero(near)
        found.add(x + start, y)
    return found.rows()


def _buckets(rows: pa.Table, cuts: np.ndarray, least: float) -> pa.Table:
    """Links of many small buckets that lie one after another; ``cuts`` are their starts and the end."""
    found = Found(rows, least)
    sizes = np.diff(cuts)
    number = np.arange(rows.num_rows) - np.repeat(cuts[:-1], sizes)  # place in the bucket, so many pairs has a row with those before it
    ends = np.cumsum(number)
    start = 0
    while start < rows.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _PAIRS, "right")))
        part = number[start:stop]
        later = np.repeat(np.arange(start, stop), part)
        earlier = later - 1 - (np.arange(len(later)) - np.repeat(np.cumsum(part) - part, part))
        near = found.near(later, earlier)
        found.add(later[near], earlier[near])
        start = stop
    return found.rows()


def dedup_vectors(vectors: DataFrame, least: float = 0.98, miss: float = 1e-6, bits: int | None = None,
                  block_rows: int = 2_048, id_col: str = "vec_id", vector_col: str = "embedding",
                  label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row; rows link at a cosine of ``least`` or more.

    Only rows with the same, non-null label and as many components are compared. Vectors that are null, empty, zero or
    hold null or non-finite components link with nothing, nor do rows without an id (their component is null, they are
    not kept). Every row counts as a vector of its own, so exact copies and repeated rows link with each other. A pair
    at a cosine of ``least`` is missed with a probability of ``miss``, closer ones less often; ``bits`` of a code follow
    the largest label's rows unless they are given. An empty table gives no rows. A bucket of more than ``block_rows``
    is cut into blocks of about so many; pairs of them are groups.
    """
    spark = ready(vectors.sparkSession)
    x = F.col("x")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x"),
                          F.col(label_col).cast("long").alias("label"))
    norm = F.aggregate(x, F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    takes_part = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(x)
                  & F.when(usable(x), norm > 0).otherwise(False))
    part = rows.filter(takes_part)
    distinct = store(part.groupBy("label", "x").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vectors")
    if bits is None:
        bits = bits_for(distinct.groupBy("label").count().agg(F.max("count")).first()[0] or 0)
    tables = tables_for(bits, least, miss)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for start in range(0, big.num_rows, 1_000):
                rows = big.slice(start, 1_000)
                found = rows.column(3).to_pylist()
                for size in sorted(set(map(len, found))):
                    at = [i for i, f in enumerate(found) if len(f) == size]
                    v = np.array([found[i] for i in at], "<f8")
                    codes = sign_codes(v, tables, bits).astype(np.int32)
                    offsets = np.arange(0, len(at) * tables + 1, tables, dtype=np.int32)
                    yield batch(_CODED, *(rows.column(i).take(pa.array(at)) for i in range(3)),
                                pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.ravel())), [one.tobytes() for one in v])

    key = ["label", "dims", "tab", "code"]
    coded = (distinct.select("rep", "label", "copies", F.col("x").cast("array<double>").alias("x"))
             .mapInArrow(code, "rep long, label long, copies long, codes array<int>, v binary")
             .withColumn("dims", F.octet_length("v")))
    coded = store(coded, "codes")
    places = coded.select("rep", "label", "dims", F.posexplode("codes").alias("tab", "code"))
    full = store(places.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    met = store(places.join(full, key).join(coded.select("rep", "copies", "codes", "v"), "rep"), "met")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def close(rows: pa.Table, last: bool) -> tuple[pa.Table, pa.Table]:
            parts = [rows[k].to_numpy() for k in key]
            new = np.zeros(rows.num_rows, bool)
            new[:1] = True
            for one in parts:
                new[1:] |= one[1:] != one[:-1]
            cuts = np.append(np.flatnonzero(new), rows.num_rows)
            if not last:  # the last bucket may go on
                cuts = cuts[:-1]
            whole = rows.slice(0, int(cuts[-1]))
            made = [_FOUND.empty_table()]
            dims, sizes = whole["dims"].to_numpy()[cuts[:-1]], np.diff(cuts)
            for size in np.unique(dims).tolist():  # vectors of one length each
                own = np.flatnonzero((dims == size) & (sizes <= _SMALL))
                pick = np.repeat(cuts[own] - (np.cumsum(sizes[own]) - sizes[own]), sizes[own]) + np.arange(sizes[own].sum())
                made.append(_buckets(whole.take(pa.array(pick)), np.concatenate([[0], np.cumsum(sizes[own])]), least))
            made += [_block(whole.slice(cuts[i], sizes[i]), least) for i in np.flatnonzero(sizes > _SMALL).tolist()]
            return pa.concat_tables(made), rows.slice(int(cuts[-1]))

        for rows in batches:
            held = pa.Table.from_batches([rows]) if held is None else pa.concat_tables([held, pa.Table.from_batches([rows])])
            if held.num_rows < 20_000:
                continue
            found, held = close(held.combine_chunks(), last=False)
            yield from found.combine_chunks().to_batches()
        if held is not None and held.num_rows:
            found, _ = close(held.combine_chunks(), last=True)
            yield from found.combine_chunks().to_batches()

    kind = "node long, links long, root long"
    small = met.filter(F.col("n") <= block_rows).repartition(*key).sortWithinPartitions(*key, "rep").mapInArrow(compare, kind)
    big = (met.filter(F.col("n") > block_rows).withColumn("blocks", F.ceil(F.col("n") / block_rows).cast("int"))
           .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")))
    met = store(small.union(big.groupBy(*key, "low", "high").applyInArrow(
        lambda k, t: _block(t, least, k[4].as_py() != k[5].as_py()), kind)), "links")
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    tied = connected_components(met.select("node", "root").filter("node <> root").distinct(), "node", "root")
    folded = (distinct.join(links, F.col("rep") == F.col("node"), "left").drop("node")
              .join(tied, F.col("rep") == F.col("node"), "left")
              .select(F.col("label").alias("l"), F.col("x").alias("v"),
                      (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                      F.coalesce("component", "rep").alias("component_id")))
    linked = part.join(folded, (F.col("label") == F.col("l")) & (F.col("x") == F.col("v")))
    rest = rows.filter(~takes_part).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                           F.col("vec_id").alias("component_id"))
    return (linked.select("vec_id", "n_links", "component_id").union(rest)
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
