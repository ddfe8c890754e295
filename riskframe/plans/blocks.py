"""Dense row blocks, and sums of arrays over all of them.

Iterative learners read the same rows again and again. They are stored once as blocks (the vectors of some thousand rows
as one matrix, and what goes with them as arrays), so a pass over the table is a few matrix products per block. Every
task folds its blocks into one set of arrays; the tasks' arrays are added up in a tree.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from riskframe.plans.storage import store
from riskframe.plans.workers import light_batches, ready

#: With more tasks than this, their arrays are added up by groups of tasks first.
FAN_IN = 64
#: Bytes of a stored row group: a pass divides files between its tasks by them.
ROW_GROUP = 1_000_000


class Block:
    """One block: the matrix ``x`` (rows x slots) and further arrays by name, one row each."""

    def __init__(self, rows: pa.RecordBatch, at: int, kinds: Mapping[str, str]):
        self.n = rows.column(0)[at].as_py()
        self.arrays = {name: np.frombuffer(rows.column(1 + i)[at].as_buffer(), kind).reshape(self.n, -1)
                       for i, (name, kind) in enumerate(kinds.items())}

    @classmethod
    def plain(cls, n: int, cells: Iterable[bytes], kinds: Mapping[str, str]) -> Block:
        """From the bytes of its arrays."""
        block = cls.__new__(cls)
        block.n = n
        block.arrays = {name: np.frombuffer(cell, kind).reshape(n, -1) for cell, (name, kind) in zip(cells, kinds.items())}
        return block

    @property
    def x(self) -> np.ndarray:
        return self.arrays["x"]

    def __getitem__(self, name: str) -> np.ndarray:
        found = self.arrays[name]
        return found[:, 0] if found.shape[1] == 1 else found


class Blocks:
    """A stored table of blocks; ``kinds`` are the NumPy types of its arrays."""

    def __init__(self, table: DataFrame, kinds: Mapping[str, str]):
        self.table, self.kinds = table, dict(kinds)


def blocks_of(batches: Iterator[pa.RecordBatch], kinds: Mapping[str, str]) -> Iterator[Block]:
    for rows in batches:
        for at in range(rows.num_rows):
            yield Block(rows, at, kinds)


def joined(blocks: Iterable[Block], size: int = 65_536) -> Iterator[Block]:
    """The blocks one after another, in blocks of ``size`` rows at least (the last may have fewer)."""
    waiting: list[Block] = []
    for block in blocks:
        waiting.append(block)
        if sum(b.n for b in waiting) >= size:
            yield _one(waiting)
            waiting = []
    if waiting:
        yield _one(waiting)


def _one(blocks: list[Block]) -> Block:
    if len(blocks) == 1:
        return blocks[0]
    block = Block.__new__(Block)
    block.n = sum(b.n for b in blocks)
    block.arrays = {name: np.concatenate([b.arrays[name] for b in blocks]) for name in blocks[0].arrays}
    return block


def make_blocks(df: DataFrame, vector: str, columns: Mapping[str, tuple[Column, str]], size: int = 4_096,
                x_kind: str = "<f8", tasks: int | None = None) -> Blocks:
    """Store ``df`` as blocks of up to ``size`` rows.

    ``columns`` names further arrays: an expression (a number, or an array of numbers of one length) and a NumPy type.
    Vectors must be of one length; a vector column may be sparse, dense or an array. ``tasks`` deals the blocks out to as
    many files: where few bytes mean much work, Spark would make few tasks of them.
    """
    ready(df.sparkSession)
    kinds = {"x": x_kind, **{name: kind for name, (_, kind) in columns.items()}}
    values = F.col(vector) if df.schema[vector].dataType.typeName() == "array" else vector_to_array(vector)
    rows = df.select(values.alias("x"), *[c.alias(name) for name, (c, _) in columns.items()])
    schema = pa.schema([("n", pa.int64()), *((name, pa.binary()) for name in kinds)])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                cells = []
                for column, kind in zip(part.columns, kinds.values()):
                    flat = column.flatten() if pa.types.is_list(column.type) else column
                    if len(flat) % part.num_rows or flat.null_count:
                        raise ValueError("vectors of one length and numbers that are not null are needed")
                    cells.append(pa.array([flat.to_numpy(zero_copy_only=False).astype(kind).tobytes()], pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array([part.num_rows], pa.int64()), *cells], schema=schema)

    made = rows.mapInArrow(gather, "n long, " + ", ".join(f"{name} binary" for name in kinds))
    if tasks:
        made = made.repartition(tasks)
    return Blocks(store(made, "blocks", row_group=ROW_GROUP), kinds)


Sums = dict[str, np.ndarray]


def add(a: Sums | None, b: Sums) -> Sums:
    """The sums of arrays by name; an array that only one of them has is kept."""
    if a is None:
        return dict(b)
    return {name: a[name] + b[name] if name in a and name in b else a.get(name, b.get(name)) for name in {*a, *b}}


def sum_batches(table: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Sums | None]) -> Sums:
    """What ``work`` makes of the rows of every task, added up: one job, and a few sets of arrays for the driver."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = work(batches)
        if total:
            slot = TaskContext.get().partitionId() % FAN_IN
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([pickle.dumps(total)], pa.binary())],
                                             names=["slot", "sums"])

    def together(table: pa.Table) -> pa.Table:
        total = None
        for one in table["sums"]:
            total = add(total, pickle.loads(one.as_py()))
        return pa.table({"slot": table["slot"].slice(0, 1), "sums": pa.array([pickle.dumps(total)], pa.binary())})

    parts = table.mapInArrow(fold, "slot int, sums binary")
    if table.rdd.getNumPartitions() > FAN_IN:
        parts = parts.groupBy("slot").applyInArrow(together, "slot int, sums binary")
    with light_batches(table.sparkSession):
        rows = parts.collect()  # at most FAN_IN
    total = None
    for row in rows:
        total = add(total, pickle.loads(bytes(row["sums"])))
    return total or {}


def sum_tasks(blocks: Blocks, work: Callable[[Iterator[Block]], Sums | None]) -> Sums:
    """What ``work`` makes of the blocks of every task, added up."""
    kinds = blocks.kinds
    return sum_batches(blocks.table, lambda batches: work(blocks_of(batches, kinds)))


def sum_blocks(blocks: Blocks, work: Callable[[Block], Sums]) -> Sums:
    """``work`` of every block, added up."""
    def every(own: Iterator[Block]) -> Sums | None:
        total = None
        for block in own:
            total = add(total, work(block))
        return total
    return sum_tasks(blocks, every)


class HeldBlocks:
    """Blocks that the executors hold, in memory or on their disks: for very many passes, each short beside reading a table."""

    def __init__(self, rows: RDD, kinds: Mapping[str, str]):
        self.rows, self.kinds = rows.persist(StorageLevel.MEMORY_AND_DISK), dict(kinds)

    def with_array(self, name: str, kind: str, work: Callable[[Block], np.ndarray]) -> HeldBlocks:
        """The same blocks with one more array, or another one of that name."""
        kinds, wide = self.kinds, {**self.kinds, name: kind}

        def run(row: tuple) -> tuple:
            block = Block.plain(row[0], row[1:], kinds)
            own = work(block).astype(kind, copy=False).tobytes()
            return row[0], *(own if n == name else row[1 + i] for i, n in enumerate(wide))
        return HeldBlocks(self.rows.map(run), wide)

    def sum(self, work: Callable[[Block], Sums]) -> Sums:
        """``work`` of every block, added up (as ``sum_blocks``)."""
        kinds = self.kinds

        def fold(rows: Iterator[tuple]) -> Iterator[tuple[int, bytes]]:
            total = None
            for n, *cells in rows:
                total = add(total, work(Block.plain(n, cells, kinds)))
            if total:
                yield TaskContext.get().partitionId() % FAN_IN, pickle.dumps(total)

        parts = self.rows.mapPartitions(fold)
        if self.rows.getNumPartitions() > FAN_IN:
            parts = parts.reduceByKey(lambda a, b: pickle.dumps(add(pickle.loads(a), pickle.loads(b))), FAN_IN)
        total = None
        for _, one in parts.collect():  # at most FAN_IN
            total = add(total, pickle.loads(one))
        return total or {}

    def release(self) -> None:
        self.rows.unpersist()


def hold(blocks: Blocks) -> HeldBlocks:
    rows = blocks.table.select("n", *blocks.kinds).rdd.map(lambda row: (row[0], *(bytes(c) for c in row[1:])))
    return HeldBlocks(rows, blocks.kinds)
