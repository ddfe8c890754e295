"""Dictionary join of documents in chunks.

Some operators need a value for every distinct term (a word, an n-gram) of the corpus, and then all values for each
document. Documents are gathered into chunks of bounded size. A chunk keeps what it needs of its documents as one
compressed payload and lists its distinct terms; only those are shuffled, once per chunk, so a frequent term has as many
rows as there are chunks and no more. Values come back as one list per chunk. Chunks lie in a table bucketed by their
number, so the payloads are not shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from riskframe.llm.tokens import forget, slices
from riskframe.llm.workers import ready, release, short_batches, shuffle_width, task_number
from riskframe.plans.storage import fresh_path

_CHUNK = pa.schema([("chunk", pa.int64()), ("payload", pa.binary()), ("terms", pa.list_(pa.string())),
                    ("counts", pa.list_(pa.int64()))])
_ZSTD = pa.ipc.IpcWriteOptions(compression="zstd")


def to_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=_ZSTD) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def from_bytes(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all().combine_chunks()


def chunked(docs: DataFrame, text: int, build: Callable[[pa.Table], tuple], label: str, size: int) -> DataFrame:
    """(chunk, payload, terms, counts) of chunks with about ``size`` bytes of text, as a table bucketed by chunk.

    ``build`` gets the rows of a chunk and returns its payload, its distinct terms and, if it counts them, an array of
    counts beside the terms.
    """
    spark = ready(docs.sparkSession)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, weight = task_number() << 24, [], 0
        forget()

        def close() -> pa.RecordBatch:
            payload, terms, *counts = build(pa.Table.from_batches(held).combine_chunks())
            ends = pa.array([0, len(terms)], pa.int32())
            counted = pa.ListArray.from_arrays(ends, counts[0]) if counts else pa.array([None], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([to_bytes(payload)], pa.binary()),
                                               pa.ListArray.from_arrays(ends, terms), counted], schema=_CHUNK)
        for rows in slices(batches, text, max(1, size // 4)):
            held.append(rows)
            weight += pc.sum(pc.binary_length(rows.column(text))).as_py() or 0
            if weight >= size:
                yield close()
                number, held, weight = number + 1, [], 0
                release()
        if held:
            yield close()
        held = []
        release()

    name = f"{label}_{uuid.uuid4().hex}"
    with short_batches(spark):
        (docs.mapInArrow(gather, "chunk long, payload binary, terms array<string>, counts array<bigint>")
         .write.option("path", fresh_path(spark, label)).option("compression", "zstd")
         .bucketBy(shuffle_width(spark), "chunk").saveAsTable(name))
    return spark.table(name)


def term_rows(chunks: DataFrame) -> DataFrame:
    """(chunk, pos, term): the distinct terms of every chunk."""
    return chunks.select("chunk", F.posexplode("terms").alias("pos", "term"))


def by_distinct_term(terms: DataFrame, values: Callable[[list[str]], list], kind: pa.DataType, sql_kind: str,
                     block: int = 200_000) -> DataFrame:
    """(chunk, pos, values) lists; ``values`` is called once per distinct term of the corpus, ``block`` at a time.

    The terms are sorted inside their partition; only a term whose rows straddle two blocks is looked up again.
    """
    schema = pa.schema([("chunk", pa.int64()), ("pos", pa.list_(pa.int32())), ("values", pa.list_(kind))])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows_held = [], 0

        def close() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            coded = table["term"].combine_chunks().dictionary_encode()
            known = pa.array(values(coded.dictionary.to_pylist()), kind)
            return pack(schema, table["chunk"].to_numpy(), table["pos"].to_numpy(), known.take(coded.indices))
        for rows in batches:
            held.append(rows)
            rows_held += rows.num_rows
            if rows_held >= block:
                yield close()
                held, rows_held = [], 0
        if rows_held:
            yield close()
        held = []
        release()

    return (terms.repartition("term").sortWithinPartitions("term")
            .mapInArrow(look_up, f"chunk long, pos array<int>, values array<{sql_kind}>"))


def pack(schema: pa.Schema, chunk: np.ndarray, pos: np.ndarray, *values: pa.Array) -> pa.RecordBatch:
    """One row per chunk with lists of positions and values."""
    order = np.argsort(chunk, kind="stable")
    ordered = chunk[order]
    cuts = np.flatnonzero(np.diff(ordered, prepend=ordered[0] - 1)) if len(ordered) else np.empty(0, np.int64)
    offsets = pa.array(np.append(cuts, len(ordered)).astype(np.int32))
    pick = pa.array(order)
    columns = [pa.array(pos).cast(pa.int32()), *values]
    return pa.RecordBatch.from_arrays(
        [pa.array(ordered[cuts]), *(pa.ListArray.from_arrays(offsets, c.take(pick)) for c in columns)], schema=schema)


def finish(chunks: DataFrame, found: DataFrame, make: Callable[[pa.Table, pa.Array, dict[str, pa.Array]], pa.Table],
           kind: str) -> DataFrame:
    """Bring the values back to their chunks.

    ``found`` has a chunk, a list ``pos`` and lists of values; ``make`` gets the payload, the terms and for each list of
    values one array beside the terms, null where nothing was found.
    """
    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        terms = left["terms"].combine_chunks().flatten()
        pos = right["pos"].combine_chunks().flatten()
        place = np.full(len(terms), -1, np.int64)
        place[pos.to_numpy(zero_copy_only=False)] = np.arange(len(pos))
        pick = pa.array(place, mask=place < 0)
        lists = {name: right[name].combine_chunks().flatten().take(pick)
                 for name in right.column_names if name not in ("chunk", "pos")}
        made = make(from_bytes(left["payload"][0].as_py()), terms, lists)
        release()
        return made

    return chunks.select("chunk", "payload", "terms").groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(one, kind)


def frequency_codes(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(code of every entry, distinct entries), the most frequent first: small numbers compress well."""
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy()
    order = np.argsort(-np.bincount(codes, minlength=len(coded.dictionary)), kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    return rank[codes], coded.dictionary.take(pa.array(order))


def planes(codes: np.ndarray) -> dict[str, pa.Array]:
    """Whole numbers below 2^32 as four columns of one byte each; the high ones compress to nothing."""
    split = codes.astype("<u4").view(np.uint8).reshape(-1, 4)
    return {f"p{i}": pa.array(np.ascontiguousarray(split[:, i])) for i in range(4)}


def joined(table: pa.Table) -> np.ndarray:
    """The numbers behind ``planes``."""
    split = np.stack([table[f"p{i}"].to_numpy() for i in range(4)], axis=1)
    return np.ascontiguousarray(split).view("<u4").ravel().astype(np.int64)
