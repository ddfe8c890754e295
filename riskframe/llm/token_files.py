"""Token-id files: fixed-width bit packing with block offsets.

Every id is stored in as few bits as the vocabulary needs. A file holds whole documents in ascending id order:

    magic "RTOK" | version u16 | bits u16 | block_ids u32 | n_documents u64 | n_ids u64 | n_blocks u64
    block_offsets u64[n_blocks + 1]   byte offsets into the packed part
    doc_ids i64[n], has_id u8[n]      (has_id 0: the document's id is null)
    doc_starts u64[n + 1]             positions of the documents' ids in this file
    packed blocks                     block_ids ids each, the first id in the lowest bits, each from a full byte

All numbers are little-endian. One block can be unpacked without the others. Files are the ``file`` column of a Parquet
folder, since Spark's own writers reach every store; ``part`` and ``first`` place a file in the whole.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskframe.llm.tokens import library_encoder, slices, text_array
from riskframe.llm.workers import batch, ready, shuffle_width, task_number

_HEAD = struct.Struct("<4sHHIQQQ")
_FILE_SCHEMA = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
                          ("file", pa.binary())])
_READ_SCHEMA = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])


def bits_for(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """The ids in ``bits`` bits each, lowest bits first; the last byte is filled with zeros."""
    if bits in (8, 16, 32):  # the same bytes, without going through single bits
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(packed: bytes, bits: int, count: int) -> np.ndarray:
    """``count`` ids as unsigned 32-bit integers."""
    if bits in (8, 16, 32):
        return np.frombuffer(packed, f"<u{bits // 8}", count).astype("<u4")
    spread = np.unpackbits(np.frombuffer(packed, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    return (spread.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32).astype("<u4")


def make_file(doc_ids: list[int | None], ids: np.ndarray, starts: np.ndarray, bits: int, block_ids: int) -> bytes:
    """One file of the format above; ``starts`` has one entry more than there are documents."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id of {int(ids.max())} doesn't fit {bits} bits")
    blocks = [pack_bits(ids[at:at + block_ids], bits) for at in range(0, len(ids), block_ids)]
    offsets = np.zeros(len(blocks) + 1, "<u8")
    np.cumsum([len(b) for b in blocks], out=offsets[1:])
    return b"".join([
        _HEAD.pack(b"RTOK", 1, bits, block_ids, len(doc_ids), len(ids), len(blocks)), offsets.tobytes(),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is not None for d in doc_ids], np.uint8).tobytes(), starts.astype("<u8").tobytes(), *blocks])


class TokenFile:
    """Reader of one file; unpacks only the blocks that are asked for."""

    def __init__(self, data: bytes):
        magic, version, self.bits, self.block_ids, n_docs, self.n_ids, n_blocks = _HEAD.unpack_from(data)
        if magic != b"RTOK" or version != 1:
            raise ValueError("not a token file of version 1")
        at = _HEAD.size
        self.block_offsets = np.frombuffer(data, "<u8", n_blocks + 1, at)
        at += 8 * (n_blocks + 1)
        raw = np.frombuffer(data, "<i8", n_docs, at).tolist()
        at += 8 * n_docs
        self.doc_ids = [d if has else None for d, has in zip(raw, data[at:at + n_docs])]
        at += n_docs
        self.starts = np.frombuffer(data, "<u8", n_docs + 1, at).astype(np.int64)
        self.packed = memoryview(data)[at + 8 * (n_docs + 1):]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to ``stop`` of this file."""
        if stop <= start:
            return np.empty(0, "<u4")
        low, high = start // self.block_ids, (stop - 1) // self.block_ids + 1
        if low + 1 < high and self.block_ids * self.bits % 8 == 0:  # such blocks follow without a gap
            count = min(high * self.block_ids, self.n_ids) - low * self.block_ids
            found = unpack_bits(self.packed[self.block_offsets[low]:self.block_offsets[high]], self.bits, count)
        else:
            found = np.concatenate([
                unpack_bits(self.packed[self.block_offsets[b]:self.block_offsets[b + 1]], self.bits,
                            min(self.block_ids, self.n_ids - b * self.block_ids)) for b in range(low, high)])
        return found[start - low * self.block_ids:stop - low * self.block_ids]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(id, start in this file, ids) of every document."""
        found = self.ids(0, self.n_ids)
        for doc, start, stop in zip(self.doc_ids, self.starts[:-1].tolist(), self.starts[1:].tolist()):
            yield doc, start, found[start:stop]


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, vocabulary: int, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", file_ids: int = 2_000_000, block_ids: int = 65_536) -> None:
    """Encode whole texts, put ``end_id`` after each and write them in ascending id order.

    Texts are dealt into ranges of ids, one per shuffle partition, and encoded in order. A file is closed at a
    document's end once it holds ``file_ids`` ids; a longer document has a file of its own. Null texts are empty (one
    id, the end); a null id comes first; rows that share an id stand together, by text; an empty table writes no files.
    """
    spark = ready(docs.sparkSession)
    bits = bits_for(vocabulary)
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
               .repartitionByRange(shuffle_width(spark), "doc_id").sortWithinPartitions("doc_id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = library_encoder(tokenizer), task_number()
        shard = first = 0
        held_docs, held, starts = [], [], [0]
        def file() -> pa.RecordBatch:
            data = make_file(held_docs, np.concatenate(held), np.array(starts), bits, block_ids)
            return batch(_FILE_SCHEMA, [part], [shard], [first], [starts[-1]], [data])
        for rows in slices(batches, 1):
            ids, offsets = encode(text_array(rows.column(1)), end_id)
            for row, doc in enumerate(rows.column(0).to_pylist()):
                piece = ids[offsets[row]:offsets[row + 1]]
                if held_docs and starts[-1] + len(piece) > file_ids:
                    yield file()
                    shard, first = shard + 1, first + starts[-1]
                    held_docs, held, starts = [], [], [0]
                held_docs.append(doc)
                held.append(piece)
                starts.append(starts[-1] + len(piece))
        if held_docs:
            yield file()

    (ordered.mapInArrow(write, "part int, shard int, first long, n_ids long, file binary")
     .write.option("compression", "zstd").parquet(folder))


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids) of every document: ``start`` counts the ids of all documents before it, ``ids`` are
    little-endian unsigned 32-bit integers with the end id.

    Only one number per range of ids is added up in one place.
    """
    ready(spark)
    files = spark.read.schema("part int, shard int, first long, n_ids long, file binary").parquet(folder)
    before = (files.groupBy("part").agg(F.sum("n_ids").alias("n"))
              .select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for part, first, data in zip(*(c.to_pylist() for c in rows.columns)):
                found = list(TokenFile(data).documents())
                yield batch(_READ_SCHEMA, [part] * len(found), [d for d, _, _ in found],
                            [first + s for _, s, _ in found], [ids.tobytes() for _, _, ids in found])

    rows = files.select("part", "first", "file").mapInArrow(read, "part int, doc_id long, start long, ids binary")
    # One row per shuffle partition of the writer: bounded whatever the table.
    return (rows.join(F.broadcast(before), "part")
            .select("doc_id", (F.col("start") + F.col("before")).alias("start"), "ids"))
