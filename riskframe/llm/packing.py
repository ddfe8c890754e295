"""Bounded-space online packing of documents into training windows.

Every partition keeps a fixed number of open windows. A document is encoded and closed by an end id; whole windows are
cut off a long one, and the rest goes to the open window it fills best. Where it fits none and no further window may
be opened, the fullest is emitted, topped up from the front of the document if both parts stay long enough. What is
open at the end of the partitions is merged: their pieces are packed again, 16 partitions at a time, and the emptiest
windows poured into the fullest.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskframe.llm.tokens import library_encoder, slices, text_array
from riskframe.llm.workers import batch, ready, release, task_number
from riskframe.plans.storage import store

#: Long, so that the number of a window says whether it was closed in a partition or in the merge.
_MERGED = 1 << 62
_KIND = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
         "part int, open boolean, ids binary")
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                     ("part", pa.int32()), ("open", pa.bool_()), ("ids", pa.binary())])


class Piece:
    """Some ids of one document; the document's id, its number of ids and where the piece begins in it."""

    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc: int | None, start: int, ids: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc, self.start, self.ids[:at], self.total),
                Piece(self.doc, self.start + at, self.ids[at:], self.total))


class Packer:
    """At most ``open_windows`` windows of ``window`` ids; ``place`` returns the windows that are closed by it.

    ``shortest``: no piece shorter than this is cut off to top up a window.
    """

    def __init__(self, window: int, open_windows: int, shortest: int):
        self.window, self.open_windows, self.shortest = window, open_windows, shortest
        self.fills: list[tuple[int, int]] = []  # (fill, number), ascending
        self.held: dict[int, list[Piece]] = {}
        self.number = 0

    def place(self, piece: Piece) -> list[list[Piece]]:
        closed = []
        while len(piece.ids) >= self.window:
            whole, piece = piece.cut(self.window)
            closed.append([whole])
        while size := len(piece.ids):
            at = bisect_right(self.fills, (self.window - size, self.number)) - 1
            if at >= 0:  # the fullest window that still takes it
                fill, number = self.fills.pop(at)
                self.held[number].append(piece)
                if fill + size == self.window:
                    closed.append(self.held.pop(number))
                else:
                    insort(self.fills, (fill + size, number))
                break
            if len(self.fills) < self.open_windows:
                self.held[self.number] = [piece]
                insort(self.fills, (size, self.number))
                self.number += 1
                break
            fill, number = self.fills.pop()
            gap = self.window - fill
            if gap >= self.shortest and size - gap >= self.shortest:
                front, piece = piece.cut(gap)
                self.held[number].append(front)
            closed.append(self.held.pop(number))
        return closed

    def left(self) -> list[list[Piece]]:
        """The open windows, the fullest first."""
        return [self.held[number] for _, number in reversed(self.fills)]


def pour(windows: list[list[Piece]], window: int) -> list[list[Piece]]:
    """Fill the fullest windows from the emptiest, cutting where needed; at most one stays with a gap."""
    queue = [piece for pieces in windows for piece in pieces]
    closed, now, fill = [], [], 0
    for piece in queue:
        while len(piece.ids):
            front, piece = piece.cut(min(len(piece.ids), window - fill))
            now.append(front)
            fill += len(front.ids)
            if fill == window:
                closed.append(now)
                now, fill = [], 0
    return closed + ([now] if now else [])


def _rows(windows: list[tuple[int, list[Piece]]], part: int, still_open: bool, with_ids: bool) -> pa.RecordBatch:
    out = []
    for sequence, pieces in windows:
        offset = 0
        for p in pieces:
            data = p.ids.astype("<u4", copy=False).tobytes()
            out.append((p.doc, p.start, len(p.ids), zlib.crc32(data), p.total, sequence, offset, part, still_open,
                        data if still_open or with_ids else None))
            offset += len(p.ids)
    return batch(_SCHEMA, *(zip(*out) if out else [[]] * len(_SCHEMA)))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, window: int = 2_048, open_windows: int = 64,
                   shortest: int = 16, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text",
                   slice_bytes: int = 16_000_000, stretches: int = 800_000) -> DataFrame:
    """Pieces of documents in windows: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids).

    ``ids`` (little-endian unsigned 32-bit) is given only ``with_ids``. Null texts are empty and have the end id alone;
    null and repeated ids are kept as they are, every row is a document of its own; a text of any length is cut into as
    many windows as it fills; an empty table gives no pieces. Nothing but the open windows is held, and only the pieces
    left open at a partition's end (at most ``open_windows`` windows of it) are shuffled. A worker keeps the ids of at most
    ``stretches`` stretches of text.
    """
    spark = ready(docs.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()  # what an earlier stage has left in this worker
        encode, part = library_encoder(tokenizer, stretches), task_number()
        packer, count = Packer(window, open_windows, shortest), 0
        for rows in slices(batches, 1, slice_bytes):
            ids, offsets = encode(text_array(rows.column(1)), end_id)
            closed = []
            for doc, a, b in zip(rows.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                closed += packer.place(Piece(doc, 0, ids[a:b], b - a))
            yield _rows([(part << 32 | count + i, w) for i, w in enumerate(closed)], part, False, with_ids)
            count += len(closed)
            for pieces in packer.held.values():  # let go of the slice's ids
                for p in pieces:
                    p.ids = p.ids.copy()
        yield _rows([(part << 32 | count + i, w) for i, w in enumerate(packer.left())], part, True, with_ids)
        release()

    placed = store(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
                   .mapInArrow(pack, _KIND), "packed")

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        packer, closed = Packer(window, open_windows, shortest), []
        pieces = [Piece(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"])
                  for r in table.to_pylist()]
        for piece in sorted(pieces, key=lambda p: (-len(p.ids), p.doc is None, p.doc or 0, p.start)):
            closed += packer.place(piece)
        closed += pour(packer.left(), window)
        made = [(_MERGED | group << 32 | i, w) for i, w in enumerate(closed)]
        return pa.Table.from_batches([_rows(made, group, False, with_ids)])

    merged = (placed.filter("open").withColumn("group", F.expr("part div 16"))
              .groupBy("group").applyInArrow(merge, _KIND))
    return (placed.filter("not open").union(merged)
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"))
