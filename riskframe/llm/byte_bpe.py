"""Byte-level BPE encoding and decoding by merge replay.

A task takes its share of the corpus in large slices. The texts of a slice are cut into stretches (see ``tokens``), the
distinct ones are split into the vocabulary's words, and all distinct words are merged together by replaying the merges
in rank order (see ``merges``); the ids of the slice's documents are then laid out from the words'. Nothing is shuffled
or kept: a dictionary of the whole corpus' words, joined back to the documents, moved more bytes than the texts have.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from riskframe.llm.merges import MergeTable, load_ranks, replay
from riskframe.llm.tokens import kept, lay_out, slices, stretches, text_array
from riskframe.llm.workers import batch, ready

_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                     ("decoded_sha256", pa.string())])


def _ranks(path: str) -> MergeTable:
    return kept(("ranks", path), lambda: load_ranks(path))


def encode_stretches(terms: list[str], table: MergeTable, pattern: str) -> list[bytes]:
    """The ids of every string as little-endian unsigned 32-bit bytes, each match of the pattern by itself."""
    import regex
    cut = kept(("pattern", pattern), lambda: regex.compile(pattern)).findall
    matches = [cut(term) for term in terms]
    words = list(dict.fromkeys(chain.from_iterable(matches)))
    ids = dict(zip(words, replay([w.encode() for w in words], table)))
    return [ids[found[0]] if len(found) == 1 else b"".join(map(ids.__getitem__, found)) for found in matches]


def encode_texts(texts: pa.Array, table: MergeTable, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in order, where each text's begin)."""
    collecting = gc.isenabled()
    gc.disable()  # many short lists, no cycles
    try:
        return _encode_texts(texts, table, pattern)
    finally:
        if collecting:
            gc.enable()


def _encode_texts(texts: pa.Array, table: MergeTable, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    parts, offsets = stretches(texts)
    coded = parts.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64) * 2
    codes[offsets[:-1]] += 1  # no space stands before a text's first stretch
    used, codes = np.unique(codes, return_inverse=True)
    plain = coded.dictionary.take(pa.array(used // 2)).to_pylist()
    terms = [w if own else " " + w for w, own in zip(plain, (used % 2).tolist())]
    return lay_out(encode_stretches(terms, table, pattern), codes, offsets)


def decode_ids(ids: np.ndarray, table: MergeTable) -> bytes:
    """The bytes behind the ids; an unknown id is an error."""
    return b"".join(map(table.bytes_of.__getitem__, ids.tolist()))


def encode_corpus(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  slice_bytes: int = 4_000_000) -> DataFrame:
    """(doc_id, ids) of every row; ``ids`` are little-endian unsigned 32-bit integers, without special tokens.

    A null or empty text has no ids. Null and repeated ids are kept, every row is encoded by itself; a text of any
    length is in one slice; an empty table gives no rows.
    """
    ready(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 1, slice_bytes):
            ids, ends = encode_texts(text_array(rows.column(1)), _ranks(ranks), pattern)
            yield batch(_ENCODED, rows.column(0),
                        [ids[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(encode, "doc_id long, ids binary"))


def decode_corpus(encoded: DataFrame, ranks: str, ids_col: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the bytes behind the ids; null ids decode to null."""
    ready(encoded.sparkSession)
    at = encoded.columns.index(ids_col)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            made = [None if one is None else decode_ids(np.frombuffer(one, "<u4"), _ranks(ranks))
                    for one in rows.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(made, pa.binary())],
                                             names=[*rows.schema.names, "decoded"])

    return encoded.mapInArrow(decode, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())]))


def digest(encoded: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): of the decimal ids joined by commas and of the decoded bytes."""
    ready(encoded.sparkSession)

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            made = []
            for one in rows.column(1):
                ids = np.frombuffer(one.as_py(), "<u4")
                made.append((len(ids), hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest(),
                             hashlib.sha256(decode_ids(ids, _ranks(ranks))).hexdigest()))
            yield batch(_DIGEST, rows.column(0), *(zip(*made) if made else [[]] * 3))

    return (encoded.select("doc_id", "ids")
            .mapInArrow(shorten, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
