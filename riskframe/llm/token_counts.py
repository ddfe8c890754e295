"""Token counts without ids: pieces are counted once per distinct pre-token of the corpus.

A pre-token is what stands between spaces and line feeds; the vocabulary's own rules never let a token reach across
them. A chunk of documents keeps, per document, how often it has which pre-token; the counts of pieces are joined to
that and summed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from riskframe.llm.chunks import by_distinct_term, chunked, finish, frequency_codes, from_bytes, joined, planes, term_rows, to_bytes
from riskframe.llm.tokens import load_tokenizer, text_array


def _frequencies(rows: pa.Table) -> tuple[pa.Table, pa.Array]:
    """Per document the distinct pre-tokens and how often it has each."""
    texts = text_array(rows["text"].combine_chunks())
    lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    codes, terms = frequency_codes(lists.flatten())
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    pairs, counts = np.unique(doc * max(1, len(terms)) + codes, return_counts=True)
    doc, codes = pairs // max(1, len(terms)), pairs % max(1, len(terms))
    first = np.ones(len(doc), bool)
    first[1:] = doc[1:] != doc[:-1]
    steps = np.where(first, codes, np.diff(codes, prepend=0))  # codes ascend in a document
    inner = pa.table({**planes(steps), "count": pa.array(counts.astype(np.uint32))})
    distinct = np.bincount(doc, minlength=len(texts)).astype(np.int32)
    # The columns differ in length, so the inner table is a value of the first row.
    return pa.table({
        "doc_id": rows["doc_id"], "n_bytes": pc.binary_length(texts).cast(pa.int64()), "distinct": pa.array(distinct),
        "inner": pa.array([to_bytes(inner)] + [None] * (len(texts) - 1), pa.binary())}), terms


def count_tokens(docs: DataFrame, tokenizer: str, limit: int, id_col: str = "doc_id", text_col: str = "text",
                 chunk_bytes: int = 16_000_000) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row, as the ``tokenizers`` library counts the whole text.

    No begin, end or other added tokens; special strings inside a text count as the library's default has it. A null or
    empty text has 0 bytes and 0 tokens. Null and repeated ids are kept, every row is counted by itself; a text of any
    length is in one chunk; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    chunks = chunked(rows, 1, _frequencies, "token_counts", chunk_bytes)

    def pieces(terms: list[str]) -> list[int]:
        encode = load_tokenizer(tokenizer)
        return [len(e) for e in encode.encode_batch_fast(terms, add_special_tokens=False)]

    def total(payload: pa.Table, terms: pa.Array, found: dict[str, pa.Array]) -> pa.Table:
        inner = from_bytes(payload["inner"][0].as_py())
        distinct = payload["distinct"].to_numpy()
        doc = np.repeat(np.arange(len(distinct)), distinct)
        steps = joined(inner)
        runs = np.cumsum(steps)
        first = np.cumsum(distinct) - distinct
        base = np.where(distinct > 0, (runs - steps)[np.minimum(first, max(0, len(runs) - 1))] if len(runs) else 0, 0)
        codes = runs - base[doc]
        each = found["values"].to_numpy(zero_copy_only=False)[codes] * inner["count"].to_numpy()
        tokens = np.bincount(doc, weights=each, minlength=len(distinct)).astype(np.int64)
        return pa.table({"doc_id": payload["doc_id"], "n_bytes": payload["n_bytes"], "n_tokens": pa.array(tokens),
                         "over_limit": pa.array(tokens > limit)})

    found = by_distinct_term(term_rows(chunks), pieces, pa.int32(), "int")
    return finish(chunks, found, total, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
