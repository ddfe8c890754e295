"""Fill-in-middle transformation with ``pyarrow.compute`` pipelines.

A batch of texts is split into list arrays of units (code points), the lists are flattened with the index of their text,
a unit's ordinal in its text gives its role, units are filtered by role, rebuilt into lists and joined to pieces; the
pieces are joined with the marks. Cuts and forms come from hashes of the ids, computed by Spark's own functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from riskframe.llm.tokens import slices, text_array
from riskframe.llm.workers import ready

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_OUT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                  ("middle_chars", pa.int64()), ("output", pa.string())])
_PATTERNS = {"psm": "(?s)^<P>(?P<a>.*?)<S>(?P<c>.*?)<M>(?P<b>.*)$", "spm": "(?s)^<S>(?P<c>.*?)<P>(?P<a>.*?)<M>(?P<b>.*)$"}


def code_points(texts: pa.Array) -> pa.ListArray:
    """Every text as the list of its code points. No text may be null.

    The units are views of the texts' own bytes: a code point starts at every byte that doesn't continue one.
    """
    texts = pa.concat_arrays([texts])  # offsets from 0
    count = len(texts)
    if not count:
        return pa.array([], pa.list_(pa.string()))
    ends = np.frombuffer(texts.buffers()[1], np.int32, count + 1, texts.offset * 4)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[:ends[-1]] if data is not None else np.empty(0, np.uint8)
    starts = np.flatnonzero((raw[ends[0]:] & 0xC0) != 0x80).astype(np.int32) + ends[0]
    units = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, ends[-1]).astype(np.int32)), data)
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(starts, ends).astype(np.int32)), units)


def cut_pieces(lists: pa.ListArray, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of every list, joined; ``low`` and ``high`` count the units before the two cuts."""
    units, parents = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    lengths = pc.list_value_length(lists).to_numpy()
    ordinals = np.arange(len(units)) - (np.cumsum(lengths) - lengths)[parents]
    role = (ordinals >= low[parents]).astype(np.int8) + (ordinals >= high[parents])
    pieces = []
    for one, size in enumerate((low, high - low, lengths - high)):
        chosen = units.filter(pa.array(role == one))
        offsets = np.zeros(len(lists) + 1, np.int32)
        np.cumsum(size, out=offsets[1:])
        pieces.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), chosen), ""))
    return pieces


def _transform(rows: pa.RecordBatch) -> pa.RecordBatch:
    texts = text_array(rows.column(1))
    h1, h2, h3, h4 = (rows.column(i).to_numpy() for i in range(2, 6))
    lists = code_points(texts)
    n = pc.list_value_length(lists).to_numpy().astype(np.int64)
    plain = (n == 0) | (h3 % 100 >= 90)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
    low, high = np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))
    form = np.where(plain, "plain", np.where(h4 % 100 < 20, "spm", "psm"))
    prefix, middle, suffix = cut_pieces(lists, low, high)
    psm = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
    spm = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
    output = pc.if_else(pa.array(plain), texts, pc.if_else(pa.array(form == "spm"), spm, psm))
    return pa.RecordBatch.from_arrays(
        [rows.column(0), pa.array(n), pa.array(form.tolist(), pa.string()), pa.array(low, mask=plain),
         pa.array(high - low, mask=plain), output], schema=_OUT)


def restore_texts(output: pa.Array, form: pa.Array) -> pa.Array:
    """The texts behind outputs and their forms."""
    made = output
    for name, pattern in _PATTERNS.items():
        chosen = pc.equal(form, name)
        found = pc.extract_regex(output.filter(chosen), pattern)
        parts = [pc.struct_field(found, part) for part in "abc"]
        made = pc.replace_with_mask(made, chosen, pc.binary_join_element_wise(*parts, ""))
    return made


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salt: str = "1:",
                   slice_bytes: int = 2_000_000) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row.

    The cuts and the form follow from the sha256 of ``salt`` and the id in decimal digits (an id that is null counts as
    no digits), so rows that share an id and a length are cut alike. A null text is empty; empty texts and texts that
    hold a mark stay plain, with null lengths. Texts of any length are cut whole; an empty table gives no rows.
    """
    ready(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)

    def number(group: int) -> Column:
        return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long").alias(f"h{group + 1}")

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1, slice_bytes):
            yield _transform(part)

    return rows.select("doc_id", "text", *map(number, range(4))).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(made: DataFrame) -> DataFrame:
    """Rows of ``fill_in_middle`` with ``restored``, the exact text rebuilt from output and form; other columns go."""
    ready(made.sparkSession)
    schema = pa.schema([*_OUT, ("restored", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            back = restore_texts(rows.column(5).cast(pa.string()), rows.column(2).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(rows.columns, _OUT)), back], schema=schema)

    return made.select(*_OUT.names).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, restored string")
