"""Encoding whole texts with a public tokenizer, one library call per distinct stretch of text.

A text is cut before every single space that stands between two non-space characters. The split rules of the
byte-level vocabularies always start a new match there, so encoding the stretches one by one gives the ids of the
whole text. Prose repeats its stretches; a worker encodes each once, keeps the result, and lays the ids of a slice of
documents out with array operations.
"""

from __future__ import annotations

import array
import gc
import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_KEPT: dict[tuple, object] = {}
#: White space of any script, as Python's ``str.isspace`` has it.
_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0  -     　"
_ODD = f"^[{_SPACE}]|[{_SPACE}]$|[{_SPACE}] | [{_SPACE}]"
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Letters or digits, and what follows from the first other sign on: there a new match starts as well.
_HEAD = re.compile(r"([^\W_]++)([^\w\s].*)", re.S)


def kept(key: tuple, make: Callable[[], object]) -> object:
    """One object per worker process and key (a loaded vocabulary, a cache)."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """Empty the stretch caches: a worker may go on with another operator's task."""
    for one in _KEPT.values():
        if isinstance(one, StretchEncoder):
            one.heads, one.tails = {}, {}


def load_tokenizer(path: str):
    """The tokenizer of a ``tokenizers`` file, once per worker."""
    def make():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        from tokenizers import Tokenizer
        return Tokenizer.from_file(path)
    return kept(("tokenizers", path), make)


def text_array(column: pa.Array) -> pa.Array:
    """The column as strings without nulls."""
    return pc.fill_null(column.cast(pa.string()), "")


def slices(batches: Iterable[pa.RecordBatch], text: int, size: int = 16_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches where about ``size`` bytes of column ``text`` have come together."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.flatnonzero(np.diff(np.cumsum(lengths, dtype=np.int64) // size, append=-1)) + 1
        start = 0
        for end in ends:
            yield batch.slice(start, end - start)
            start = int(end)


def stretches(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All stretches in order, and where each text's begin. A space was before every stretch but a text's first."""
    odd = np.flatnonzero(pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False))
    lists = pc.split_pattern(texts, " ")
    if not len(odd):
        offsets = lists.offsets.to_numpy().astype(np.int64)
        return lists.flatten(), offsets - offsets[0]
    pieces, counts, start = [], [], 0
    for row in [*odd.tolist(), len(texts)]:
        plain = lists.slice(start, row - start)
        pieces.append(plain.flatten())
        counts.append(pc.list_value_length(plain).to_numpy(zero_copy_only=False))
        if row < len(texts):
            cut = _CUT.split(texts[row].as_py())
            pieces.append(pa.array(cut, pa.string()))
            counts.append(np.array([len(cut)]))
        start = row + 1
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.concatenate(counts), out=offsets[1:])
    return pa.concat_arrays(pieces), offsets


class StretchEncoder:
    """ids of texts.

    ``encode_many(strings)`` gives the ids of each string; it is called for what is not kept. A stretch is a head of
    letters and digits and a tail from the first other sign on, each kept by itself unless ``with_tails`` is false. At
    most ``most`` heads are kept in a worker; beyond, the cache starts anew, which costs time and nothing else.
    """

    def __init__(self, encode_many: Callable[[list[str]], Iterable[list[int]]], most: int = 800_000,
                 with_tails: bool = True):
        self.encode_many, self.most, self.with_tails = encode_many, most, with_tails
        self.heads: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def _bytes(self, many: list[str]) -> list[bytes]:
        return [array.array("I", ids).tobytes() for ids in self.encode_many(many)]

    def _known(self, cache: dict[str, bytes], wanted: list[str], prefix: str) -> dict[str, bytes]:
        unknown = [one for one in dict.fromkeys(wanted) if one not in cache]
        if len(cache) + len(unknown) > self.most:
            cache.clear()
            unknown = list(dict.fromkeys(wanted))
        cache.update(zip(unknown, self._bytes([prefix + one for one in unknown])))
        return cache

    def _after_space(self, many: list[str]) -> list[bytes]:
        if not self.with_tails:
            return list(map(self._known(self.heads, many, " ").__getitem__, many))
        split = _HEAD.fullmatch
        cut = [None if one.isalpha() else split(one) for one in many]
        heads = self._known(self.heads, [m[1] if m else one for m, one in zip(cut, many)], " ")
        tails = self._known(self.tails, [m[2] for m in cut if m], "")
        return [heads[m[1]] + tails[m[2]] if m else heads[one] for m, one in zip(cut, many)]

    def __call__(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, where each text's begin); ``end`` is put after every text."""
        collecting = gc.isenabled()
        gc.disable()  # millions of short lists would start the collector again and again
        try:
            return self._encode(texts, end)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        parts, offsets = stretches(texts)
        coded = parts.dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        words = self._after_space(coded.dictionary.to_pylist())
        first = offsets[:-1]
        firsts = parts.take(pa.array(first)).dictionary_encode()
        codes[first] = len(words) + firsts.indices.to_numpy()
        words += self._bytes(firsts.dictionary.to_pylist())
        if end is not None:
            codes = np.insert(codes, offsets[1:], len(words))
            offsets = offsets + np.arange(len(offsets))
            words.append(array.array("I", [end]).tobytes())
        return lay_out(words, codes, offsets)


def lay_out(words: list[bytes], codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Put the ids of ``words[codes]`` one after another; also where each text's begin."""
    flat = np.frombuffer(b"".join(words), dtype="<u4")
    sizes = np.fromiter(map(len, words), np.int64, len(words)) // 4
    starts = np.cumsum(sizes) - sizes
    lengths = sizes[codes]
    ends = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(lengths, out=ends[1:])
    at = np.repeat(starts[codes] - ends[:-1], lengths)
    at += np.arange(len(at))
    return flat[at], ends[offsets]


def library_encoder(path: str, most: int = 800_000) -> StretchEncoder:
    """The encoder of a ``tokenizers`` file, without begin, end or other added special tokens; ``most`` as in ``StretchEncoder``."""
    def make() -> StretchEncoder:
        tokenizer = load_tokenizer(path)
        # A special string must not be cut; one that starts with a letter could be.
        added = tokenizer.get_added_tokens_decoder().values()
        return StretchEncoder(lambda many: (e.ids for e in tokenizer.encode_batch_fast(many, add_special_tokens=False)), most,
                              with_tails=not any(t.content[:1].isalnum() for t in added))
    return kept(("stretches", path, most), make)
