"""Alignment of two tokenizers, with corpus-wide counts of the token pairs they link.

A text is encoded by both; where tokens of both end, it is cut into groups, and all tokens of a group are linked. First
pass: documents are gathered into chunks, and a chunk gives its distinct pairs and how many of its documents hold each.
The corpus' distinct pairs are dealt into shards, each with a minimal perfect hash; every few chunks add their counts to
a dense vector indexed by it, and the vectors are summed as a tree. Second pass: the chunks' pairs are looked up (the
hash verifies its keys), the documents are aligned again and their links' counts added up.

Both tokenizers start anew before a single space between two other characters, so a text is aligned stretch by stretch
(see ``tokens``) and a chunk aligns each of its distinct stretches once.
"""

from __future__ import annotations

import gc
import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from riskframe.llm.chunks import from_bytes, to_bytes
from riskframe.llm.perfect_hash import PerfectHash, mix
from riskframe.llm.tokens import forget, kept, slices, stretches, text_array
from riskframe.llm.workers import ready, release, short_batches, task_number
from riskframe.plans.storage import store

_CHUNK = pa.schema([("chunk", pa.int64()), ("payload", pa.binary()), ("pairs", pa.list_(pa.int64())),
                    ("counts", pa.list_(pa.int64()))])
_PART = pa.schema([("shard", pa.int64()), ("part", pa.int64()), ("chunk", pa.int64()), ("pairs", pa.list_(pa.int64())),
                   ("counts", pa.list_(pa.int64()))])
_FOUND = pa.schema([("chunk", pa.int64()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
_DOC = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
                  ("groups_sha256", pa.string())])
_BIG_GROUP = 100_000
_BLOCK = 1_000_000
_PARTS = 20_000
_TOGETHER = 64


class Tokenizers:
    """Both vocabularies: ids of stretches and the bytes of every id."""

    def __init__(self, byte_level: str, pieces: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the others are shown from 256 on
        shown = {chr(c): c for c in visible}
        shown.update((chr(256 + i), c) for i, c in enumerate(c for c in range(256) if c not in set(visible)))
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.a_bytes[number] = bytes(shown[c] for c in token) if all(c in shown for c in token) else token.encode()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(self.b.id_to_piece(list(range(self.b.get_piece_size()))))]
        self.a_sizes, self.b_sizes = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))

    @property
    def width(self) -> int:
        return len(self.b_bytes)

    def ids(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of every part behind a space, by both."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + p for p in parts], add_special_tokens=False)]
        return a, self.b.encode(parts, num_threads=1)

    def spell(self, a: list[int], b: list[int], wanted: bytes) -> bool:
        """Whether both lists of ids spell these bytes."""
        return (b"".join(map(self.a_bytes.__getitem__, a)) == wanted
                and b"".join(map(self.b_bytes.__getitem__, b)) == wanted)

    def encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(whether both spell the part, ids by the first, how many of them, ids by the second, how many of them).

        Parts that neither start nor end with white space are encoded many in a text, since a new match starts at each;
        how many ids are a part's own follows from their bytes. The others are encoded one by one.
        """
        whole = np.ones(len(parts), bool)
        sizes = np.fromiter((len(p.encode()) + 1 for p in parts), np.int64, len(parts))
        held: list[tuple[int, int, list[int], list[int]]] = []  # first part, parts, ids by both
        run: list[int] = []
        alone: list[int] = []
        for start in range(0, len(parts), _TOGETHER):
            some = parts[start:start + _TOGETHER]
            if all(p and p.strip() == p for p in some):
                run.append(start)
            else:
                alone += range(start, start + len(some))
        texts = [" ".join(parts[at:at + _TOGETHER]) for at in run]
        for at, text, a, b in zip(run, texts, *self.ids(texts)):
            if self.spell(a, b, (" " + text).encode()):
                held.append((at, min(_TOGETHER, len(parts) - at), a, b))
            else:
                alone += range(at, min(at + _TOGETHER, len(parts)))
        alone.sort()
        texts = [parts[at] for at in alone]
        for at, text, a, b in zip(alone, texts, *self.ids(texts)):
            whole[at] = bool(text) and self.spell(a, b, (" " + text).encode())
            held.append((at, 1, a, b) if whole[at] else (at, 1, [], []))
        held.sort(key=lambda h: h[0])
        ends = np.cumsum(sizes * whole)
        found: list[np.ndarray] = []
        for side, spelled in ((2, self.a_sizes), (3, self.b_sizes)):
            ids = np.fromiter((i for h in held for i in h[side]), np.int64, sum(len(h[side]) for h in held))
            until = np.searchsorted(np.cumsum(spelled[ids]), ends, "right")
            found += [ids, np.diff(until, prepend=0)]
        return whole, *found


def tokenizers(byte_level: str, pieces: str) -> Tokenizers:
    return kept(("aligned", byte_level, pieces), lambda: Tokenizers(byte_level, pieces))


@dataclass
class Aligned:
    """Alignment of distinct parts: sizes, the groups in writing, and the linked pairs of part i at
    ``pairs[starts[i]:starts[i + 1]]`` with how often each is linked. ``whole`` is false where bytes don't match."""

    whole: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    written: pa.Array
    starts: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


_STRINGS = pa.array([], pa.string())


def _joined(texts: pa.Array, sizes: np.ndarray, mark: str) -> pa.Array:
    """The texts, so many at a time, joined by the mark."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), texts), mark)


def align_parts(parts: list[str], both: Tokenizers, write: bool = True) -> Aligned:
    """Align every part (with a space before it) by itself, so many at a time; ``written`` is empty unless ``write``."""
    made = [_align_some(parts[i:i + _PARTS], both, write) for i in range(0, len(parts), _PARTS)] or [_align_some([], both, write)]
    if len(made) == 1:
        return made[0]
    before = np.cumsum([0, *(len(m.pairs) for m in made)])
    starts = np.concatenate([[0], *(m.starts[1:] + b for m, b in zip(made, before))])
    arrays = {n: np.concatenate([getattr(m, n) for m in made])
              for n in ("whole", "n_a", "n_b", "n_groups", "n_links", "pairs", "times")}
    return Aligned(written=pa.concat_arrays([m.written for m in made]), starts=starts, **arrays)


def _align_some(parts: list[str], both: Tokenizers, write: bool) -> Aligned:
    whole, a, n_a, b, n_b = both.encode(parts)
    ends_a, ends_b = np.cumsum(both.a_sizes[a]), np.cumsum(both.b_sizes[b])
    common = ends_a[ends_b[np.searchsorted(ends_b, ends_a)] == ends_a] if len(ends_a) else ends_a
    group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
    groups = len(common)
    in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    part_of = np.repeat(np.arange(len(parts)), n_a)[first_a] if groups else np.empty(0, np.int64)
    links = in_a * in_b

    def counts(weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(part_of, weights, minlength=len(parts)).astype(np.int64)

    n_groups, written = counts(), _STRINGS
    if write:
        each = pc.binary_join_element_wise(_joined(pa.array(a).cast(pa.string()), in_a, ","),
                                           _joined(pa.array(b).cast(pa.string()), in_b, ","), "|")
        written = _joined(each, n_groups, ";")
    keys, times = [np.empty(0, np.int64)], [np.empty(0, np.int64)]  # part and pair in one number
    usual = np.flatnonzero(links <= _BIG_GROUP)
    reach = np.cumsum(links[usual])
    for block in np.split(usual, np.searchsorted(reach, np.arange(_BLOCK, int(reach[-1]) if len(reach) else 0, _BLOCK))):
        of = np.repeat(block, links[block])
        k = np.arange(len(of)) - np.repeat(np.cumsum(links[block]) - links[block], links[block])
        made = a[first_a[of] + k // in_b[of]] * both.width + b[first_b[of] + k % in_b[of]]
        key, time = np.unique((part_of[of] << 31) | made, return_counts=True)
        keys.append(key)
        times.append(time)
    for g in np.flatnonzero(links > _BIG_GROUP).tolist():
        ua, ca = np.unique(a[first_a[g]:first_a[g] + in_a[g]], return_counts=True)
        ub, cb = np.unique(b[first_b[g]:first_b[g] + in_b[g]], return_counts=True)
        keys.append(((part_of[g] << 31) | (ua[:, None] * both.width + ub[None, :])).ravel())
        times.append((ca[:, None] * cb[None, :]).ravel())
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    time = np.zeros(len(key), np.int64)
    np.add.at(time, at, np.concatenate(times))
    starts = np.searchsorted(key >> 31, np.arange(len(parts) + 1))
    return Aligned(whole, n_a, n_b, n_groups, counts(links), written, starts, key & ((1 << 31) - 1), time)


class Chunk:
    """The aligned documents of a chunk: distinct parts, and for every document the numbers of its parts."""

    def __init__(self, texts: pa.Array, both: Tokenizers, write: bool = True):
        collecting = gc.isenabled()
        gc.disable()  # many short lists, no cycles
        try:
            flat, self.offsets = stretches(texts)
            coded = flat.dictionary_encode()
            self.codes = coded.indices.to_numpy().astype(np.int64)
            self.aligned = align_parts(coded.dictionary.to_pylist(), both, write)
        finally:
            if collecting:
                gc.enable()
        good = self.sums(self.aligned.whole) == np.diff(self.offsets)
        self.used = good & (pc.binary_length(texts).to_numpy() > 0)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The values of every document's parts, added up."""
        total = np.zeros(len(self.codes) + 1, np.int64)
        np.cumsum(values[self.codes], out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def pair_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """(distinct pairs, how many documents hold each linked)."""
        docs = len(self.offsets) - 1
        pairs, place = np.unique(self.aligned.pairs, return_inverse=True)
        counts = np.zeros(len(pairs), np.int64)
        sizes = np.diff(self.aligned.starts)[self.codes]
        ends = np.concatenate([[0], np.cumsum(sizes)])[self.offsets]  # entries up to every document
        wide = max(1, len(pairs))
        start = 0
        while start < docs:  # whole documents: up to _BLOCK entries, and a table of marks of bounded size
            stop = int(np.searchsorted(ends, ends[start] + _BLOCK, "right")) - 1
            stop = min(max(stop, start + 1), start + max(1, 32 * _BLOCK // wide), docs)
            tokens = slice(self.offsets[start], self.offsets[stop])
            size, codes = sizes[tokens], self.codes[tokens]
            doc = np.repeat(np.arange(stop - start), np.diff(self.offsets[start:stop + 1]))
            at = np.repeat(self.aligned.starts[codes] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            key = np.repeat(doc * wide, size) + place[at]
            if (stop - start) * wide <= 64 * len(key):
                marks = np.zeros((stop - start) * wide, bool)
                marks[key] = True
                marks = marks.reshape(stop - start, wide) & self.used[start:stop, None]
                counts += marks.sum(axis=0)[:len(counts)]
            else:
                key = np.unique(key)
                key = key[self.used[start + key // wide]]
                counts += np.bincount(key % wide, minlength=len(counts))[:len(counts)]
            start = stop
        held = counts > 0
        return pairs[held], counts[held]

    def rows(self, doc_ids: pa.Array, pairs: np.ndarray, counts: np.ndarray, best_of_a: np.ndarray, width: int) -> pa.Table:
        """The documents' rows; ``pairs`` ascend and hold every pair of the chunk."""
        a = self.aligned
        at = np.minimum(np.searchsorted(pairs, a.pairs), max(0, len(pairs) - 1))
        known = counts[at] if len(pairs) else np.zeros(len(a.pairs), np.int64)
        known = np.where(pairs[at] == a.pairs, known, 0) if len(pairs) else known
        best = known == best_of_a[a.pairs // width] if len(a.pairs) else np.empty(0, bool)

        def by_part(values: np.ndarray) -> np.ndarray:
            total = np.zeros(len(values) + 1, np.int64)
            np.cumsum(values, out=total[1:])
            return total[a.starts[1:]] - total[a.starts[:-1]]

        columns = [a.n_a, a.n_b, a.n_groups, a.n_links, by_part(a.times * best), by_part(a.times * known)]
        lists = pa.ListArray.from_arrays(pa.array(self.offsets.astype(np.int32)), a.written.take(pa.array(self.codes)))
        digests = [hashlib.sha256(text.as_buffer()).hexdigest() if used else ""
                   for text, used in zip(pc.binary_join(lists, ";"), self.used.tolist())]
        return pa.Table.from_arrays([doc_ids, *(pa.array(self.sums(c) * self.used) for c in columns), pa.array(digests, pa.string())],
                                    schema=_DOC)


def _lists(schema: pa.Schema, plain: list, lists: list[list[np.ndarray]]) -> pa.RecordBatch:
    made = []
    for arrays in lists:
        offsets = np.zeros(len(arrays) + 1, np.int32)
        np.cumsum([len(x) for x in arrays], out=offsets[1:])
        flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
        made.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64())))
    return pa.RecordBatch.from_arrays([*(pa.array(p, f.type) for p, f in zip(plain, schema)), *made], schema=schema)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy()


def _shard_rows(shards: int, fan: int):
    """A chunk's pairs, dealt to their shards."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for chunk, pairs, counts in zip(rows.column(0).to_pylist(), rows.column(1), rows.column(2)):
                keys, times = pairs.values.to_numpy(), counts.values.to_numpy()
                shard = (mix(keys, 99) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
                part = int(mix(np.array([chunk]), 7)[0] % np.uint64(fan))
                yield _lists(_PART, [shard[order][cuts], [part] * len(cuts), [chunk] * len(cuts)],
                             [np.split(keys[order], cuts[1:]) if len(cuts) else [],
                              np.split(times[order], cuts[1:]) if len(cuts) else []])
    return deal


def _only(table: pa.Table, column: str) -> bytes:
    return table[column][0].as_py()


def align_tokenizers(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text",
                     chunk_bytes: int = 8_000_000, shard_pairs: int = 400_000, fan_in: int = 16) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    ``byte_level`` is a byte-level file of ``tokenizers`` that encodes a space and the text, ``pieces`` a model of
    ``sentencepiece`` that encodes the text and adds the space; special strings are plain text. A link is a pair of
    occurrences in a group, the count of its ids is in how many rows of the corpus they are linked, and it is one of
    the best if no other pair of its first id has a higher count. Null and empty texts, and those whose tokens don't
    spell them (a text with U+2581), have no tokens: zeros and an empty digest, and they count for nothing. Rows are
    counted one by one, whatever their ids; texts of any length are aligned whole; an empty table gives no rows.

    A shard holds about ``shard_pairs`` pairs. The best counts of the first vocabulary's ids (one number for each, no
    more than there are ids) are all that reaches the driver.
    """
    spark = ready(docs.sparkSession)
    width = tokenizers(byte_level, pieces).width

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, weight = task_number() << 24, [], 0
        forget()

        def close() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            texts = text_array(table["text"].combine_chunks())
            pairs, counts = Chunk(texts, tokenizers(byte_level, pieces), write=False).pair_counts()
            return _lists(_CHUNK, [[number], [to_bytes(table)]], [[pairs], [counts]])
        for rows in slices(batches, 1, max(1, chunk_bytes // 4)):
            held.append(rows)
            weight += pc.sum(pc.binary_length(rows.column(1))).as_py() or 0
            if weight >= chunk_bytes:
                yield close()
                number, held, weight = number + 1, [], 0
                release()
        if held:
            yield close()
        held = []
        release()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    with short_batches(spark):
        chunks = store(rows.mapInArrow(gather, "chunk long, payload binary, pairs array<long>, counts array<long>"), "aligned")
    size = chunks.agg(F.count("*").alias("chunks"), F.sum(F.size("pairs")).alias("pairs")).first()
    shards = max(1, -(-(size["pairs"] or 0) // shard_pairs))
    fan = max(1, -(-size["chunks"] // fan_in))

    distinct = chunks.select(F.explode("pairs").alias("pair")).distinct()

    def number_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            shard = (mix(one.column(0).to_numpy(), 99) % np.uint64(shards)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([one.column(0), pa.array(shard)], names=["pair", "shard"])

    def build(table: pa.Table) -> pa.Table:
        made = PerfectHash(table["pair"].to_numpy())
        return pa.table({"shard": table["shard"].slice(0, 1), "hash": pa.array([pickle.dumps(made)], pa.binary())})

    hashes = store(distinct.mapInArrow(number_pairs, "pair long, shard long").groupBy("shard")
                   .applyInArrow(build, "shard long, hash binary"), "hashes")
    dealt = chunks.select("chunk", "pairs", "counts").mapInArrow(
        _shard_rows(shards, fan), "shard long, part long, chunk long, pairs array<long>, counts array<long>")
    spread = hashes.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(fan - 1).cast("long"))))

    def dense(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:  # a part without pairs of this shard
            return pa.table({"shard": pa.array([], pa.int64()), "part": pa.array([], pa.int64()), "vector": pa.array([], pa.binary())})
        index = pickle.loads(_only(right, "hash"))
        at = index(_numbers(left["pairs"]))
        if (at < 0).any():
            raise RuntimeError("a pair is missing from its hash")
        vector = np.zeros(index.n, "<i8")
        np.add.at(vector, at, _numbers(left["counts"]))
        return pa.table({"shard": left["shard"].slice(0, 1), "part": left["part"].slice(0, 1),
                         "vector": pa.array([vector.tobytes()], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = np.frombuffer(table["vector"][0].as_py(), "<i8").copy()
        for more in table["vector"].slice(1):
            total += np.frombuffer(more.as_py(), "<i8")
        return pa.table({"shard": table["shard"].slice(0, 1), "part": table["part"].slice(0, 1),
                         "vector": pa.array([total.tobytes()], pa.binary())})

    kind = "shard long, part long, vector binary"
    vectors = dealt.groupBy("shard", "part").cogroup(spread.groupBy("shard", "part")).applyInArrow(dense, kind)
    left = fan
    while left > 1:
        left = -(-left // fan_in)
        vectors = (vectors.withColumn("part", F.floor(F.col("part") / fan_in).cast("long"))
                   .groupBy("shard", "part").applyInArrow(add, kind))
    model = store(hashes.join(vectors.drop("part"), "shard"), "pair-counts")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for index, vector in zip(rows.column(0), rows.column(1)):
                first = pickle.loads(index.as_py()).keys // width
                counts = np.frombuffer(vector.as_py(), "<i8")
                ids, at = np.unique(first, return_inverse=True)
                top = np.zeros(len(ids), np.int64)
                np.maximum.at(top, at, counts)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(top)], names=["a", "top"])

    tops = model.select("hash", "vector").mapInArrow(best, "a long, top long").groupBy("a").agg(F.max("top").alias("top"))
    best_of_a = np.zeros(len(tokenizers(byte_level, pieces).a_bytes), np.int64)
    for a, top in tops.collect():
        best_of_a[a] = top

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _FOUND.empty_table()
        index, vector = pickle.loads(_only(right, "hash")), np.frombuffer(_only(right, "vector"), "<i8")
        at = index(_numbers(left["pairs"]))
        if (at < 0).any():
            raise RuntimeError("a pair is missing from its hash")
        lists = left["pairs"].combine_chunks()
        found = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]).astype(np.int32)),
                                         pa.array(vector[at]))
        return pa.Table.from_arrays([left["chunk"], left["pairs"], found], schema=_FOUND)

    held = model.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(fan - 1).cast("long"))))
    found = dealt.groupBy("shard", "part").cogroup(held.groupBy("shard", "part")).applyInArrow(
        look_up, "chunk long, pairs array<long>, counts array<long>")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        table = from_bytes(_only(left, "payload"))
        pairs, counts = _numbers(right["pairs"]), _numbers(right["counts"])
        order = np.argsort(pairs)
        chunk = Chunk(text_array(table["text"].combine_chunks()), tokenizers(byte_level, pieces))
        made = chunk.rows(table["doc_id"].combine_chunks(), pairs[order], counts[order], best_of_a, width)
        release()
        return made

    return (chunks.select("chunk", "payload").groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(
        finish, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))
