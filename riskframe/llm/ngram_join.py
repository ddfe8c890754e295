"""Jaccard self-join of word-shingle sets by token-combination prefixes.

Shingles are ordered from rare to frequent by a sketch of their document counts (a fixed number of counters, summed
over all documents). Two similar sets share a shingle among the first few of each (the prefix). A rare one is indexed
alone. Where the prefix reaches into the frequent class, it is extended by one and pairs of frequent shingles are
indexed: two similar sets that share no rare shingle there share two frequent ones. Sets so long that the pairs would
outnumber ``most_pairs`` index frequent shingles alone; sizes within the ratio of the border do both, so no pair is lost.

Equal sets are folded first. Keys of few sets give their pairs, and a pair goes on only if it shares as many keys as
two similar sets of these sizes must. Keys of many sets give none: each set is verified against the smallest of them,
the key's head, and connected; what a head has met and is still apart is then compared in blocks of bounded size,
without the pairs that are connected already. A block counts common shingles through an inverted index and gives a
forest of the links it finds, so no pair of a large group is written or shuffled, and a group of near copies costs
little more than its members.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskframe.llm.components import connected_components, forest
from riskframe.llm.shingles import mix, shingle_sets
from riskframe.llm.tokens import forget, slices, text_array
from riskframe.llm.workers import batch, brief_shuffles, ready, release
from riskframe.plans.storage import drop, store

_SEGMENTS = 64
_SLICE = 3_000_000
_SEEN = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
                   ("segment", pa.int32()), ("counts", pa.binary())])
_KEYS = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int32()), ("frequent", pa.bool_()),
                   ("pure", pa.bool_())])
_SET = pa.schema([("doc_id", pa.int64()), ("shingles", pa.binary())])
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])
#: Sets and shingles in a block, and sets of a key that still gives its pairs.
_BLOCK, _BLOCK_SHINGLES, _FEW = 1_024, 2_000_000, 16
#: Rows of two numbers that may be broadcast, once they are counted.
_SMALL = 2_000_000
#: Rows of two numbers that one round of comparisons takes.
_ROUND = 1_000_000


def _blocks(sets: Column, shingles: Column) -> Column:
    """Into how many blocks so many sets with so many shingles are cut."""
    return F.greatest(F.ceil(sets / F.lit(float(_BLOCK))), F.ceil(shingles / F.lit(float(_BLOCK_SHINGLES)))).cast("int")


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[list[int | None], list[np.ndarray]]]:
    forget()
    for rows in slices(batches, 1, _SLICE):
        yield rows.column(0).to_pylist(), shingle_sets(text_array(rows.column(1)), words)
    release()


def _survey(docs: DataFrame, words: int, sketch_bits: int) -> DataFrame:
    """A row per document with its set's size and hash, and the tasks' sketches of document counts."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << sketch_bits, np.int64)
        for ids, sets in _slices(batches, words):
            flat = np.concatenate(sets)
            counters += np.bincount((flat >> np.uint64(64 - sketch_bits)).astype(np.int64), minlength=len(counters))
            h1 = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
            h2 = np.array([mix(s + np.uint64(77)).sum(dtype=np.uint64) for s in sets], np.uint64)
            none = [None] * len(ids)
            yield batch(_SEEN, ids, [len(s) for s in sets], _signed(h1), _signed(h2), none, none)
        parts = counters.reshape(min(_SEGMENTS, len(counters)), -1)
        used = np.flatnonzero(parts.any(axis=1))
        none = [None] * len(used)
        yield batch(_SEEN, none, none, none, none, used.astype(np.int32),
                    [zlib.compress(parts[s].astype("<i8").tobytes(), 1) for s in used])

    return store(docs.mapInArrow(look, "doc_id long, n long, h1 long, h2 long, segment int, counts binary"), "survey")


def _sketch(survey: DataFrame, sketch_bits: int) -> np.ndarray:
    """The sum of the tasks' sketches; its size is fixed by ``sketch_bits``, whatever the input."""
    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(c), "<i8") for c in table["counts"].to_pylist())
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()),
                         "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})
    width = (1 << sketch_bits) // min(_SEGMENTS, 1 << sketch_bits)
    counters = np.zeros(1 << sketch_bits, np.int64)
    summed = (survey.filter("segment is not null").select("segment", "counts").groupBy("segment")
              .applyInArrow(add, "segment int, counts binary"))
    for row in summed.collect():
        at = row["segment"] * width
        counters[at:at + width] = np.frombuffer(zlib.decompress(row["counts"]), "<i8")
    return np.minimum(counters, 2 ** 31 - 1).astype(np.int32)


def prefix_keys(shingles: np.ndarray, counts: np.ndarray, frequent_above: int, num: int, den: int,
                most_pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, is frequent) of one set; ``counts`` are the sketch's counts of its shingles.

    Without a frequent key the whole prefix is indexed by single shingles.
    """
    n = len(shingles)
    need = -(-num * n // den)  # a similar set shares at least so many
    prefix = n - need + 1
    order = np.lexsort((shingles, counts))[:prefix + 1]
    first, often = shingles[order], counts[order] > frequent_above
    rare, common = first[:prefix][~often[:prefix]], first[:prefix][often[:prefix]]
    keys, flags = [rare], [np.zeros(len(rare), bool)]
    if len(common):
        # Whether pairs are indexed depends on the size alone, so similar sets agree on it.
        # Above one half, only sets of one shingle are similar to sets of one shingle.
        combine = need >= 2 and 2 * num > den

        def pairs(size: int) -> int:
            extended = size - -(-num * size // den) + 2
            return extended * (extended - 1) // 2
        small = combine and pairs(n) <= most_pairs
        near_small = combine and pairs(need) <= most_pairs  # some similar set may be small
        if small or near_small:
            pool = np.sort(first[often])
            i, j = np.triu_indices(len(pool), 1)
            keys.append(mix(pool[i] * np.uint64(0xD6E8FEB86659FD93) + mix(pool[j])))
            flags.append(np.ones(len(i), bool))
        if not small:
            keys.append(common)
            flags.append(np.ones(len(common), bool))
    return np.concatenate(keys), np.concatenate(flags)


def _index(docs: DataFrame, sketch: np.ndarray, words: int, num: int, den: int, most_pairs: int) -> DataFrame:
    """(key, doc_id, size, pure) for keys that at least two documents have (frequent keys: all).

    ``pure``: the document has no frequent key, so it shares a key with a set for every shingle their prefixes share.
    """
    spark = docs.sparkSession
    bits = len(sketch).bit_length() - 1
    frequent_above = int(4 * sketch.mean()) + 64
    shared = spark.sparkContext.broadcast(sketch)  # fixed size

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = shared.value
        for ids, sets in _slices(batches, words):
            found = [(doc, len(s), *prefix_keys(s, counters[(s >> np.uint64(64 - bits)).astype(np.int64)], frequent_above,
                                                num, den, most_pairs))
                     for doc, s in zip(ids, sets) if len(s) and doc is not None]
            if found:
                sizes = [len(f[2]) for f in found]
                yield batch(_KEYS, _signed(np.concatenate([f[2] for f in found])),
                            np.repeat([f[0] for f in found], sizes), np.repeat([f[1] for f in found], sizes),
                            np.concatenate([f[3] for f in found]), np.repeat([not f[3].any() for f in found], sizes))

    def shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last row so far: it may be the first of a run
        joined = False                      # is it part of a run already
        for rows in batches:
            if not rows.num_rows:
                continue
            if held is not None:
                rows = pa.Table.from_batches([held, rows]).combine_chunks().to_batches()[0]
            key = rows.column(0).to_numpy()
            same = key[1:] == key[:-1]
            keep = rows.column(3).to_numpy(zero_copy_only=False).copy()
            keep[1:] |= same
            keep[:-1] |= same
            keep[0] |= joined and held is not None
            held, joined = rows.slice(rows.num_rows - 1), bool(len(same) and same[-1]) or (not len(same) and joined)
            yield rows.slice(0, rows.num_rows - 1).filter(pa.array(keep[:-1]))
        if held is not None and (joined or held.column(3)[0].as_py()):
            yield held

    kind = "key long, doc_id long, size int, frequent boolean, pure boolean"
    # Frequent keys are dealt over the cluster; they are told apart only after equal sets are folded.
    salt = F.when(F.col("frequent"), F.pmod("doc_id", F.lit(4_096))).otherwise(F.lit(0))
    return (docs.mapInArrow(keys, kind).repartition("key", salt).sortWithinPartitions("key")
            .mapInArrow(shared_keys, kind).select("key", "doc_id", "size", "pure"))


def _likely_pairs(led: DataFrame, num: int, den: int) -> DataFrame:
    """(head, rep, size of the rep's set) of pairs of the keys of few sets that share as many keys as two similar sets of their sizes must.

    Of ``o`` common shingles (in the order of the prefixes), the k-th lies in the prefix of a set of n if
    k <= o - ceil(num * n / den) + 1. Where one of the two is pure, every one in both prefixes is a shared key.
    """
    def up(a: str, b: int) -> str:
        return f"(({a} + {b} - 1) div {b})"
    lists = led.filter(F.col("n") <= _FEW).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("rep", "size", "pure"))).alias("l"))  # at most _FEW
    pairs = lists.select(F.explode(F.expr(
        "flatten(transform(l, (x, i) -> transform(slice(l, i + 2, size(l)), y -> struct(x, y))))")).alias("p"))
    counted = (pairs.filter(f"p.x.rep < p.y.rep and {_sized('p.x.size', 'p.y.size', num, den)}")
               .groupBy(F.col("p.x.rep").alias("head"), F.col("p.y.rep").alias("rep"), F.col("p.x.size").alias("nx"),
                        F.col("p.y.size").alias("ny"), F.expr("p.x.pure or p.y.pure").alias("pure")).agg(F.count("*").alias("shared")))
    overlap = up(f"{num}L * (nx + ny)", num + den)
    least = f"{overlap} - {up(f'{num}L * greatest(nx, ny)', den)} + 1"
    return counted.filter(f"not pure or shared >= {least}").select("head", "rep", F.col("ny").alias("size")).distinct()


def _sized(x: str, y: str, num: int, den: int) -> str:
    """Can sets of these sizes be similar."""
    return f"{den}L * least({x}, {y}) >= {num}L * greatest({x}, {y})"


def _small(df: DataFrame, rows: int = 2_000_000) -> DataFrame:
    """With a broadcast hint if a count shows that it has at most ``rows`` rows (of a few numbers each)."""
    return F.broadcast(df) if df.count() <= rows else df


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(doc_id, shingles) of the documents named in ``wanted``, stored."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _slices(batches, words):
            yield batch(_SET, ids, [s.tobytes() for s in sets])

    return store(docs.join(_small(wanted), F.col("doc_id") == F.col("wanted"), "left_semi")
                 .mapInArrow(build, "doc_id long, shingles binary"), "sets")


def _unpack(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All shingles one after another, and the number of each set."""
    sets = [np.frombuffer(s, np.uint64) for s in column.to_pylist()]
    return np.concatenate(sets), np.array([len(s) for s in sets])


def _links_to_head(table: pa.Table, num: int, den: int) -> pa.Table:
    """The members of one block that are similar to their head."""
    member = np.array(table["member"].to_pylist(), bool)
    head, ids = table["head"][0].as_py(), table["rep"].to_numpy()
    found: set[int] = set()
    if member.any() and not member.all():
        flat, sizes = _unpack(table.filter(pa.array(member))["shingles"])
        owner = np.repeat(np.arange(len(sizes)), sizes)
        for own in table.filter(pa.array(~member))["shingles"].to_pylist():
            mine = np.frombuffer(own, np.uint64)
            at = np.minimum(np.searchsorted(mine, flat), max(0, len(mine) - 1))
            hit = mine[at] == flat if len(mine) else np.zeros(len(flat), bool)
            both = np.bincount(owner[hit], minlength=len(sizes))
            found.update(ids[member][den * both >= num * (len(mine) + sizes - both)].tolist())
    return pa.Table.from_batches([batch(_LINK, [head] * len(found), sorted(found))])


def links_in_block(ids: np.ndarray, own: np.ndarray, side: np.ndarray, flat: np.ndarray, sizes: np.ndarray, num: int,
                   den: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the similar pairs among sets of different components; if there are two sides, of pairs across."""
    _, token = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    postings = owner[np.argsort(token, kind="stable")]
    many = np.bincount(token)
    begins = np.cumsum(many) - many
    ends = np.cumsum(sizes)
    two_sides = side.min() != side.max()
    a, b = [], []
    for i in range(len(sizes)):
        if two_sides and side[i] != side[0]:
            continue
        mine = token[ends[i] - sizes[i]:ends[i]]
        count = many[mine]
        at = np.repeat(begins[mine] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        both = np.bincount(postings[at], minlength=len(sizes))
        near = (den * both >= num * (sizes[i] + sizes - both)) & (own != own[i])
        if two_sides:
            near &= side != side[i]
        near[:i + 1] &= two_sides
        for j in np.flatnonzero(near).tolist():
            a.append(ids[i])
            b.append(ids[j])
    return forest(np.array(a, np.int64), np.array(b, np.int64))


def _links_in_block(table: pa.Table, num: int, den: int) -> pa.Table:
    flat, sizes = _unpack(table["shingles"])
    a, b = links_in_block(table["rep"].to_numpy(), table["own"].to_numpy(), table["side"].to_numpy(), flat, sizes, num, den)
    return pa.Table.from_batches([batch(_LINK, a, b)])


def _to_heads(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): those of the pairs (head, rep) that are similar; ``size`` is that of the rep's set."""
    heads = pairs.groupBy("head").agg(F.count("*").alias("n"), F.sum("size").alias("z")).withColumn("blocks", _blocks(F.col("n"), F.col("z")))
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    members = (sets.join(_small(pairs.join(heads, "head")), F.col("rep") == F.col("doc_id"))
               .select("head", block.alias("block"), "rep", F.lit(True).alias("member"), "shingles"))
    own = (sets.join(_small(heads), F.col("head") == F.col("doc_id"))
           .select("head", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("head").alias("rep"),
                   F.lit(False).alias("member"), "shingles"))
    return members.union(own).groupBy("head", "block").applyInArrow(
        lambda t: _links_to_head(t, num, den), "a long, b long")


def _in_rounds(rows: DataFrame, sets: DataFrame, links: Callable[[DataFrame], DataFrame]) -> list[DataFrame]:
    """What ``links`` finds among the ``rows`` (head, ..., size), stored by rounds: every head is in one of them.

    Every row takes a copy of its set along. A round copies about half as much as all sets hold, and what it has shuffled
    goes before the next, so the disks hold no more than that however many rows there are.
    """
    many, copied = rows.agg(F.count("*"), F.sum("size")).first()
    held = sets.agg(F.sum(F.octet_length("shingles").cast("long"))).first()[0] or 0
    rounds = max(1, -(-many // _ROUND), -(-2 * 8 * (copied or 0) // max(1, held)))
    return [store(links(rows.filter(F.pmod(F.xxhash64(F.lit(1), "head"), F.lit(rounds)) == i)), "links") for i in range(rounds)]


def _within_heads(met: DataFrame, tied: DataFrame, sets: DataFrame, num: int, den: int) -> list[DataFrame]:
    """(a, b): links among the sets (head, rep) that a head has met, as far as ``tied`` (node, component) leaves them apart.

    Sets of the head's own component need no comparison with each other: they are dealt to the blocks of the rest only.
    """
    at_head = tied.select(F.col("node").alias("head"), F.col("component").alias("head_own"))
    placed = (met.join(tied, F.col("rep") == F.col("node"), "left").drop("node").join(at_head, "head", "left")
              .select("head", "rep", "size", F.coalesce("component", "rep").alias("own"), F.coalesce("head_own", "head").alias("head_own"))
              .withColumn("rest", F.col("own") != F.col("head_own")))
    rest, main = F.count(F.when(F.col("rest"), 1)), F.count(F.when(~F.col("rest"), 1))
    rest_z, main_z = (F.coalesce(F.sum(F.when(c, F.col("size"))), F.lit(0)) for c in (F.col("rest"), ~F.col("rest")))
    # Apart are sets of the rest, if there are several components of them, and the rest from the head's own.
    sides = (placed.groupBy("head").agg(rest.alias("n_rest"), main.alias("n_main"), rest_z.alias("z_rest"), main_z.alias("z_main"), F.min("own").alias("low"), F.max("own").alias("high"))
             .filter("n_rest > 0 and low < high")
             .select("head", _blocks(F.col("n_rest"), F.col("z_rest")).alias("rests"), _blocks(F.col("n_main"), F.col("z_main")).alias("mains")))
    rows = store(placed.join(sides, "head")
                 .withColumn("block", F.pmod(F.xxhash64("rep"), F.when(F.col("rest"), F.col("rests")).otherwise(F.col("mains"))).cast("int"))
                 .withColumn("size", F.col("size") * F.when(F.col("rest"), F.col("rests") + F.col("mains")).otherwise(F.col("rests")))
                 .select("head", "rep", "own", "rest", "block", "rests", "mains", "size"), "apart")
    rests, mains = F.sequence(F.lit(0), F.col("rests") - 1), F.sequence(F.lit(0), F.col("mains") - 1)
    among = F.transform(rests, lambda o: F.struct(F.lit(0).alias("kind"), F.least(o, "block").alias("i"), F.greatest(o, "block").alias("j")))
    across = F.when(F.col("mains") > 0, F.transform(mains, lambda o: F.struct(
        F.lit(1).alias("kind"), F.col("block").alias("i"), o.alias("j")))).otherwise(F.array().cast("array<struct<kind:int,i:int,j:int>>"))
    facing = F.transform(rests, lambda o: F.struct(F.lit(1).alias("kind"), o.alias("i"), F.col("block").alias("j")))
    copies = F.explode(F.when(F.col("rest"), F.concat(among, across)).otherwise(facing))
    # Inside one block (kind 0, i = j) all pairs count; else those across: of two blocks, or of the rest and the main part.
    side = F.when(F.col("p.kind") == 1, F.col("rest").cast("int")).otherwise((F.col("block") == F.col("p.i")).cast("int"))

    def links(some: DataFrame) -> DataFrame:
        dealt = some.withColumn("p", copies).select("head", "p.kind", "p.i", "p.j", "rep", "own", side.alias("side"))
        return (sets.join(_small(dealt), F.col("rep") == F.col("doc_id")).select("head", "kind", "i", "j", "rep", "own", "side", "shingles")
                .groupBy("head", "kind", "i", "j").applyInArrow(lambda t: _links_in_block(t, num, den), "a long, b long"))

    found = _in_rounds(rows, sets, links)
    drop(rows)
    return found


def ngram_jaccard(docs: DataFrame, words: int = 5, num: int = 8, den: int = 10, sketch_bits: int = 20,
                  most_pairs: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; sets link at a Jaccard similarity of ``num / den`` or more.

    A document's set holds its distinct shingles of ``words`` words; a shorter text is one shingle. A null, empty or
    blank text has an empty set and links with nothing. Rows that share an id are one document with several texts: what
    one of them links with belongs to the id's component, and each is returned. A row without an id is returned with a
    null component and links with nothing. Texts of any length are used whole; an empty table gives no rows.
    ``component_id`` is the smallest id that links reach.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with brief_shuffles(ready(docs.sparkSession)):
        return _joined(rows, words, num, den, sketch_bits, most_pairs)


def _joined(rows: DataFrame, words: int, num: int, den: int, sketch_bits: int, most_pairs: int) -> DataFrame:
    """The work of ``ngram_jaccard``. A stored table goes when its last reader has ended, since the next may be as large."""
    survey = _survey(rows, words, sketch_bits)
    seen = survey.filter("segment is null").select("doc_id", "n", "h1", "h2")
    real = seen.filter("n > 0 and doc_id is not null")
    # Stored, so that the join below is of two plain shuffles, which Spark can split where a set has very many copies.
    reps = store(real.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep")), "reps")
    members = store(real.join(reps, ["n", "h1", "h2"]).select("doc_id", "n", "h1", "h2", "rep"), "members")
    drop(reps)
    home = members.groupBy("doc_id").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).filter("least <> most")
    same_id = (members.join(home, "doc_id").filter("rep <> least")
               .select(F.col("least").alias("a"), F.col("rep").alias("b")).distinct())

    index = _index(rows, _sketch(survey, sketch_bits), words, num, den, most_pairs)
    by_set = members.select("doc_id", F.col("n").cast("int").alias("size"), "rep").distinct()
    held = store(index.join(by_set, ["doc_id", "size"]).select("key", "rep", "size", "pure").distinct(), "index")
    heads = held.groupBy("key").agg(F.min(F.struct("rep", "size")).alias("h"), F.count("*").alias("n")).filter("n > 1")
    led = store(held.join(heads.select("key", F.col("h.rep").alias("head"), F.col("h.size").alias("head_size"), "n"), "key"), "led")
    drop(held)
    likely = store(_likely_pairs(led, num, den), "pairs")
    met = store(led.filter((F.col("n") > _FEW) & (F.col("rep") != F.col("head")))
                .select("head", "rep", "size", "head_size").distinct(), "met")
    drop(led)
    wanted = store(likely.select("head", "rep").unionByName(met.select("head", "rep")).select(F.explode(F.array("head", "rep")).alias("wanted"))
                   .distinct(), "wanted")
    sets = _sets(rows, wanted, words)
    drop(wanted)
    first = store(met.filter(_sized("size", "head_size", num, den)).select("head", "rep", "size").unionByName(likely).distinct(), "first")
    drop(likely)
    near = _in_rounds(first, sets, lambda some: _to_heads(some, sets, num, den))
    drop(first)
    tied = store(connected_components(reduce(DataFrame.union, [*near, same_id])), "tied")
    drop(*near)
    further = _within_heads(met.select("head", "rep", "size").distinct(), tied, sets, num, den)
    drop(met, sets)
    links = reduce(DataFrame.union, further).union(tied.select(F.col("node").alias("a"), F.col("component").alias("b")))
    whole = store(connected_components(links), "components")
    drop(*further, tied)
    if whole.count() <= _SMALL:
        whole = F.broadcast(whole)

    placed = (members.select("doc_id", F.col("n").alias("n_shingles"), "rep")
              .join(whole, F.col("rep") == F.col("node"), "left")
              .select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id")))
    rest = seen.filter("n = 0 or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"),
                                                         F.col("doc_id").alias("component_id"))
    return placed.union(rest)
