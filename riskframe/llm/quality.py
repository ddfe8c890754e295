"""Quality classifier: an interpolated modified Kneser-Ney model of characters, trained on trusted text.

The n-grams of every chunk of documents are listed once (see ``chunks``), with their counts in trusted documents. The
counts are summed, and continuation counts, discounts, context weights and interpolated probabilities are joins and
aggregates keyed by n-gram. The probabilities are joined to the chunks' n-grams, and a chunk scores its documents. A
document whose perplexity is above its language's quantile of held-out trusted documents is rejected; where those are
few, the quantile of all languages, shifted to the language's median, counts too.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from riskframe.llm.chunks import chunked, finish, pack, term_rows
from riskframe.llm.tokens import text_array
from riskframe.plans.storage import store

#: Stands before every text, as often as the longest context needs.
START = "\x02"
_BINS = 1_024  # of perplexity, per bit
_FOUND = pa.schema([("chunk", pa.int64()), ("pos", pa.list_(pa.int32())), ("logp", pa.list_(pa.float64())),
                    ("weight", pa.list_(pa.float64()))])


def _dense(codes: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """Codes below ``size`` renumbered without gaps, in ascending order, and how many there are."""
    if size <= 1 << 23:
        there = np.zeros(size, bool)
        there[codes] = True
        number = np.cumsum(there, dtype=np.int32) - 1
        return number[codes], int(there.sum())
    distinct, numbered = np.unique(codes, return_inverse=True)
    return numbered.astype(np.int32), len(distinct)


class Grams:
    """The n-grams of some texts: per order the dense code of the n-gram that ends at each character."""

    def __init__(self, texts: list[str], order: int):
        pad = START * (order - 1)
        self.text = "".join(pad + text for text in texts)
        symbols = np.frombuffer(self.text.encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.lengths = lengths
        ends = np.cumsum(lengths + order - 1)
        real = np.ones(len(symbols), bool)
        for k in range(order - 1):
            real[ends - lengths - 1 - k] = False
        self.at = np.flatnonzero(real)  # positions of the texts' own characters
        chars, alphabet = _dense(symbols, int(symbols.max()) + 1) if len(symbols) else (symbols, 0)
        self.codes, self.sizes, before = [], [], chars
        n = alphabet
        for k in range(1, order + 1):
            if k > 1:
                joined = np.zeros(len(chars), np.int64)
                np.multiply(before[:-1], alphabet, out=joined[1:], dtype=np.int64)
                joined[1:] += chars[1:]
                before, n = _dense(joined, max(1, n * alphabet))
            self.codes.append(before)
            self.sizes.append(n)

    def places(self, k: int) -> np.ndarray:
        """A position of each n-gram of order ``k`` (its last character)."""
        place = np.zeros(self.sizes[k - 1], np.int64)
        place[self.codes[k - 1]] = np.arange(len(self.codes[k - 1]))
        return place

    def strings(self, k: int) -> list[str]:
        text = self.text
        return [text[max(0, p + 1 - k):p + 1] for p in self.places(k).tolist()]


    def terms(self, order: int) -> list[str]:
        """The n-grams of all orders, by order and code."""
        return [s for k in range(1, order + 1) for s in self.strings(k)]


def _parts(texts: pa.Array, size: int = 600_000) -> list[tuple[int, int]]:
    """Rows (from, to) with about ``size`` bytes of text each: what arrays are laid out for at a time."""
    held = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64) // size
    ends = (np.flatnonzero(np.diff(held, append=-1)) + 1).tolist()
    return list(zip([0, *ends], ends))


def _build(order: int, rows: pa.Table) -> tuple[pa.Table, pa.Array, pa.Array]:
    texts, trains = text_array(rows["text"].combine_chunks()), pc.equal(rows["role"], 1).to_numpy()
    listed, counted = [], []
    for start, end in _parts(texts):
        grams = Grams(texts.slice(start, end - start).to_pylist(), order)
        used = grams.codes[-1][grams.at[np.repeat(trains[start:end], grams.lengths)]]
        counts = np.bincount(used, minlength=grams.sizes[-1])
        listed.append(pa.array(grams.terms(order), pa.string()))
        counted.append(np.concatenate([np.zeros(len(listed[-1]) - len(counts), np.int64), counts]))
    coded = pa.concat_arrays(listed).dictionary_encode()
    total = np.bincount(coded.indices.to_numpy(), weights=np.concatenate(counted), minlength=len(coded.dictionary))
    return rows, coded.dictionary, pa.array(total.astype(np.int64))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts from how many n-grams have the counts 1 to 4; halves where those say nothing."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    raw = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(d, 0.05), i + 1.0) for i, d in enumerate(raw))  # type: ignore[return-value]


def kneser_ney(counts: DataFrame, order: int) -> tuple[DataFrame, float]:
    """(term, logp, weight) and the base-2 logarithm of an unknown character's probability.

    ``counts`` has the n-grams of the highest order as ``term`` and their counts ``c``. ``logp`` is the interpolated
    probability of a term's last character after the others, ``weight`` what a term as a context passes on to shorter
    ones, both as base-2 logarithms. Lower orders count in how many different contexts a term continues.
    """
    level, tables = counts.select("term", "c"), []
    for k in range(order, 0, -1):
        level = store(level, "gram-counts")
        tables.append((k, level))
        level = (level.groupBy(F.expr(f"substring(term, 2, {k - 1})").alias("term")).agg(F.count("*").alias("c"))
                 if k > 1 else level)
    below: DataFrame | None = None
    unknown, probabilities, weights = 0.0, [], []
    for k, level in reversed(tables):
        n = level.agg(*(F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)),
                      F.count("*").alias("kinds")).first()
        d1, d2, d3 = discounts(n["n1"], n["n2"], n["n3"], n["n4"])
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        split = level.withColumn("context", F.expr(f"substring(term, 1, {k - 1})")).withColumn("cut", cut)
        contexts = store(split.groupBy("context").agg(F.sum("c").alias("total"), (F.sum("cut") / F.sum("c")).alias("passed")),
                         "contexts")
        own = split.join(contexts, "context").withColumn("own", F.greatest(F.col("c") - F.col("cut"), F.lit(0.0)) / F.col("total"))
        if below is None:  # single characters; all unknown ones share one part
            first = contexts.first()
            even = first["passed"] / (n["kinds"] + 1) if first else 1.0
            unknown = math.log2(even)
            below = own.select("term", (F.col("own") + even).alias("p"))
        else:
            suffix = below.select(F.col("term").alias("suffix"), F.col("p").alias("shorter"))
            below = (own.withColumn("suffix", F.expr(f"substring(term, 2, {k - 1})")).join(suffix, "suffix")
                     .select("term", (F.col("own") + F.col("passed") * F.col("shorter")).alias("p")))
            weights.append(contexts.select(F.col("context").alias("term"), F.log2("passed").alias("weight")))
        below = store(below, "grams")
        probabilities.append(below.select("term", F.log2("p").alias("logp")))
    logp, weight = probabilities[0], weights[0] if weights else None
    for more in probabilities[1:]:
        logp = logp.union(more)
    for more in weights[1:]:
        weight = weight.union(more)
    if weight is None:
        return logp.withColumn("weight", F.lit(None).cast("double")), unknown
    return logp.join(weight, "term", "full"), unknown


def score_grams(grams: Grams, order: int, logp: np.ndarray, weight: np.ndarray, unknown: float) -> np.ndarray:
    """The log-probability of every n-gram of the highest order; arrays of all orders' terms, NaN where not found."""
    edges = np.concatenate([[0], np.cumsum(grams.sizes)])
    score = np.where(np.isnan(logp[:edges[1]]), unknown, logp[:edges[1]])
    for k in range(2, order + 1):
        place = grams.places(k)
        own, passed = logp[edges[k - 1]:edges[k]], weight[edges[k - 2]:edges[k - 1]]
        shorter = score[grams.codes[k - 2][place]] + np.nan_to_num(passed[grams.codes[k - 2][np.maximum(place - 1, 0)]])
        score = np.where(np.isnan(own), shorter, own)
    return score


def trusted_roles(labels: DataFrame, held_out: int = 5) -> DataFrame:
    """(doc_id, role) of documents whose labels all say good and none toxic: 1 trains, 2 (one in ``held_out``) calibrates."""
    return (labels.filter("doc_id is not null").groupBy("doc_id")
            .agg(F.min("quality").alias("good"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
            .filter("good = 1 and toxic = 0")
            .select("doc_id", F.when(F.pmod(F.xxhash64("doc_id"), F.lit(held_out)) == 0, 2).otherwise(1).alias("role")))


def score_documents(docs: DataFrame, roles: DataFrame, order: int = 4, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", chunk_bytes: int = 10_000_000, small: int = 2_000_000) -> DataFrame:
    """(doc_id, text_key, lang, role, n_chars, bits): bits per character of every row under the trusted text's model.

    ``bits`` is null for a null or empty text. Every trusted document trains the model (role 1), whatever their number.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("text_key"), F.col(lang_col).cast("string").alias("lang"))
    known = store(roles.select(F.col("doc_id").alias("labelled"), "role"), "roles")
    known = F.broadcast(known) if known.count() <= small else known  # two numbers a row; beyond, a shuffled join
    rows = (rows.join(known, F.col("doc_id") == F.col("labelled"), "left")
            .select("doc_id", "text", "text_key", "lang", F.coalesce("role", F.lit(0)).alias("role")))
    chunks = chunked(rows, 1, lambda table: _build(order, table), "quality", chunk_bytes)
    counts = (chunks.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).filter("t.counts > 0")
              .groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("c")))
    model, unknown = kneser_ney(counts, order)

    def listed(batches):
        for found in batches:
            if found.num_rows:
                yield pack(_FOUND, found.column(0).to_numpy(), found.column(1).to_numpy(), found.column(2), found.column(3))

    met = (term_rows(chunks).join(model, "term").select("chunk", "pos", "logp", "weight")
           .mapInArrow(listed, "chunk long, pos array<int>, logp array<double>, weight array<double>"))

    def score(payload: pa.Table, terms: pa.Array, found: dict[str, pa.Array]) -> pa.Table:
        texts = text_array(payload["text"].combine_chunks())
        logp, weight = (found[n].to_numpy(zero_copy_only=False).astype(float) for n in ("logp", "weight"))
        lengths, sums = [np.empty(0, np.int64)], [np.empty(0)]
        for start, end in _parts(texts):
            grams = Grams(texts.slice(start, end - start).to_pylist(), order)
            place = pc.index_in(pa.array(grams.terms(order), pa.string()), terms).to_numpy()
            each = score_grams(grams, order, logp[place], weight[place], unknown)[grams.codes[-1][grams.at]]
            total, ends = np.concatenate([[0.0], np.cumsum(each)]), np.cumsum(grams.lengths)
            lengths.append(grams.lengths)
            sums.append(total[ends] - total[ends - grams.lengths])
        n, total = np.concatenate(lengths), np.concatenate(sums)
        return pa.table({"doc_id": payload["doc_id"], "text_key": payload["text_key"], "lang": payload["lang"],
                         "role": payload["role"], "n_chars": pa.array(n),
                         "bits": pa.array(-total / np.maximum(n, 1), mask=n == 0)})

    return finish(chunks, met, score, "doc_id long, text_key long, lang string, role int, n_chars long, bits double")


def classify(docs: DataFrame, labels: DataFrame, order: int = 4, quantile: float = 0.995, margin: float = 0.15,
             slack: float = 3.0, fewest: int = 20, **columns: str) -> DataFrame:
    """(doc_id, text_key, lang, n_chars, bits, perplexity, threshold, kept) of every row.

    The mean of a few characters scatters, so a row is judged by its bits per character less ``slack`` over the root of
    its length. It is rejected above its language's ``quantile`` of held-out trusted documents plus ``margin``
    (``threshold`` has the slack added again, to compare with ``bits``). The model has hardly seen a language with little
    trusted text, and few held-out documents say little about its quantile. So every language (a null one is a language)
    also has a shifted quantile: that of all languages, moved to the median of all documents of the language, labelled or
    not, where that is higher. As far as it is above the language's own quantile, it counts with the weight of ``fewest``
    documents against the held-out ones; without any it stands alone. Null and empty texts and, without held-out trusted
    text, all rows are kept. Null and repeated ids are kept as they are, rows are judged one by one, texts of any length
    whole; an empty table gives no rows.
    """
    scored = store(score_documents(docs, trusted_roles(labels), order, **columns), "scored")
    allowed = F.lit(slack) / F.sqrt(F.greatest("n_chars", F.lit(1)))
    # Bins of a fixed width, at most a few ten thousand a language.
    bins = store(scored.filter("bits is not null")
                 .groupBy("lang", F.ceil((F.col("bits") - allowed) * _BINS).alias("bin"))
                 .agg(F.count("*").alias("n"), F.count(F.when(F.col("role") == 2, 1)).alias("n_held")), "bins")

    def cut(share: float, count: str) -> Column:
        return F.expr(f"percentile(bin, {share}, {count}) / {_BINS}")
    common = bins.agg(cut(quantile, "n_held").alias("high"), cut(0.5, "n_held").alias("middle")).first()
    high = F.lit(common["high"]).cast("double")
    shifted = F.greatest(high, F.col("middle") + high - F.lit(common["middle"]).cast("double"))
    raised = F.greatest(shifted - F.col("own"), F.lit(0.0)) * fewest / (F.col("n_held") + fewest)
    limits = (bins.groupBy("lang").agg(cut(quantile, "n_held").alias("own"), cut(0.5, "n").alias("middle"),
                                       F.sum("n_held").alias("n_held"))
              .select(F.col("lang").alias("l"), F.coalesce(F.col("own") + raised, shifted).alias("limit")))
    return (scored.join(limits, F.col("lang").eqNullSafe(F.col("l")), "left")
            .withColumn("threshold", F.coalesce("limit", high) + margin + allowed)
            .withColumn("kept", F.coalesce(F.col("bits") <= F.col("threshold"), F.lit(True)))
            .select("doc_id", "text_key", "lang", "n_chars", "bits", F.pow(F.lit(2.0), F.col("bits")).alias("perplexity"),
                    "threshold", "kept"))
