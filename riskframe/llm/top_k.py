"""Exact top-k search by exhaustive term-at-a-time accumulation.

A vector's components are its terms. Queries and candidates are dealt into blocks by hashes of their ids; a pair of
blocks is one group. There every term of a query tile scatters its weights over the term's postings (the candidates
that have it) into a dense score array; the k best of each query are selected by partition, and a last step merges the
blocks' winners.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.llm.workers import ready

_LONG = np.iinfo(np.int64)


def usable(vector: Column) -> Column:
    """Not null and without null or non-finite components."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(False))


def score_block(queries: np.ndarray, candidates: np.ndarray, tile: int = 128) -> Iterator[tuple[int, np.ndarray]]:
    """(first query, scores of a tile of queries against all candidates), integers throughout.

    Both are matrices of whole numbers with as many columns. 64-bit integers where no sum can leave them, else Python's.
    """
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(1, queries.shape[1])
    kind = np.int64 if most < 2.0 ** 62 else object

    def whole(m: np.ndarray) -> np.ndarray:
        return m.astype(np.int64) if kind is np.int64 else np.array([[int(x) for x in r] for r in m], object).reshape(m.shape)
    queries, candidates = whole(queries), whole(candidates)
    postings = []
    for term in range(candidates.shape[1]):
        rows = np.flatnonzero(candidates[:, term])
        postings.append((None if len(rows) == len(candidates) else rows, np.ascontiguousarray(candidates[rows, term])))
    for first in range(0, len(queries), tile):
        part = queries[first:first + tile]
        scores = np.zeros((len(part), len(candidates)), kind)
        for term, (rows, weights) in enumerate(postings):
            having = np.flatnonzero(part[:, term])
            if not len(having) or not len(weights):
                continue
            product = part[having, term][:, None] * weights[None, :]
            if rows is None and len(having) == len(part):
                scores += product
            elif rows is None:
                scores[having] += product
            else:
                scores[np.ix_(having, rows)] += product
        yield first, scores


def best_of_block(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best candidates of every query of a pair of blocks; ties go to the smaller id."""
    found: list[tuple] = []
    if len(queries) and len(candidates):
        candidates = candidates.sort_values("id", kind="stable")
        ids, q_ids, q_rows = candidates["id"].to_numpy(), queries["id"].to_numpy(), queries["row"].to_numpy()
        terms = max(max(map(len, queries["v"])), max(map(len, candidates["v"])))

        def matrix(vectors: pd.Series) -> np.ndarray:  # a shorter vector lacks the later terms
            return np.vstack([np.pad(np.asarray(v, float), (0, terms - len(v))) for v in vectors])
        for first, scores in score_block(matrix(queries["v"]), matrix(candidates["v"])):
            keep = min(k + 1, scores.shape[1])  # one more, since the query's own row may be among them
            if scores.dtype == object:
                least = np.sort(scores, axis=1)[:, -keep]
            else:
                least = np.partition(scores, scores.shape[1] - keep, axis=1)[:, -keep]
            for row, (line, floor) in enumerate(zip(scores, least)):
                query = q_ids[first + row]
                near = np.flatnonzero((line >= floor) & (ids != query))
                if len(near) < min(k, len(ids)):  # several rows bear the query's id
                    near = np.flatnonzero(ids != query)
                near = near[np.argsort(-line[near], kind="stable")[:k]]  # ids ascend, so ties keep the smaller
                found += [(query, q_rows[first + row], int(ids[c]), int(min(max(line[c], _LONG.min), _LONG.max)))
                          for c in near]
    return pd.DataFrame(found, columns=["query_id", "row", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: float = 256.0, query_block: int = 16_384, candidate_block: int = 8_192) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows by integer inner product of floor(scale * x).

    ``is_query`` is a condition on ``id_col``. A row is no candidate of queries that bear its id. Vectors that are null
    or hold null or non-finite components take no part, nor do rows without an id; a shorter vector counts as zero in
    the missing components; repeated rows are candidates of their own, and a repeated query row is answered once. Fewer
    than k candidates give as many ranks; an empty table gives no rows. Scores beyond 64 bits are set to the nearest
    64-bit number. Work is queries x candidates; a group holds a pair of bounded blocks, whatever the data.
    """
    spark = ready(vectors.sparkSession)
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("x"),
                           F.coalesce(is_query, F.lit(False)).alias("asks"))
            .filter(F.col("id").isNotNull() & usable(F.col("x")))
            .withColumn("v", F.transform("x", lambda x: F.floor(x.cast("double") * scale).cast("double"))))
    sizes = rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("asks"), 1)).alias("q")).first()
    c_blocks = max(1, math.ceil(sizes["n"] / candidate_block))
    q_blocks = max(1, math.ceil(sizes["q"] / query_block))

    def blocks(salt: str, n: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "id", "v"), F.lit(n)).cast("int")

    asked = (rows.filter("asks").select("id", F.xxhash64("v").alias("row"), "v").dropDuplicates(["id", "row"])
             .withColumn("qb", blocks("q", q_blocks)).withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1)))))
    held = (rows.select("id", "v").withColumn("cb", blocks("c", c_blocks))
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))))
    winners = (asked.groupBy("qb", "cb").cogroup(held.groupBy("qb", "cb"))
               .applyInPandas(lambda q, c: best_of_block(q, c, k), "query_id long, row long, vec_id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id"))
    return winners.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
