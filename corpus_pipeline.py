"""The corpus pipeline: quality, near duplicates, secrets, packing. Each stage works on what the one before has kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm import ngram_join, packing, quality, secret_scan
from riskframe.llm.workers import short_batches
from riskframe.plans.storage import fresh_path, store
from riskframe.sources.tables import table

_SMALL = 2_000_000


def _without(docs: DataFrame, gone: DataFrame, same) -> DataFrame:
    """The rows that ``gone`` (a few numbers a row) doesn't name; broadcast if a count allows, else joined by shuffle."""
    gone = store(gone.distinct(), "gone")
    return docs.join(F.broadcast(gone) if gone.count() <= _SMALL else gone, same(gone), "left_anti")


def _row_key(docs: DataFrame):
    """A row of ``documents`` by its id and text: rows that share both are repeats of one row."""
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"])


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model of trusted text doesn't reject, row by row.

    Null and empty texts, rows without an id and repeated rows are judged like any other; an empty table stays empty.
    """
    judged = quality.classify(docs, table(spark, sf_dir, "labels"))
    rejected = judged.filter("not kept").select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"))
    return _without(docs, rejected, lambda gone: docs["doc_id"].cast("long").eqNullSafe(gone["gone_id"])
                    & F.xxhash64(docs["text"]).eqNullSafe(gone["gone_key"]))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates (five-word shingles, similarity 0.8) the row with the smallest id.

    A document is a row: rows that share an id and resemble nothing all stay, copies without an id go (a row with an id is
    kept before one without). Of repeated rows one stays. Null, empty and blank texts link with nothing and stay.
    """
    keyed = docs.select(_row_key(docs).alias("doc_id"), docs["doc_id"].cast("long").alias("shown_id"), docs["text"])
    found = ngram_join.ngram_jaccard(keyed, words=5, num=8, den=10).filter("n_shingles > 0")
    found = store(found.groupBy("doc_id", "component_id").agg(F.count("*").alias("times")), "near-duplicates")
    ids = store(keyed.select(F.col("doc_id").alias("key"), "shown_id").distinct(), "ids")
    # Only groups of several rows have anything to lose.
    several = found.groupBy("component_id").agg(F.sum("times").alias("n")).filter("n > 1").select("component_id")
    grouped = store(found.join(several, "component_id").join(ids, F.col("doc_id") == F.col("key"))
                    .select("component_id", "key", "shown_id", "times"), "groups")
    first = F.min(F.struct(F.col("shown_id").isNull(), "shown_id", "key"))
    kept = store(grouped.groupBy("component_id").agg(first.getField("key").alias("kept_key")), "kept")
    copies = grouped.join(kept, "component_id").filter("key <> kept_key").select(F.col("key").alias("gone_key"))
    left = _without(docs, copies, lambda gone: _row_key(docs) == gone["gone_key"])
    repeated = store(grouped.join(kept, F.col("key") == F.col("kept_key"), "left_semi").filter("times > 1")
                     .select(F.col("key").alias("again_key")), "again")
    if repeated.isEmpty():
        return left
    again = _row_key(left) == repeated["again_key"]
    once = left.join(repeated, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(repeated, again, "left_anti").union(once)


def documents_without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts blanked out.

    Every row is read by itself, whatever its id; null and empty texts and repeated rows stay as they are.
    """
    return secret_scan.redact(docs, secret_scan.learn(docs))


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 ids.

    Null and empty texts have their end id alone; rows without an id and repeated rows are packed like any other.
    """
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, slice_bytes=1_000_000,
                                  stretches=150_000).drop("ids")


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", distinct_documents),
    ("secrets", documents_without_secrets),
    ("packing", packed_documents),
]

#: The stages' results depend on trained models and on the windows' order; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; every stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    with short_batches(spark):
        for name, stage in STAGES:
            path = fresh_path(spark, f"stage-{name}")
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
