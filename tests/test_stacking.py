"""The nested stack: what scores a fold has not seen its labels."""

import pytest
from pyspark.sql import functions as F

from riskframe.operators import training as tr
from riskframe.plans.bindings import modelling_table


@pytest.fixture(scope="module")
def train(spark, sf):
    rows, _ = modelling_table(spark, sf)
    return rows.filter("split = 'train' and fold < 3")


BASES = [tr.lr(0.1), tr.forest(4, 6), tr.boosted(4, depth=3), tr.leafwise(4)]


def test_flipped_labels_of_a_fold_change_nothing_that_scores_it(train):
    flipped = train.withColumn("y", F.when(F.col("fold") == 1, 1 - F.col("y")).otherwise(F.col("y")))
    pairs = [(0, 1), (0, 2), (1, 2), (0,), (1,), (2,)]
    inputs, scores = [], []
    for rows in (train, flipped):
        found = tr.scores_without(rows, BASES, pairs).filter("outer = 1").collect()
        inputs.append({(r["model"], r["id"]): round(r["score"], 6) for r in found})
        stacked = tr.nested_stack(rows, BASES, folds=3).collect()
        assert len(stacked) == len({r["id"] for r in stacked}) == train.count()
        scores.append({r["id"]: round(r["score"], 5) for r in stacked if r["fold"] == 1})
    assert inputs[0] and inputs[0] == inputs[1]  # base scores of all rows that the outer fold uses
    assert scores[0] and scores[0] == scores[1]


def test_stack_is_as_good_as_its_bases(train):
    stacked = tr.nested_stack(train, BASES, folds=3)
    auc = tr.summarise_folds(tr.fold_metrics(stacked)).first()["roc_auc_mean"]
    base = tr.summarise_folds(tr.fold_metrics(tr.out_of_fold(train, BASES[:1], folds=3))).first()["roc_auc_mean"]
    assert auc > base - 0.03


def test_a_pair_scores_both_of_its_folds(train):
    found = tr.scores_without(train, [tr.lr()], [(0, 2), (1,)]).groupBy("fold", "outer").count().collect()
    sizes = {r["fold"]: r["count"] for r in train.groupBy("fold").count().collect()}
    assert {(r["fold"], r["outer"]): r["count"] for r in found} == {(0, 2): sizes[0], (2, 0): sizes[2], (1, 1): sizes[1]}
