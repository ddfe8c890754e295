"""Plan shapes that must hold at scale, and the registry."""

import io
import re
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from riskframe.operators import evaluation as ev, features as fe, profile as pr, quality as dq, sampling as sm
from riskframe.plans.bindings import modelling_table, order_survey, scored_orders
from riskframe.plans import storage
from riskframe.plans.pairs import pair_moments
from riskframe.plans.storage import drop_stored, session_folder, store
from riskframe.sources.tables import table


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_survey_reads_only_what_a_query_needs(spark, sf):
    text = plan(ev.summary_metrics(scored_orders(spark, sf), "y", "pred_a"))
    reads = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    lines = next(r for r in reads if "l_orderkey" in r)
    assert "l_quantity" in lines and "l_discount" not in lines and "l_comment" not in lines
    assert not any("o_totalprice" in r for r in reads)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_filters_reach_the_scan(spark, sf):
    text = plan(dq.in_range(table(spark, sf, "orders"), "o_totalprice", high=1000))
    assert "LessThanOrEqual(o_totalprice,1000.0)" in text


def test_examples_are_cut_before_the_shuffle(spark, sf):
    text = plan(ev.error_examples(scored_orders(spark, sf), "id", ["segment"], "y", "pred_a"))
    assert text.count("WindowGroupLimit") >= 2


def test_one_aggregate_per_report(spark, sf):
    df = store(scored_orders(spark, sf))
    for report in (dq.missing_report(df, ["qty_sum", "n_lines"]), ev.class_report(df, "y", "pred_a"),
                   ev.error_rates(df, ["segment", "status"], "y", "pred_a")):
        assert plan(report).count("Scan parquet") <= 2  # listed in the tree and in the details


def test_samplers_do_not_shuffle_the_rows(spark, sf):
    rows = store(scored_orders(spark, sf).select("id", "y"))
    for df in (sm.stratified_split(rows, "id", ["y"]), sm.stratified_folds(rows, "id", ["y"])):
        text = plan(df)
        assert "hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_stored_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    import os

    monkeypatch.setattr(storage, "shared_folder", lambda _: str(tmp_path))
    kept = store(spark.range(3), "gone")
    assert kept.count() == 3 and os.listdir(session_folder(spark))
    drop_stored(spark)
    assert not os.path.exists(session_folder(spark))


def test_a_part_reads_its_folds_files_only(spark, sf):
    table, _ = modelling_table(spark, sf)
    text = plan(table.filter("split = 'train'").filter("fold <> 2"))
    filters = re.findall(r"PartitionFilters: \[(.*)\]", text)
    assert filters and all("fold" in f and "train" in f for f in filters)


def test_pair_matrices_do_not_multiply_rows(spark, sf):
    df = order_survey(spark, sf)
    for report in (pair_moments(df, ["acctbal", "qty_sum", "n_lines"]), fe.covariance_matrix(df, ["acctbal", "qty_sum"])):
        assert "Generate" not in plan(report) and "MapInPandas" in plan(report)
    # The correlations list their pairs beside it, a row per pair.
    assert plan(pr.guarded_corr(df, ["acctbal", "qty_sum"])).count("Generate") <= 2


def test_the_survey_is_evaluated_once_for_counts(spark, sf):
    df = store(order_survey(spark, sf).select("id", "status", "segment"))
    text = plan(dq.drop_rare(df, ["status", "segment"], 0.1))
    assert text.count("Location: InMemoryFileIndex") == 3  # the rows and the frequent values of two columns


@pytest.mark.parametrize("name", ["entry", "oracle"])
def test_registry(spark, name):
    if name == "entry":
        assert entry.entry(spark).count() > 10
    else:
        assert set(entry.oracle_sql()) <= set(entry.queries())
        assert len(entry.queries()) > 100


def test_survey_has_natural_nulls(spark, sf):
    assert order_survey(spark, sf).filter("qty_sum is null").count() > 0


def test_passes_send_few_bytes_to_python_at_a_time(spark):
    from riskframe.plans import blocks

    rows = spark.range(0, 16, 1, 1).select(F.expr("repeat(cast(id % 10 as string), 4000000)").cast("binary").alias("x"))
    found = blocks.sum_batches(store(rows, "wide"), lambda batches: {"most": np.array([max(b.nbytes for b in batches)])})
    assert found["most"][0] < 17_000_000
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "67108864b"
