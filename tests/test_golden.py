"""Published figures the operators must reproduce from their inputs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import evaluation as ev, fairness as fair, quality as dq, significance as sg
from riskframe.operators.sampling import largest_remainder
from riskframe.plans.ordered import exact_quantiles


def from_cells(spark, tn, fp, fn, tp):
    cells = spark.createDataFrame([(0, 0, tn), (0, 1, fp), (1, 0, fn), (1, 1, tp)], "y int, pred int, n int")
    return cells.filter("n > 0").select("y", "pred", F.explode(F.sequence(F.lit(1), "n")).alias("i"))


def test_class_report(spark):
    rows = {r["label"]: r for r in ev.class_report(from_cells(spark, 1933, 380, 500, 2767), digits=10).collect()}
    assert rows["0"]["precision"] == pytest.approx(0.7944923962, abs=1e-9)
    assert rows["0"]["recall"] == pytest.approx(0.8357111976, abs=1e-9)
    assert rows["0"]["f1"] == pytest.approx(0.8145806995, abs=1e-9)
    assert rows["1"]["precision"] == pytest.approx(0.8792500794, abs=1e-9)
    assert rows["1"]["recall"] == pytest.approx(0.8469543924, abs=1e-9)
    assert rows["1"]["f1"] == pytest.approx(0.8628001247, abs=1e-9)
    assert rows["accuracy"]["f1"] == pytest.approx(0.8422939068, abs=1e-9)
    assert rows["macro avg"]["f1"] == pytest.approx(0.8386904121, abs=1e-9)
    assert rows["weighted avg"]["support"] == 5580


def test_macro_f1(spark):
    row = ev.summary_metrics(from_cells(spark, 2309 - 368, 368, 531, 3263 - 531), digits=5).first()
    assert row["f1_macro"] == 0.83534 and row["accuracy"] == 0.83866


def test_macro_average_skips_a_label_that_never_occurs(spark):
    row = ev.summary_metrics(from_cells(spark, 0, 0, 0, 5)).first()
    assert row["f1_macro"] == 1.0 and row["specificity"] == 0.0


def test_mcnemar(spark):
    cells = spark.createDataFrame([(1, 1, 4637), (1, 0, 36), (0, 1, 53), (0, 0, 846)], "a int, b int, n int")
    rows = cells.select(F.lit(1).alias("y"), "a", "b", F.explode(F.sequence(F.lit(1), "n")))
    got = sg.mcnemar(rows, "y", "a", "b").first()
    assert (got["only_a"], got["only_b"]) == (36, 53)
    assert got["statistic"] == pytest.approx(2.876404, abs=1e-6)
    assert got["p_value"] == pytest.approx(0.089887, abs=1e-6)


def pairs(spark, a, b):
    return spark.createDataFrame([("a", "b", i, float(x), float(y)) for i, (x, y) in enumerate(zip(a, b))],
                                 "name_a string, name_b string, fold int, a double, b double")


def test_signed_ranks_exact(spark):
    # Ranks 1..5 with 1, 5 on one side: W = 6, p = 26/32.
    got = sg.wilcoxon(pairs(spark, [0.1, 0, 0, 0, 0.5], [0, 0.2, 0.3, 0.4, 0])).first()
    assert got["w"] == 6.0 and got["p_value"] == 0.8125


def test_signed_ranks_without_differences(spark):
    got = sg.wilcoxon(pairs(spark, [1, 2, 3], [1, 2, 3])).first()
    assert got["n"] == 0 and got["w"] is None and got["p_value"] is None


def test_paired_t(spark):
    a, b = [0.84, 0.85, 0.83, 0.86, 0.84], [0.83, 0.85, 0.82, 0.84, 0.85]
    d = [x - y for x, y in zip(a, b)]
    mean = sum(d) / 5
    t = mean / (math.sqrt(sum((x - mean) ** 2 for x in d) / 4) / math.sqrt(5))
    got = sg.paired_t(pairs(spark, a, b), 5, None).first()
    assert got["t_stat"] == pytest.approx(t)
    # Student-t tail by Simpson's rule over theta = atan(t / 2).
    steps, low = 20000, math.atan(abs(t) / 2)
    h = (math.pi / 2 - low) / steps
    area = sum((1 if i in (0, steps) else 4 if i % 2 else 2) * math.cos(low + i * h) ** 3 for i in range(steps + 1))
    assert got["p_value"] == pytest.approx(2 * 0.375 * 2 * area * h / 3, abs=1e-9)


def test_stratified_sizes(spark):
    sizes = spark.createDataFrame([(0, 11545), (1, 16314)], "y int, n_class long")
    assert {r["y"]: r["want"] for r in largest_remainder(sizes, ["y"], 0.2).collect()} == {0: 2309, 1: 3263}


def test_iqr_fences(spark):
    rows = spark.createDataFrame([(float(v),) for v in [21] * 30 + [25] * 40 + [30] * 30 + [44, 7]], "age double")
    got = dq.iqr_outliers(rows, ["age"]).first()
    assert (got["fence_low"], got["fence_high"], got["outliers"]) == (7.5, 43.5, 2)


def test_ledger(spark):
    rows = spark.range(27901).select(
        F.when(F.col("id") >= 3, 1.0).alias("stress"), F.when(F.col("id").between(10, 18), 0.0).otherwise(7.0).alias("cgpa"),
        F.when(F.col("id").between(100, 1798), 0.0).otherwise(5.0).alias("hours"),
        F.when(F.col("id").between(2000, 2017), "Others").otherwise("x").alias("sleep"),
        F.when(F.col("id").between(3000, 3011), "Others").otherwise("x").alias("diet"))
    rules = [dq.Rule("missing", F.col("stress").isNull()), dq.Rule("zero grade", dq.invalid(F.col("cgpa"), 0.0)),
             dq.Rule("zero hours", F.col("hours") == 0, flag_only=True),
             dq.Rule("rare", F.col("sleep").eqNullSafe("Others") | F.col("diet").eqNullSafe("Others"))]
    got = [(r["dropped"], r["flagged"]) for r in dq.rule_ledger(rows, rules).orderBy("step").collect()]
    assert got == [(3, 0), (9, 0), (0, 1699), (30, 0)]
    assert dq.apply_rules(rows, rules).count() == 27859


def test_gaps_and_flags(spark):
    metrics = spark.createDataFrame(
        [("Overall", "All", 0.835, 0.837), ("Pressure", "Low", 0.75, 0.60), ("Pressure", "High", 0.80, 0.94),
         ("Gender", "F", 0.84, 0.84), ("Gender", "M", 0.83, 0.83)],
        "subgroup string, group string, f1_macro double, recall_pos double")
    gaps = {r["subgroup"]: r for r in fair.gap_report(metrics).collect()}
    assert gaps["Pressure"]["recall_gap"] == 0.34 and gaps["Gender"]["f1_gap"] == 0.01
    flags = {r["subgroup"]: r["flagged"] for r in fair.flagged_groups(metrics).collect()}
    assert flags == {"Pressure": "Low", "Gender": ""}


def test_step_average_precision(spark):
    # Step-wise 0.7; the trapezoid would give 0.6833.
    rows = spark.createDataFrame([(1, .9), (0, .8), (1, .7), (0, .6), (0, .5), (1, .4)], "y int, score double")
    want = 1 / 3 * (1 + 2 / 3 + 3 / 6)
    assert ev.average_precision(rows, digits=None).first()[0] == pytest.approx(want)


def test_quantiles_agree_with_numpy_when_narrowed_and_split(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    groups = {"even": rng.normal(size=4000), "tied": np.r_[np.zeros(3000), rng.exponential(size=900)],
              "few": np.array([3.0, 1.0, 2.0])}
    df = spark.createDataFrame([(g, float(v)) for g, values in groups.items() for v in values], "g string, v double")
    probs = {"q1": 0.25, "mid": 0.5, "q9": 0.9}
    for kwargs in ({}, {"narrow_above_bytes": 0, "narrow_above_rows": 50}, {"rows_per_task": 700},
                   {"narrow_above_bytes": 0, "narrow_above_rows": 50, "rows_per_task": 60}):
        got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", probs, **kwargs).collect()}
        for g, values in groups.items():
            assert got[g]["n"] == len(values)
            for name, q in probs.items():
                assert got[g][name] == pytest.approx(np.quantile(values, q), abs=1e-12), (kwargs, g, name)


def test_quantiles_fall_back_when_an_interval_misses(spark, monkeypatch):
    from riskframe.plans import ordered

    monkeypatch.setattr(ordered, "SKETCH_ACCURACY", 10 ** 9)  # no slack, so neighbours of a rank lie outside
    df = spark.createDataFrame([("g", float(i * i)) for i in range(2000)], "g string, v double")
    got = exact_quantiles(df, ["g"], "v", {"a": 0.3333}, narrow_above_bytes=0, narrow_above_rows=10).first()
    assert got["a"] == pytest.approx(666 ** 2 + (0.3333 * 1999 - 666) * (667 ** 2 - 666 ** 2))


def test_paired_t_counts_its_pairs(spark):
    short = pairs(spark, [0.84, 0.85, 0.83], [0.83, 0.85, 0.82])
    got = sg.paired_t(short, 5, None).first()
    assert got["t_stat"] is None and got["p_value"] is None and got["mean_a"] == pytest.approx(0.84)


def test_the_caller_chooses_the_signed_rank_method(spark):
    five = pairs(spark, [0.1, 0, 0, 0, 0.5], [0, 0.2, 0.3, 0.4, 0])
    exact, normal = (sg.wilcoxon(five, m, digits=None).first() for m in ("exact", "normal"))
    assert exact["p_value"] == 0.8125 and exact["p_method"] == "exact"
    z = (6 - 7.5) / math.sqrt(5 * 6 * 11 / 24)
    assert normal["p_value"] == pytest.approx(math.erfc(abs(z) / math.sqrt(2))) and normal["p_method"] == "normal"
    tied = pairs(spark, [1, 1, 0], [0, 0, 3])
    assert sg.wilcoxon(tied, "exact").first()["p_value"] is None
    assert sg.wilcoxon(tied).first()["p_method"] == "normal"


def plain_weight(key, n, rep):
    """Weight of a combination of n rows, with Python's own whole numbers."""
    import hashlib

    def uniform(unit):
        mask = 2 ** 64 - 1
        x = ((int(hashlib.md5(f"boot:{key}".encode()).hexdigest()[:8], 16) << 32) + rep * sg.FEW + unit + 0x9E3779B97F4A7C15) & mask
        x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ x >> 27) * 0x94D049BB133111EB) & mask
        return ((x ^ x >> 31) >> 11) / 2 ** 53
    if n < sg.FEW:
        return sum(next((k for k, e in enumerate(sg.POISSON_ENDS) if uniform(j) < e), 13) for j in range(n))
    z = math.sqrt(-2 * math.log(1 - uniform(0))) * math.cos(2 * math.pi * uniform(1))
    return max(0, math.floor(n + z * math.sqrt(n) + (z * z - 1) / 6 + 0.5))


def test_bootstrap_of_any_metric(spark):
    """Replicates drawn combination by combination in Python from the same hashes; ranges of scores join up."""
    from collections import Counter

    rows = [(i % 3 == 0 and 1 or 0, (i * 7 % 10) / 10, int(i * 7 % 10 >= 5)) for i in range(800)]
    df = spark.createDataFrame(rows + [(1, None, 1)], "y int, score double, pred int").repartition(3)
    got = {r["replicate"]: r for r in sg.bootstrap_replicates(df, "y", "pred", 6, metrics=["accuracy"], score="score").collect()}
    cells, scores = Counter((y, p) for y, _, p in rows + [(1, None, 1)]), Counter((y, s) for y, s, _ in rows)
    for rep in range(1, 7):
        w = {c: plain_weight(f"{c[0]}/{c[1]}", n, rep) for c, n in cells.items()}
        assert got[rep]["accuracy"] == pytest.approx(sum(x for (y, p), x in w.items() if y == p) / sum(w.values()))
        v = {c: plain_weight(f"{c[0]}/{round(c[1] * 1e9)}", n, rep) for c, n in scores.items()}
        wins = sum(a * b * ((s > t) + 0.5 * (s == t)) for (y, s), a in v.items() if y for (x, t), b in v.items() if not x)
        whole = [sum(a for (y, _), a in v.items() if y == side) for side in (1, 0)]
        assert got[rep]["roc_auc"] == pytest.approx(wins / whole[0] / whole[1])


def test_resampled_weights_follow_the_poisson_law():
    base = np.arange(4_000)
    for n in (1, 5, 63, 64, 1_000):
        w = sg.resampled(base, np.full(len(base), n), 50).ravel()
        assert w.mean() == pytest.approx(n, abs=5 * math.sqrt(n / len(w))) and w.var() == pytest.approx(n, rel=0.03)
        tail = sum(math.exp(-n + k * math.log(n) - math.lgamma(k + 1)) for k in range(int(n - math.sqrt(n)) + 1))
        assert (w <= int(n - math.sqrt(n))).mean() == pytest.approx(tail, abs=0.01)
    assert not sg.resampled(base[:3], np.zeros(3, int), 5).any()


def test_shape_without_a_file_list(spark, tmp_path):
    import os

    path = str(tmp_path / "t")
    spark.range(100).repartition(7).write.parquet(path)
    row = dq.table_shape(spark.read.parquet(path)).first()
    size = sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".parquet"))
    assert (row["rows"], row["columns"], row["bytes"]) == (100, 1, size)
