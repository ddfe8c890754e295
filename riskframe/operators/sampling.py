"""Stratified splits, folds and re-balanced samples in keyed-hash order.

Rows without a class are a class of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.functions.hashing import keyed_hash, keyed_uniform
from riskframe.plans.neighbours import nearest_neighbours
from riskframe.plans.ordered import at_or_before, class_sizes, join_null_safe, rank_cutoffs
from riskframe.plans.storage import store


COPIES_PER_STEP = 10_000


def _hashed(df: DataFrame, key: str, salt: str | Column) -> DataFrame:
    return df.withColumn("_h", keyed_hash(salt, F.col(key)))


def largest_remainder(sizes: DataFrame, by: Sequence[str], fraction: float) -> DataFrame:
    """Rows to take per class (``want``): ceil(fraction * n) in total, spread by largest remainder.

    Two sums come to the driver; the classes with the largest remainders are a distributed sort with a limit.
    """
    # Rounding guards against 0.2 * n landing a hair above a whole number.
    exact = F.round(F.col("n_class") * F.lit(fraction), 6)
    sizes = sizes.withColumn("_base", F.floor(exact)).withColumn("_rest", exact - F.floor(exact))
    sums = sizes.agg(F.ceil(F.round(F.sum("n_class") * F.lit(fraction), 6)).alias("total"), F.sum("_base").alias("base")).first()
    left = (sums["total"] or 0) - (sums["base"] or 0)
    if not left:
        return sizes.withColumn("want", F.col("_base")).drop("_base", "_rest")
    more = sizes.orderBy(F.col("_rest").desc(), *by).limit(left).select(*by, F.lit(1).alias("_more"))
    return (join_null_safe(sizes, more, by, "left")
            .withColumn("want", F.col("_base") + F.coalesce("_more", F.lit(0))).drop("_base", "_rest", "_more"))


def take_per_class(df: DataFrame, key: str, by: Sequence[str], salt: str, wants) -> DataFrame:
    """Add boolean ``_taken``: the first ``want`` rows of each class in hash order.

    ``wants(sizes)`` turns the class-size table into rows (by..., want).
    """
    by = list(by)
    hashed = _hashed(df, key, salt)
    cells, sizes = class_sizes(hashed, by, "_h")
    want = wants(sizes).select(*by, F.lit(0).alias("cut"), "want")
    cuts = store(rank_cutoffs(hashed, by, "_h", key, cells, want).drop("cut"), "cuts")
    taken = F.coalesce(at_or_before(F.col("_h"), F.col(key), F.col("cut_hash"), F.col("cut_key")),
                       F.lit(False))
    return (join_null_safe(hashed, cuts, by, "left").withColumn("_taken", taken)
            .select(*df.columns, "_taken"))


def stratified_split(df: DataFrame, key: str, by: Sequence[str], test_fraction: float = 0.2,
                     salt: str = "split", column: str = "split") -> DataFrame:
    """Exact stratified train/test split."""
    marked = take_per_class(df, key, by, salt, lambda s: largest_remainder(s, by, test_fraction))
    return (marked.withColumn(column, F.when(F.col("_taken"), "test").otherwise("train"))
            .drop("_taken"))


def stratified_folds(df: DataFrame, key: str, by: Sequence[str], folds: int = 5,
                     salt: str | Column = "fold", column: str = "fold") -> DataFrame:
    """Exact stratified k-fold assignment (E1): fold = floor(rank * k / n) in hash order.

    ``salt`` may be a column that is also part of ``by``, to draw several
    assignments at once.

    Fold sizes differ by at most one within a class. Only the k - 1 cut points
    per class are looked up; the rows themselves are assigned in place.
    """
    by = list(by)
    hashed = _hashed(df, key, salt)
    cells, sizes = class_sizes(hashed, by, "_h")
    wants = (sizes.withColumn("cut", F.explode(F.sequence(F.lit(1), F.lit(folds - 1))))
             .select(*by, "cut", F.ceil(F.col("cut") * F.col("n_class") / F.lit(float(folds))).alias("want"))
             .filter("want > 0"))
    cuts = store(rank_cutoffs(hashed, by, "_h", key, cells, wants)
                 .groupBy(*by).agg(F.collect_list(F.struct("cut_hash", "cut_key")).alias("_cuts")), "cuts")
    past = F.filter("_cuts", lambda c: ~at_or_before(
        F.col("_h"), F.col(key), c["cut_hash"], c["cut_key"]))
    return (join_null_safe(hashed, cuts, by, "left")
            .withColumn(column, F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(F.size(past)))
            .select(*df.columns, column))


def repeat_rows(df: DataFrame, key: str, times: Column, most: int, column: str) -> DataFrame:
    """Every row ``times`` times, numbered from 0 in ``column``; ``most`` is an upper bound of ``times``.

    A row repeated more than COPIES_PER_STEP times is dealt out in steps over
    the cluster, so a tiny class filled up to a huge one is not one task's work.
    """
    rows = df.withColumn("_times", times.cast("long")).filter("_times > 0")
    if most > COPIES_PER_STEP:
        steps = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_times") - 1) / F.lit(float(COPIES_PER_STEP))))
        rows = rows.withColumn("_step", F.explode(steps)).repartition(key, "_step")
    else:
        rows = rows.withColumn("_step", F.lit(0).cast("long"))
    first = F.col("_step") * COPIES_PER_STEP
    last = F.least(F.col("_times"), first + COPIES_PER_STEP) - 1
    return rows.withColumn(column, F.explode(F.sequence(first, last))).drop("_times", "_step")


def under_sample(df: DataFrame, key: str, target: str, salt: str = "under") -> DataFrame:
    """Every class cut down to the smallest one, without replacement."""
    def wants(sizes: DataFrame) -> DataFrame:
        return sizes.withColumn("want", F.lit(sizes.agg(F.min("n_class")).first()[0]).cast("long"))

    return take_per_class(df, key, [target], salt, wants).filter("_taken").drop("_taken")


def over_sample(df: DataFrame, key: str, target: str, salt: str = "over") -> DataFrame:
    """Every class filled up to the largest one with repeated rows.

    Row counts are exact: the deficit is dealt out evenly, and the remainder goes
    to the first rows in hash order. Each row repeats itself in place, so there
    is no draw table and no join on ranks. Adds ``copy`` (0 = the original).
    """
    def wants(sizes: DataFrame) -> DataFrame:
        deficit = F.lit(sizes.agg(F.max("n_class")).first()[0]).cast("long") - F.col("n_class")
        return (sizes.withColumn("_deficit", deficit)
                .withColumn("want", F.col("_deficit") % F.col("n_class")))

    hashed = _hashed(df, key, salt)
    cells, sizes = class_sizes(hashed, [target], "_h")
    plan = store(wants(sizes).withColumn("_times", F.floor(F.col("_deficit") / F.col("n_class"))), "plan")
    cuts = store(rank_cutoffs(hashed, [target], "_h", key, cells,
                              plan.select(target, F.lit(0).alias("cut"), "want")).drop("cut"), "cuts")
    extra = F.coalesce(at_or_before(F.col("_h"), F.col(key), F.col("cut_hash"), F.col("cut_key")),
                       F.lit(False)).cast("long")
    most = (plan.agg(F.max("_times")).first()[0] or 0) + 2
    joined = join_null_safe(hashed, plan.select(target, F.col("_times").alias("_full")), [target])
    joined = join_null_safe(joined, cuts, [target], "left")
    return (repeat_rows(joined, key, F.lit(1) + F.col("_full") + extra, most, "copy")
            .select(*df.columns, "copy"))


def progressive_samples(df: DataFrame, key: str, fractions: Sequence[float],
                        salt: str = "progressive") -> DataFrame:
    """Nested samples (E5): each row once per fraction whose first floor(f * n) rows hold it."""
    hashed = _hashed(df, key, salt).withColumn("_all", F.lit(0))
    cells, sizes = class_sizes(hashed, ["_all"], "_h")
    steps = F.array(*[F.struct(F.lit(i).alias("cut"), F.lit(float(f)).alias("fraction"))
                      for i, f in enumerate(fractions)])
    wants = (sizes.withColumn("_s", F.explode(steps))
             .select("_all", F.col("_s.cut").alias("cut"), F.col("_s.fraction").alias("fraction"),
                     F.floor(F.round(F.col("n_class") * F.col("_s.fraction"), 6)).alias("want")))
    cuts = store(rank_cutoffs(hashed, ["_all"], "_h", key, cells, wants.drop("fraction"))
                 .groupBy("_all").agg(F.collect_list(F.struct("cut", "cut_hash", "cut_key")).alias("_cuts")), "cuts")
    holding = F.filter("_cuts", lambda c: at_or_before(
        F.col("_h"), F.col(key), c["cut_hash"], c["cut_key"]))
    names = F.array(*[F.lit(float(f)) for f in fractions])
    return (hashed.join(cuts, "_all")
            .withColumn("_in", F.explode(holding))
            .withColumn("fraction", F.get(names, F.col("_in.cut")))
            .select(*df.columns, "fraction"))


def fold_arrays(df: DataFrame, key: str, by: str, classes: Sequence, folds: int, salts: Sequence, column: str = "folds") -> DataFrame:
    """Add an array with the row's fold under every salt, each as ``stratified_folds`` draws it.

    ``classes`` are the values of ``by``. The cut points of all salts come from one pass (salts x classes x folds rows,
    collected), and rows are assigned in place.
    """
    drawn = df.select(key, by, F.explode(F.array(*[F.lit(str(s)) for s in salts])).alias("_salt"))
    hashed = drawn.withColumn("_h", keyed_hash(F.col("_salt"), F.col(key)))
    cells, sizes = class_sizes(hashed, ["_salt", by], "_h")
    wants = (sizes.withColumn("cut", F.explode(F.sequence(F.lit(1), F.lit(folds - 1))))
             .select("_salt", by, "cut", F.ceil(F.col("cut") * F.col("n_class") / F.lit(float(folds))).alias("want")).filter("want > 0"))
    cuts: dict = {}
    for r in rank_cutoffs(hashed, ["_salt", by], "_h", key, cells, wants).collect():
        cuts.setdefault((r["_salt"], r[by]), []).append((r["cut_hash"], r["cut_key"]))

    def fold(salt: str) -> Column:
        own = keyed_hash(salt, F.col(key))
        out = F.lit(0)
        for value in classes:
            past = [(~at_or_before(own, F.col(key), F.lit(h), F.lit(k))).cast("int") for h, k in cuts.get((salt, value), [])]
            out = F.when(F.col(by) == value, sum(past[1:], past[0]) if past else F.lit(0)).otherwise(out)
        return out
    return df.withColumn(column, F.array(*[fold(str(s)) for s in salts]))


def nested_levels(df: DataFrame, key: str, fold: str, folds: int, fractions: Sequence[float], salt: str) -> DataFrame:
    """Add ``levels``: for every fold the place (from 1) of the first fraction whose sample of the other folds' rows
    holds the row, 0 if the row lies in the fold (E6).

    A sample is the first floor(f * n) of them in hash order, as in ``progressive_samples``; rows beyond the largest have
    a place after the last. ``fractions`` ascend; folds x fractions cut points are all that is collected.
    """
    hashed = _hashed(df, key, salt)
    others = hashed.withColumn("_fold", F.explode(F.array(*map(F.lit, range(folds))))).filter(F.col("_fold") != F.col(fold))
    cells, sizes = class_sizes(others, ["_fold"], "_h")
    steps = F.array(*[F.struct(F.lit(i).alias("cut"), F.lit(float(f)).alias("f")) for i, f in enumerate(fractions)])
    wants = sizes.withColumn("_s", F.explode(steps)).select(
        "_fold", F.col("_s.cut").alias("cut"), F.floor(F.round(F.col("n_class") * F.col("_s.f"), 6)).alias("want")).filter("want > 0")
    found = {(r["_fold"], r["cut"]): r for r in rank_cutoffs(others, ["_fold"], "_h", key, cells, wants).collect()}

    def level(i: int) -> Column:
        before = F.lit(1)
        for cut in range(len(fractions)):
            row = found.get((i, cut))
            past = F.lit(True) if row is None else ~at_or_before(F.col("_h"), F.col(key), F.lit(row["cut_hash"]), F.lit(row["cut_key"]))
            before = before + past.cast("int")
        return F.when(F.col(fold) == i, 0).otherwise(before)
    return hashed.withColumn("levels", F.array(*[level(i) for i in range(folds)])).select(*df.columns, "levels")


def fixed_sample(df: DataFrame, key: str, size: int, salt: str = "fixed") -> DataFrame:
    """Exactly ``size`` rows without replacement, the first in hash order.

    They are found by cut point, which neither sorts nor gathers the rows.
    """
    marked = take_per_class(df.withColumn("_one", F.lit(0)), key, ["_one"], salt,
                            lambda s: s.withColumn("want", F.least("n_class", F.lit(size).cast("long"))))
    return marked.filter("_taken").select(*df.columns)


def capped_folds(df: DataFrame, key: str, by: Sequence[str], floor_rows: int = 5000,
                 fraction: float = 0.5, folds: int = 3, salt: str = "cap") -> DataFrame:
    """Folds over max(floor_rows, fraction * n) rows."""
    def wants(sizes: DataFrame) -> DataFrame:
        n = F.col("n_class")
        return sizes.withColumn("want", F.least(n, F.greatest(
            F.lit(floor_rows).cast("long"), F.floor(F.round(n * F.lit(fraction), 6)))))

    capped = take_per_class(df.withColumn("_one", F.lit(0)), key, ["_one"], salt, wants)
    capped = capped.filter("_taken").select(*df.columns)
    return stratified_folds(capped, key, by, folds, salt=f"{salt}-fold")


def smote(df: DataFrame, key: str, target: str, vector: str, minority, draws: int | None = None,
          k: int = 5, salt: str = "smote") -> DataFrame:
    """Synthetic minority rows on segments to one of the k nearest minority neighbours.

    ``draws`` defaults to what balances the class against the rest. Draws are
    dealt evenly over the minority rows, the remainder by hash order; neighbour
    and step come from keyed hashes of (row, draw).
    """
    n_minor, n_all = df.agg(F.count_if(F.col(target) == minority), F.count(F.lit(1))).first()
    draws = max(0, n_all - 2 * n_minor) if draws is None else draws
    if n_minor < 2:
        raise ValueError("interpolation needs at least two minority rows")
    k = min(k, n_minor - 1)
    minor = store(df.filter(F.col(target) == minority).select(key, vector), "minority")
    each, rest = divmod(draws, n_minor)
    dealt = take_per_class(minor.withColumn("_one", F.lit(0)), key, ["_one"], salt,
                           lambda s: s.withColumn("want", F.lit(rest).cast("long")))
    times = F.lit(each) + F.col("_taken").cast("int")
    draw_key = F.concat_ws("/", "base_id", "draw")
    dealt = (repeat_rows(dealt, key, times, each + 1, "_copy")
             .select(F.col(key).alias("base_id"), F.col(vector).alias("_from"),
                     (F.col("_copy") + 1).cast("int").alias("draw"))
             .withColumn("rank", (keyed_hash(f"{salt}-pick", draw_key) % k + 1).cast("int"))
             .withColumn("_u", keyed_uniform(f"{salt}-step", draw_key)))
    near = nearest_neighbours(minor, minor, key, vector, k).drop("distance")
    ends = minor.select(F.col(key).alias("neighbour_id"), F.col(vector).alias("_to"))
    return (dealt.join(near, ["base_id", "rank"]).join(ends, "neighbour_id")
            .select("base_id", "draw", "neighbour_id",
                    F.zip_with("_from", "_to", lambda a, b: a + F.col("_u") * (b - a)).alias(vector)))


def size_and_mix(df: DataFrame, by: Sequence[str], target: str) -> DataFrame:
    """Rows and positive rows per sample."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                               F.count_if(F.col(target) == 1).alias("n_pos"))


