"""Data-quality operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.functions.names import quoted as _quoted
from riskframe.operators.profile import box_stats, guarded_corr
from riskframe.plans.storage import store


def missing(col: Column, dtype: str) -> Column:
    """Null, or NaN in a floating-point column."""
    return col.isNull() | F.isnan(col) if dtype in ("double", "float") else col.isNull()


def _long(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, value) with values as text; one pass, columns in rows."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(_quoted(c)).cast("string").alias("value"))
                      for c in columns])
    return df.select(*keep, F.inline(cells))


def value_counts(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Count per (column, value), nulls left out; hot values combine before the shuffle."""
    return (_long(df, columns, keep).filter(F.col("value").isNotNull())
            .groupBy(*keep, "column", "value").agg(F.count(F.lit(1)).alias("n")))


def column_profile(df: DataFrame, columns: Sequence[str], approx_distinct: bool = False,
                   digits: int = 6) -> DataFrame:
    """One row per column: type, rows, non-null, distinct, min, max, mean (B1).

    Distinct counts are exact (from value counts) unless ``approx_distinct``;
    everything else is one aggregate. Min, max and mean are for numeric columns.
    """
    types = dict(df.dtypes)
    numeric = [c for c in columns if types[c] in ("int", "bigint", "double", "float", "smallint", "tinyint")
               or types[c].startswith("decimal")]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        col = F.col(_quoted(c))
        aggs.append(F.count_if(~missing(col, types[c])).alias(f"_n{i}"))
        if approx_distinct:
            aggs.append(F.approx_count_distinct(col).alias(f"_d{i}"))
        if c in numeric:
            aggs += [F.min(col).cast("double").alias(f"_lo{i}"), F.max(col).cast("double").alias(f"_hi{i}"),
                     F.avg(col.cast("double")).alias(f"_avg{i}")]
    none = F.lit(None).cast("double")
    rows = F.array(*[F.struct(
        F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"), F.col("_rows").alias("rows"),
        F.col(f"_n{i}").alias("non_null"),
        (F.col(f"_d{i}") if approx_distinct else F.lit(None).cast("long")).alias("distinct"),
        (F.col(f"_lo{i}") if c in numeric else none).alias("min"),
        (F.col(f"_hi{i}") if c in numeric else none).alias("max"),
        (F.round(F.col(f"_avg{i}"), digits) if c in numeric else none).alias("mean"))
        for i, c in enumerate(columns)])
    profile = df.agg(*aggs).select(F.inline(rows))
    if approx_distinct:
        return profile
    # Long texts are told apart by their digests, which are what is shuffled.
    value = F.when(F.length("value") > 64, F.sha2("value", 256)).otherwise(F.col("value"))
    distinct = (_long(df, columns).filter(F.col("value").isNotNull()).select("column", value.alias("value")).distinct()
                .groupBy("column").agg(F.count(F.lit(1)).alias("distinct")))
    return (profile.drop("distinct").join(distinct, "column", "left").fillna(0, ["distinct"])
            .select("column", "dtype", "rows", "non_null", "distinct", "min", "max", "mean"))


def table_shape(df: DataFrame) -> DataFrame:
    """One row: rows, columns and bytes on disk of the files that hold the rows (B1).

    ``df`` reads files directly; their sizes come with the rows, so no list of files is made.
    """
    files = df.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path").agg(
        F.count(F.lit(1)).alias("rows"), F.max("file_size").alias("bytes"))
    return files.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.lit(len(df.columns)).alias("columns"),
                     F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def missing_report(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Columns with missing cells: count and percent, most missing first (B2)."""
    types = dict(df.dtypes)
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[
        F.count_if(missing(F.col(_quoted(c)), types[c])).alias(f"_n{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"_n{i}").alias("missing_count"),
        F.round(F.try_divide(F.col(f"_n{i}") * F.lit(100.0), F.col("_rows")), digits).alias("missing_pct"))
        for i, c in enumerate(columns)])
    return (counts.select(F.inline(rows)).filter("missing_count > 0")
            .orderBy(F.col("missing_pct").desc(), "column"))


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Rows complete in ``subset``."""
    return df.dropna(subset=list(subset))


def _row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of the whole values; a null differs from every value, and equals a null."""
    return F.sha2(F.to_json(F.struct(*[F.col(_quoted(c)).alias(f"c{i}") for i, c in enumerate(columns)])), 256)


def duplicate_groups(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """(digest, keep = smallest key, copies) per distinct content of ``columns``.

    Only digests and keys are shuffled, and copies of the same content are
    folded together in each task first.
    """
    return (df.select(_row_digest(columns).alias("digest"), F.col(key).alias("_key"))
            .groupBy("digest").agg(F.min("_key").alias("keep"), F.count(F.lit(1)).alias("copies")))


def drop_duplicates(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """The row with the smallest key of every distinct content."""
    keep = duplicate_groups(df, columns, key).select(F.col("keep").alias(key))
    return df.join(keep, key, "left_semi")


def duplicate_report(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Rows, distinct rows, rows beyond the first."""
    groups = duplicate_groups(df, columns, key)
    return groups.agg(F.sum("copies").alias("rows"), F.count(F.lit(1)).alias("distinct_rows"),
                      F.sum(F.col("copies") - 1).alias("duplicates"))


def invalid(col: Column, value) -> Column:
    """The sentinel value itself; a missing cell is not invalid."""
    return col.eqNullSafe(F.lit(value))


def drop_invalid(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(~invalid(F.col(_quoted(column)), value))


def iqr_outliers(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: float = 1.5,
                 digits: int | None = 6) -> DataFrame:
    """Quartiles, fences at k IQR and the number of values beyond them (B6); nothing is dropped."""
    stats = box_stats(df, columns, by, k, digits)
    return stats.select("column", *by, "n", "q1", "q3", "fence_low", "fence_high", "outliers")


def in_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Rows inside the domain; rows without a value go."""
    col = F.col(_quoted(column))
    keep = F.lit(True)
    if low is not None:
        keep = keep & (col >= low)
    if high is not None:
        keep = keep & (col <= high)
    return df.filter(keep & col.isNotNull())


def flag_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add one boolean per rule and keep every row."""
    return df.withColumns({name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()})


def drop_values(df: DataFrame, values: Mapping[str, Sequence[str]]) -> DataFrame:
    """Drop rows holding one of the named categories; missing cells stay."""
    for column, unwanted in values.items():
        hit = F.coalesce(F.col(_quoted(column)).isin(list(unwanted)), F.lit(False))
        df = df.filter(~hit)
    return df


def drop_rare(df: DataFrame, columns: Sequence[str], min_share: float) -> DataFrame:
    """Drop rows whose category has under ``min_share`` of the column's values; missing cells stay.

    ``df`` is read twice: once for the counts of all columns, once for the rows. The frequent values are stored, at most
    1 / min_share a column; the planner joins them by their size.
    """
    if not 0 <= min_share <= 1:
        raise ValueError("min_share must lie in [0, 1]")
    counts = store(value_counts(df, columns), "categories")
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    frequent = store(counts.join(totals, "column").filter(F.col("n") >= F.col("total") * F.lit(min_share))
                     .select("column", "value"), "frequent")
    for c in columns:
        keep = frequent.filter(F.col("column") == c).select(
            F.col("value").alias("_value"), F.lit(True).alias("_frequent"))
        col = F.col(_quoted(c))
        df = (df.join(keep, col.cast("string") == F.col("_value"), "left")
              .filter(F.col("_frequent") | col.isNull()).drop("_value", "_frequent"))
    return df


def near_zero_variance(df: DataFrame, columns: Sequence[str], threshold: float = 0.95,
                       digits: int = 6) -> DataFrame:
    """Share of the most frequent value per column, flagged when strictly above ``threshold``.

    Columns the table does not have are skipped.
    """
    present = [c for c in columns if c in df.columns]
    share = F.max("n") / F.sum("n")
    return (value_counts(df, present).groupBy("column")
            .agg(F.round(share, digits).alias("top_share"), (share > threshold).alias("flagged")))


def class_balance(df: DataFrame, target: str, digits: int = 2) -> DataFrame:
    """Count and percent per class, in class order."""
    counts = (df.filter(F.col(target).isNotNull()).groupBy(F.col(target).alias("class"))
              .agg(F.count(F.lit(1)).alias("n")))
    whole = F.sum("n").over(Window.partitionBy())  # one row per class
    return counts.withColumn("pct", F.round(F.col("n") * 100.0 / whole, digits)).orderBy("class")


@dataclass(frozen=True)
class Rule:
    """A named row rule: rows where ``hit`` holds are dropped, or only counted if ``flag_only``."""

    name: str
    hit: Column
    flag_only: bool = False


def first_failed(rules: Sequence[Rule]) -> Column:
    """Number (from 1) of the first dropping rule a row fails; null if it passes all."""
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        if not rule.flag_only:
            out = F.when(F.coalesce(rule.hit, F.lit(False)), F.lit(i)).otherwise(out)
    return out


def rule_ledger(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows before, dropped, flagged and after each rule in order, from one pass over the data."""
    marked = df.withColumn("_fail", first_failed(rules))
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, rule in enumerate(rules, 1):
        if rule.flag_only:
            reached = F.col("_fail").isNull() | (F.col("_fail") > i)
            aggs.append(F.count_if(reached & F.coalesce(rule.hit, F.lit(False))).alias(f"_h{i}"))
        else:
            aggs.append(F.count_if(F.col("_fail") == i).alias(f"_h{i}"))
    rows, before = [], F.col("_rows")
    for i, rule in enumerate(rules, 1):
        hits, zero = F.col(f"_h{i}"), F.lit(0).cast("long")
        dropped = zero if rule.flag_only else hits
        rows.append(F.struct(
            F.lit(i).alias("step"), F.lit(rule.name).alias("rule"), before.alias("rows_before"),
            dropped.alias("dropped"), (hits if rule.flag_only else zero).alias("flagged"),
            (before - dropped).alias("rows_after")))
        before = before - dropped
    return marked.agg(*aggs).select(F.inline(F.array(*rows)))


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that pass every dropping rule."""
    return df.filter(first_failed(rules).isNull())


def null_patterns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count per pattern of missing cells, as a string of 0/1 in column order."""
    types = dict(df.dtypes)
    mask = F.concat(*[F.when(missing(F.col(_quoted(c)), types[c]), "1").otherwise("0") for c in columns])
    return df.groupBy(mask.alias("pattern")).agg(F.count(F.lit(1)).alias("n"))


def null_correlation(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Correlation of missingness between columns that have any, a < b.

    No rows unless at least two columns have missing cells: a column without
    any is constant, and its correlations are undefined.
    """
    types = dict(df.dtypes)
    marks = df.select(*[missing(F.col(_quoted(c)), types[c]).cast("double").alias(c) for c in columns])
    return guarded_corr(marks, columns, digits=digits).filter(F.col("r").isNotNull())
