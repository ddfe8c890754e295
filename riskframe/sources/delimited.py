"""Delimited text with a header, and table sinks (A1, A2, A5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskframe.functions.names import quoted as _quote

# Cell texts read as missing by default.
MISSING_TEXTS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                 "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                   missing: Sequence[str] = MISSING_TEXTS, sep: str = ",", line_breaks: bool = False) -> DataFrame:
    """Header, quoted cells, missing texts to null, typed columns.

    Cells are read as text and the missing texts taken out first. Without a schema one aggregate counts, per column,
    how many of the cells left are whole numbers, numbers and truth values, and picks the narrowest type that holds all.
    ``line_breaks`` allows them inside quoted cells, at the price of files that can't be split; without it such a cell
    is an error where it leaves a row with too few cells.
    """
    reader = (spark.read.option("header", True).option("sep", sep).option("escape", '"').option("mode", "FAILFAST")
              .option("multiLine", line_breaks))
    if schema is None:
        names = reader.option("inferSchema", False).csv(path).columns
        text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        cells = _cells(reader, path, text, missing)
        return cells.select(*[F.col(_quote(n)).cast(t).alias(n) for n, t in _infer(cells).items()])
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    cells = _cells(reader, path, text, missing)
    return cells.select(*[F.col(_quote(f.name)).cast(f.dataType).alias(f.name) for f in schema])


def _cells(reader, path: str, text: T.StructType, missing: Sequence[str]) -> DataFrame:
    rows = reader.schema(text).option("enforceSchema", False).csv(path)
    return rows.select(*[_blank(F.col(_quote(f.name)), missing).alias(f.name) for f in text])


def _infer(cells: DataFrame) -> dict[str, str]:
    """Narrowest of bigint, double, boolean and string per column, from one aggregate over all cells."""
    counts = []
    for i, name in enumerate(cells.columns):
        cell = F.col(_quote(name))
        counts += [F.count(cell).alias(f"all{i}"), F.count(F.when(cell.rlike(r"^\s*[+-]?[0-9]+\s*$"), cell.try_cast("bigint"))).alias(f"whole{i}"),
                   F.count(F.when(~cell.rlike("[dDfF]\\s*$"), cell.try_cast("double"))).alias(f"number{i}"),
                   F.count_if(F.lower(cell).isin("true", "false")).alias(f"truth{i}")]
    found, kinds = cells.agg(*counts).first(), {}
    for i, name in enumerate(cells.columns):
        seen = found[f"all{i}"]
        kinds[name] = next((kind for kind, part in (("bigint", "whole"), ("double", "number"), ("boolean", "truth"))
                            if seen and found[f"{part}{i}"] == seen), "string")
    return kinds


def write_delimited(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """Header, no index. ``single_file`` is for small result tables only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def _blank(col: Column, missing: Sequence[str]) -> Column:
    return F.when(~col.isin(list(missing)), col)
